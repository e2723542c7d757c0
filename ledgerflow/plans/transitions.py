"""The dispute life cycle: one operator, one declarative spec per action."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.config import JobConfig
from ledgerflow.functions import as_moment, batch_label, to_day, to_money
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import conform, existing, prefixed, trim_all, with_source
from ledgerflow.operators.filters import clean, flag_unlisted
from ledgerflow.operators.joins import lookup, narrow, with_employee
from ledgerflow.operators.keys import number_rows, stable
from ledgerflow.operators.relational import first_per, union_all
from ledgerflow.operators.updates import apply_updates
from ledgerflow.operators.validate import (
    Rule,
    amount_rules,
    date_rules,
    flag_repeats,
    known_employee,
    max_value,
    validate,
)
from ledgerflow.plans.dispute import source_label
from ledgerflow.plans.tables import JobResult, Tables, first_free

# The columns an action file is padded to.
ACTION_COLUMNS = (
    "DSB_ID",
    "Action",
    "Amount_Or_Days",
    "Credit_Invoice_Date",
    "Action_Norm_Reason",
    "Action_Reason",
    "Assign_Rep",
    "Note_Tag",
    "Attachment",
    "ILEC_Confirmation",
)

# The columns of the history and note tables that a transition writes.
HISTORY_TYPES = {
    "DSB_ID": "bigint",
    "Dispute_Category": "string",
    "Display_Status": "string",
    "Date_Submitted": "timestamp_ntz",
    "ILEC_Confirmation": "string",
    "ILEC_Comments": "string",
    "Credit_Approved": "decimal(19,4)",
    "Denied": "string",
    "Credit_Received_Amount": "decimal(19,4)",
    "Credit_Received_Invoice_Date": "date",
    "Escalate": "string",
    "Escalate_DT": "date",
    "Escalate_Amount": "decimal(19,4)",
    "Dispute_Reason": "string",
    "STC_Index": "string",
    "Norm_Close_Reason": "string",
    "Close_Reason": "string",
    "GRT_Update_Rep": "string",
    "Resolution_Date": "date",
    "Date_Updated": "timestamp_ntz",
    "Source_File": "string",
}
CARRIED = (
    "Dispute_Category",
    "Date_Submitted",
    "ILEC_Confirmation",
    "ILEC_Comments",
    "Escalate",
    "Escalate_DT",
    "Escalate_Amount",
    "Dispute_Reason",
    "STC_Index",
    "Resolution_Date",
)
CARRIED_BY_ESCALATE = (
    "Dispute_Category",
    "Date_Submitted",
    "ILEC_Confirmation",
    "ILEC_Comments",
    "STC_Index",
    "Resolution_Date",
)
NOTE_TYPES = {
    "DSB_ID": "bigint",
    "Logged_By": "string",
    "Norm_Note_Action": "string",
    "Dispute_Note": "string",
    "Days_Till_Action": "int",
    "Assign_To": "string",
    "Note_Tag": "string",
    "Attachment": "string",
    "Edit_Date": "timestamp_ntz",
}
CURRENT_TYPES = {
    "Status": "string",
    "Display_Status": "string",
    "Escalate_Date": "date",
    "#_Of_Escalations": "int",
    "Dispute_Reason": "string",
    "Norm_Close_Reason": "string",
    "Close_Reason": "string",
    "Credit_Approved": "decimal(19,4)",
    "Credit_Received_Amount": "decimal(19,4)",
    "Credit_Received_Invoice_Date": "date",
    "ILEC_Confirmation": "string",
    "ILEC_Comments": "string",
    "Last_GRT_Action": "string",
    "Last_GRT_Action_Rep": "string",
    "Date_Updated": "timestamp_ntz",
    "Source_File": "string",
    "Norm_Note_Action": "string",
    "Dispute_Note": "string",
    "Note_Group_Tag": "string",
    "Note_Assigned_To": "string",
    "Note_Added_On": "timestamp_ntz",
    "Days_Till_Note_Review": "int",
    "DH_ID": "bigint",
    "DN_ID": "bigint",
}
RESET_NOTE = (
    "Norm_Note_Action",
    "Dispute_Note",
    "Note_Group_Tag",
    "Note_Assigned_To",
    "Note_Added_On",
    "Days_Till_Note_Review",
)

STAMPED = (
    "Display_Status",
    "Last_GRT_Action",
    "Last_GRT_Action_Rep",
    "Date_Updated",
    "Source_File",
    "DH_ID",
)


def missing() -> Rule:
    return Rule("DSB_ID", "DSB_ID does not exist in Dispute Current", ~F.col("_has_current"))


def not_email() -> Rule:
    """A dispute without a type passes."""
    wrong = F.col("cur_Dispute_Type") != "Email"
    return Rule("DSB_ID", "Dispute_Type is not Email for DSB_ID", wrong)


def no_prior() -> Rule:
    return Rule(
        "DSB_ID", "DSB_ID has no prior version in Dispute History", ~F.col("_has_prior")
    )


Values = Mapping[str, Callable[[], Column]]


def _a(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _amount() -> Column:
    return to_money("Amount_Or_Days")


def _credit_day() -> Column:
    return to_day("Credit_Invoice_Date")


@dataclass(frozen=True)
class TransitionSpec:
    """What one action means.

    `history` and `current` give the columns that differ from the carried prior
    version and from the present state. `prior` carries the former history row,
    otherwise the current row is carried. A spec without a history status writes
    a note instead.
    """

    action: str
    status: str | None
    last_action: str | None
    rules: Callable[[AsOf, JobConfig], list[Rule]]
    closes: bool = False
    prior: bool = True
    carried: tuple[str, ...] = CARRIED
    history: Values = field(default_factory=dict)
    current: Values = field(default_factory=dict)


SPECS: dict[str, TransitionSpec] = {
    s.action: s
    for s in (
        TransitionSpec(
            "Escalate",
            "Filed",
            "Filed",
            lambda as_of, cfg: [missing(), known_employee()],
            prior=False,
            carried=CARRIED_BY_ESCALATE,
            history={
                "Escalate": lambda: F.lit("Y"),
                "Escalate_DT": lambda: F.col("_now").cast("date"),
                "Escalate_Amount": _a("cur_Dispute_Amount"),
                "Dispute_Reason": _a("Action_Reason"),
            },
            current={
                "Escalate_Date": lambda: F.col("_now").cast("date"),
                "#_Of_Escalations": lambda: F.coalesce("cur_#_Of_Escalations", F.lit(0)) + 1,
                "Dispute_Reason": _a("Action_Reason"),
            },
        ),
        TransitionSpec(
            "Close",
            "Denied - Closed",
            "GRT Close",
            lambda as_of, cfg: [missing(), known_employee(), no_prior()],
            closes=True,
            history={
                "Norm_Close_Reason": _a("Action_Norm_Reason"),
                "Close_Reason": _a("Action_Reason"),
            },
            current={
                "Norm_Close_Reason": _a("Action_Norm_Reason"),
                "Close_Reason": _a("Action_Reason"),
            },
        ),
        TransitionSpec(
            "Paid",
            "Paid",
            "Paid",
            lambda as_of, cfg: [
                *amount_rules("Amount_Or_Days"),
                *date_rules("Credit_Invoice_Date", as_of),
                missing(),
                known_employee(),
                no_prior(),
            ],
            closes=True,
            carried=(*CARRIED, "Denied"),
            history={
                "Credit_Approved": _amount,
                "Credit_Received_Amount": _amount,
                "Credit_Received_Invoice_Date": _credit_day,
            },
            current={
                "Credit_Approved": _amount,
                "Credit_Received_Amount": _amount,
                "Credit_Received_Invoice_Date": _credit_day,
            },
        ),
        TransitionSpec(
            "Denied",
            "Denied - Pending",
            "Denied - Pending",
            lambda as_of, cfg: [missing(), not_email(), known_employee(), no_prior()],
            history={
                "ILEC_Confirmation": _a("ILEC_Confirmation"),
                "ILEC_Comments": _a("Action_Reason"),
            },
            current={
                "ILEC_Confirmation": _a("ILEC_Confirmation"),
                "ILEC_Comments": _a("Action_Reason"),
            },
        ),
        TransitionSpec(
            "Approved",
            "Approved",
            "Approved",
            lambda as_of, cfg: [
                *amount_rules("Amount_Or_Days"),
                missing(),
                not_email(),
                known_employee(),
                no_prior(),
            ],
            carried=(*CARRIED, "Denied"),
            history={
                "ILEC_Confirmation": _a("ILEC_Confirmation"),
                "ILEC_Comments": _a("Action_Reason"),
                "Credit_Approved": _amount,
            },
            current={"Credit_Approved": _amount},
        ),
        TransitionSpec(
            "Dispute Note",
            None,
            None,
            lambda as_of, cfg: [
                missing(),
                *amount_rules("Amount_Or_Days"),
                max_value("Amount_Or_Days", cfg.note_day_limit),
                known_employee(),
            ],
            prior=False,
            current={
                "Norm_Note_Action": _a("Action_Norm_Reason"),
                "Dispute_Note": _a("Action_Reason"),
                "Note_Group_Tag": _a("Note_Tag"),
                "Note_Assigned_To": lambda: F.coalesce("Assign_Rep", "Full_Name"),
                "Days_Till_Note_Review": lambda: _amount().cast("int"),
                "Note_Added_On": _a("_now"),
                "DN_ID": _a("DN_ID"),
            },
        ),
    )
}


def _by_action(choices: Iterable[tuple[str, Column]], otherwise: Column | None = None) -> Column:
    """One value per action, as a single conditional."""
    result = None
    for action, value in choices:
        test = F.col("Action") == action
        result = F.when(test, value) if result is None else result.when(test, value)
    if result is None:
        return F.lit(None) if otherwise is None else otherwise
    return result if otherwise is None else result.otherwise(otherwise)


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


@dataclass
class Transition:
    """Judged actions, rows for history and notes, and the changes to the current state."""

    results: DataFrame
    history: DataFrame
    notes: DataFrame
    changes: DataFrame
    counters: dict[str, int]
    # One change a dispute at most.
    unique: bool = False

    def snapshot(self, current: DataFrame) -> DataFrame:
        """The current state after the changes."""
        columns = self.changes.columns[1:]
        return apply_updates(current, self.changes, ["DSB_ID"], columns, unique=self.unique)


def judge(
    actions: DataFrame,
    tables: Tables,
    specs: Mapping[str, TransitionSpec],
    as_of: AsOf,
    config: JobConfig,
) -> DataFrame:
    """Each action next to its submitter, its dispute and the prior version, with errors set.

    The large tables are cut to the named keys by semi joins before they are
    looked up, and all rules of all actions are one expression. A dispute meets its
    prior version before the actions meet the dispute: actions without a dispute, or
    most of a batch, would else meet in one task, as they have no DH_ID.
    """
    current = tables["dispute_current"]
    keyed = actions.withColumn("DSB_ID", F.col("DSB_ID").cast("string").try_cast("bigint"))
    staffed = with_employee(keyed, tables["employee"])
    known = narrow(current, keyed, ["DSB_ID"])
    part = prefixed(known.select(*_present(known, _current_columns(specs))), "cur_")
    with_prior = any(s.prior for s in specs.values())
    if with_prior:
        wanted = dict.fromkeys(c for s in specs.values() if s.prior for c in s.carried)
        prior = narrow(tables["dispute_history"], known, ["DH_ID"])
        prior = prior.select("DH_ID", *_present(prior, wanted))
        part = lookup(
            part,
            prior,
            {"cur_DH_ID": "DH_ID"},
            {f"old_{c}": c for c in prior.columns if c != "DH_ID"},
            "_has_prior",
            spread="cur_DSB_ID",
        )
    joined = lookup(
        staffed,
        part,
        {"DSB_ID": "cur_DSB_ID"},
        {c: c for c in part.columns if c != "cur_DSB_ID"},
        "_has_current",
        spread="Line_ID",
    )
    if with_prior:
        joined = joined.withColumn("_has_prior", F.coalesce("_has_prior", F.lit(False)))
    rules = [
        rule.when(F.col("Action") == action)
        for action, spec in specs.items()
        for rule in spec.rules(as_of, config)
    ]
    return validate(joined.withColumn("_now", as_moment(as_of)), rules)


def _present(df: DataFrame, wanted: Iterable[str]) -> list[Column]:
    """The wanted columns, null where an older table lacks one."""
    have = existing(df)
    return [
        F.col(have[c.lower()]).alias(c)
        if c.lower() in have
        else _null(CURRENT_TYPES.get(c) or HISTORY_TYPES.get(c) or "string").alias(c)
        for c in wanted
    ]


def _current_columns(specs: Mapping[str, TransitionSpec]) -> list[str]:
    """What a judged action needs to know of its dispute."""
    return list(
        dict.fromkeys(
            ("DSB_ID", "DH_ID", "Dispute_Type", "Dispute_Amount", *_touched(specs))
            + CARRIED_BY_ESCALATE
        )
    )


def _touched(specs: Mapping[str, TransitionSpec]) -> tuple[str, ...]:
    """The columns of the current state that any of the actions may set."""
    names = {c for s in specs.values() for c in s.current}
    if any(s.status is not None for s in specs.values()):
        names |= {*RESET_NOTE, *STAMPED}
    if any(s.closes for s in specs.values()):
        names.add("Status")
    return tuple(c for c in CURRENT_TYPES if c in names)


def transition(
    actions: DataFrame,
    tables: Tables,
    as_of: AsOf,
    names: Iterable[str] = tuple(SPECS),
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
    distinct: bool = False,
    repeated: str | None = None,
) -> Transition:
    """Apply actions to disputes; every DSB_ID has one action of each name at most.

    `actions` has Line_ID, Action and the action columns. All actions are judged
    and written in one pass over the touched disputes, and one numbering pass
    serves history and notes. `distinct` says that no action is given twice for a
    dispute; otherwise later ones are flagged. `repeated` names a column that tells
    which rows may be such; only they are moved to be compared. Where a dispute has
    several actions in one batch use `direct_actions`, which orders them.
    """
    specs = {name: SPECS[name] for name in names}
    judged = stable(judge(conform(actions, ACTION_COLUMNS), tables, specs, as_of, config))
    if not distinct:
        flagged = flag_repeats(
            judged.filter(repeated) if repeated else judged,
            ["DSB_ID", "Action"],
            "Line_ID",
            "DSB_ID",
            "DSB_ID was already given for this action",
        )
        judged = judged.filter(~F.col(repeated)).unionByName(flagged) if repeated else flagged
    notes = [n for n, s in specs.items() if s.status is None]
    is_note = F.col("Action").isin(notes) if notes else F.lit(False)
    todo = clean(judged).filter(F.col("Action").isin(list(specs)))
    order = ["_note", "Line_ID", "DSB_ID"]
    ranked, total = number_rows(todo.withColumn("_note", is_note), order, {"_rank": 0})
    used = (["DH_ID"] if len(notes) < len(specs) else []) + (["DN_ID"] if notes else [])
    first = first_free(tables, used, starts)
    if len(used) == 2:
        moving = ranked.filter(~F.col("_note")).count()
    else:
        moving = 0 if notes else total
    rank = F.col("_rank")
    keyed = ranked.withColumns(
        {
            "DH_ID": F.when(~F.col("_note"), rank + first.get("DH_ID", 0)),
            "DN_ID": F.when(F.col("_note"), rank - moving + first.get("DN_ID", 0)),
        }
    )
    given = {"DH_ID": moving, "DN_ID": total - moving}
    label = source_label(batch_label(as_of))
    return Transition(
        judged,
        _history_rows(keyed.filter(~F.col("_note")), specs, label),
        _note_rows(keyed.filter("_note")),
        _current_changes(keyed, specs, label),
        {key: start + given[key] for key, start in first.items()},
        unique=len(specs) == 1,
    )


def _history_rows(moved: DataFrame, specs: Mapping[str, TransitionSpec], label: Column) -> DataFrame:
    have = set(moved.columns)
    specs = {n: s for n, s in specs.items() if s.status is not None}
    fixed = {
        "DSB_ID": F.col("DSB_ID"),
        "Display_Status": _by_action((n, F.lit(s.status)) for n, s in specs.items()),
        "GRT_Update_Rep": F.col("Full_Name"),
        "Date_Updated": F.col("_now"),
        "Source_File": label,
    }

    def value(c: str, kind: str) -> Column:
        if c in fixed:
            return fixed[c].cast(kind)
        choices = []
        for name, spec in specs.items():
            old = ("old_" if spec.prior else "cur_") + c
            if c in spec.history:
                choices.append((name, spec.history[c]().cast(kind)))
            elif c in spec.carried and old in have:
                choices.append((name, F.col(old).cast(kind)))
        return _by_action(choices).cast(kind)

    return moved.select("DH_ID", *[value(c, k).alias(c) for c, k in HISTORY_TYPES.items()])


def _note_rows(noted: DataFrame) -> DataFrame:
    values = {
        "DSB_ID": F.col("DSB_ID"),
        "Logged_By": F.col("Full_Name"),
        "Norm_Note_Action": F.col("Action_Norm_Reason"),
        "Dispute_Note": F.col("Action_Reason"),
        "Days_Till_Action": _amount(),
        "Assign_To": F.coalesce("Assign_Rep", "Full_Name"),
        "Note_Tag": F.col("Note_Tag"),
        "Attachment": F.col("Attachment"),
        "Edit_Date": F.col("_now"),
    }
    return noted.select(
        "DN_ID",
        F.col("cur_DH_ID").cast("bigint").alias("DH_ID"),
        *[values[c].cast(k).alias(c) for c, k in NOTE_TYPES.items()],
    )


def _current_changes(
    keyed: DataFrame, specs: Mapping[str, TransitionSpec], label: Column
) -> DataFrame:
    """One row per dispute with the new values of every column an action may set.

    A column that the row's own action leaves alone keeps its present value.
    """
    sets: dict[str, dict[str, Column]] = {}
    for name, spec in specs.items():
        values = {c: v() for c, v in spec.current.items()}
        if spec.status is not None:
            values |= {
                "Display_Status": F.lit(spec.status),
                "Last_GRT_Action": F.lit(spec.last_action),
                "Last_GRT_Action_Rep": F.col("Full_Name"),
                "Date_Updated": F.col("_now"),
                "Source_File": label,
                "DH_ID": F.col("DH_ID"),
            }
            values |= {c: _null(CURRENT_TYPES[c]) for c in RESET_NOTE}
        if spec.closes:
            values["Status"] = F.lit("Closed")
        sets[name] = values

    def value(c: str) -> Column:
        kind = CURRENT_TYPES[c]
        choices = [(n, v[c].cast(kind)) for n, v in sets.items() if c in v]
        return _by_action(choices, F.col(f"cur_{c}").cast(kind))

    return keyed.select("DSB_ID", *[value(c).alias(c) for c in _touched(specs)])


def direct_actions(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    folder: str = "04_Dispute-Actions",
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """A file of dispute actions, applied in the configured order of actions.

    Disputes with one action, the usual case, are done in one pass. The second
    action of a dispute sees the state the first one left, so there are as many
    passes as one dispute has different actions, six at most.
    """
    rows = trim_all(conform(sub, ACTION_COLUMNS))
    if "dispute_id" in existing(rows):
        rows = rows.withColumn("DSB_ID", F.coalesce("DSB_ID", F.col("Dispute_ID").cast("string")))
    allowed = list(config.dispute_actions)
    rows = flag_unlisted(with_source(rows, folder), "Action", allowed)
    place = F.array_position(F.array(*[F.lit(a) for a in allowed]), F.col("Action"))
    # Turns go by the number, as `7` and `07` are one dispute.
    number = F.col("DSB_ID").cast("string").try_cast("bigint")
    rows = rows.withColumns({"_place": place.cast("int"), "_dsb": number})
    places = clean(rows).groupBy("_dsb").agg(
        F.sort_array(F.collect_set("_place")).alias("_all"), F.count("*").alias("_rows")
    )
    turn = F.array_position("_all", F.col("_place")).cast("int")
    found = lookup(
        rows, places, ["_dsb"], {"_all": "_all", "_rows": "_rows"}, own_shuffle=True, spread="Line_ID"
    )
    # More clean rows than actions: one of them is given twice.
    again = F.coalesce(F.col("_rows") > F.size("_all"), F.lit(False))
    turned = found.withColumns({"_turn": F.greatest(F.lit(1), turn), "_again": again})
    rows = stable(turned.drop("_all", "_rows", "_place", "_dsb"))
    turns = rows.agg(F.max("_turn")).first()[0] or 1

    counters = first_free(tables, ("DH_ID", "DN_ID"), starts)
    work = dict(tables)
    done: list[Transition] = []
    for turn in range(1, turns + 1):
        step = transition(
            rows.filter(F.col("_turn") == turn), work, as_of, allowed, config, counters, repeated="_again"
        )
        # A dispute has one action in a turn.
        step.unique = True
        counters |= step.counters
        done.append(step)
        if turn < turns:
            rest = rows.filter(F.col("_turn") > turn)
            part = narrow(work["dispute_current"], rest, ["DSB_ID"])
            work["dispute_current"] = stable(step.snapshot(part))
            work["dispute_history"] = union_all(work["dispute_history"], step.history)
    changes = union_all(
        *[t.changes.withColumn("_turn", F.lit(i)) for i, t in enumerate(done, start=1)]
    )
    last = Transition(
        done[0].results,
        done[0].history,
        done[0].notes,
        first_per(changes, ["DSB_ID"], [F.col("_turn").desc()]).drop("_turn")
        if turns > 1
        else done[0].changes,
        counters,
        unique=True,
    )
    return JobResult(
        union_all(*[submitted(t.results) for t in done]),
        {
            "dispute_history": union_all(*[t.history for t in done]),
            "dispute_notes": union_all(*[t.notes for t in done]),
        },
        {"dispute_current": last.snapshot(tables["dispute_current"])},
        {"dispute_current": last.changes},
        counters=counters,
    )


def submitted(judged: DataFrame) -> DataFrame:
    """Judged rows without what was looked up for them."""
    return judged.drop(
        *[c for c in judged.columns if c.startswith(("cur_", "old_", "_"))]
    )
