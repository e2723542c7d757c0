import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.conform import (
    coalesce_from,
    conform,
    default_where,
    initial_status,
    prefixed,
    trim_all,
)
from ledgerflow.operators.filters import (
    eligible,
    flag_unlisted,
    pending,
    split_by,
    tag_is,
    tag_is_not,
)
from ledgerflow.operators.joins import (
    account_calendar,
    conditional_lookup,
    join_effective,
    lookup,
    mark_existing,
    narrow,
    with_employee,
)
from ledgerflow.operators.keys import assign_ids, next_id, stable, work_dir
from ledgerflow.operators.mining import mine_cost
from ledgerflow.operators.relational import collect_errors, explode_csv, first_per, latest_by
from ledgerflow.operators.updates import apply_updates, default_start, stamp_worklist
from ledgerflow.operators.validate import (
    Rule,
    amount_rules,
    bill_date_rules,
    date_rules,
    flag_repeats,
    must_derive,
    must_exist,
    must_exist_with,
    outcome_summary,
    propagate_error,
    split_results,
    ticket_status,
    validate,
)

NOW = "2024-01-31 12:00:00"
E = "Error_Columns string, Error_Message string"


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def messages(df, key="id"):
    return {r[0]: r[1] for r in df.select(key, "Error_Message").collect()}


def test_conform_pads_case_insensitively(spark):
    df = frame(spark, [(" x ", 1)], "BAN string, extra int")
    got = conform(df, ["Ban", "State"])
    assert got.columns == ["Ban", "extra", "State", "Error_Columns", "Error_Message"]
    assert trim_all(got).first()["Ban"] == "x"
    assert conform(df.limit(0), ["State"]).count() == 0


def test_fill_and_default(spark):
    df = frame(spark, [(1, None, "b"), (2, "a", "b"), (3, None, None)], "id int, a string, b string")
    assert [r[1] for r in coalesce_from(df, {"a": "b"}).orderBy("id").collect()] == ["b", "a", None]
    got = default_where(df, F.col("a") == "a", {"b": "new"}).orderBy("id").collect()
    assert [r["b"] for r in got] == ["b", "new", None]


def test_initial_status(spark):
    df = frame(
        spark,
        [(1, "Given", "Email"), (2, None, "Email"), (3, None, "STC"), (4, None, None)],
        "id int, s string, t string",
    )
    got = [r[0] for r in df.orderBy("id").select(initial_status("s", "t")).collect()]
    assert got == ["Given", "Filed", "Pending Review", "Pending Review"]


def test_predicates_keep_three_valued_logic(spark):
    df = frame(spark, [("unmapped",), ("zero",), (None,)], "TAG string")
    assert df.filter(tag_is("unmapped")).count() == 1
    assert df.filter(tag_is_not("unmapped")).count() == 1
    q = frame(spark, [(None, None), ("x", None), ("x", "y")], "a string, b string")
    assert q.filter(pending(("a", "b"), "all")).count() == 1
    assert q.filter(pending(("a", "b"), "any")).count() == 2


def test_eligible(spark):
    schema = "id int, Status string, Dispute_Category string, Display_Status string, Dispute_Type string"
    df = frame(
        spark,
        [
            (1, "Open", "C", "Denied - Pending", "STC"),
            (2, "Open", "C", "Filed", "Email"),
            (3, "Open", "C", "Filed", "STC"),
            (4, "Closed", "C", "Denied - Pending", "STC"),
            (5, "Open", "D", "Denied - Pending", "STC"),
            (6, "Open", "C", "Denied - Pending", None),
            (7, "Open", "C", None, "Email"),
        ],
        schema,
    )
    ids = {r[0] for r in df.filter(eligible(("Denied - Pending",), "C")).collect()}
    assert ids == {1, 2, 6, 7}
    assert {r[0] for r in df.filter(eligible(None, "C")).collect()} == {1, 2, 3, 6, 7}


def test_unlisted_action_is_an_error(spark):
    df = conform(frame(spark, [(1, "Map"), (2, "Nope"), (3, None)], "id int, Action string"), [])
    flagged = flag_unlisted(df, "Action", ["Map"])
    assert messages(flagged) == {1: None, 2: "Nope is not a listed Action", 3: "(none) is not a listed Action"}
    assert split_by(flagged, "Action", ["Map"])["Map"].count() == 1


def test_amount_rules(spark):
    given = ["5", "0", "-1", "1e5", "$5", "1,234", "abc", "", None]
    df = conform(frame(spark, list(enumerate(given)), "id int, amt string"), [])
    got = messages(validate(df, amount_rules("amt")))
    assert got == {
        0: None,
        1: "amt is <= 0",
        2: "amt is <= 0",
        3: None,
        4: None,
        5: None,
        6: "amt is not numeric",
        7: "amt is not numeric",
        8: None,
    }


def test_date_rules(spark):
    given = ["2024-02-29", "2024-02-28", "2024-01-31", "2023-12-31", "nope", None, "2/29/2024"]
    df = conform(frame(spark, list(enumerate(given)), "id int, d string"), [])
    got = messages(validate(df, date_rules("d", NOW)))
    assert got == {
        0: None,
        1: "d is not the end of the month",
        2: "d is in the past",
        3: "d is in the past",
        4: "d is not a date",
        5: None,
        6: None,
    }
    bill = messages(validate(df, bill_date_rules("d", NOW)))
    assert [k for k, v in bill.items() if v] == [4]
    late = conform(frame(spark, [(1, "2024-02-10"), (2, "2024-03-01")], "id int, d string"), [])
    assert messages(validate(late, bill_date_rules("d", NOW))) == {1: None, 2: "d is in the future"}


def test_first_error_wins(spark):
    df = frame(spark, [(1, "old", "old error"), (2, None, None)], f"id int, {E}")
    rules = [Rule("a", "first", F.col("id") > 0), Rule("b", "second", F.col("id") > 0)]
    assert messages(validate(df, rules)) == {1: "old error", 2: "first"}


def test_existence_rules(spark):
    df = conform(frame(spark, [(1, "a"), (2, "b"), (3, None), (4, "c")], "id int, k string"), [])
    ref = frame(spark, [("a", "Email"), ("a", "Email"), ("b", "STC"), (None, "x")], "k string, t string")
    assert messages(must_exist(df, ref, ["k"], "k", "no")) == {1: None, 2: None, 3: "no", 4: "no"}
    assert messages(must_derive(df, ref.limit(0), ["k"], "k", "none")) == dict.fromkeys([1, 2, 3, 4], "none")
    typed = must_exist_with(df, ref.dropDuplicates(["k"]), "k", F.col("t") != "Email", "k", "no", "wrong")
    assert messages(typed) == {1: None, 2: "wrong", 3: "no", 4: "no"}


def test_null_type_passes_the_type_rule(spark):
    df = conform(frame(spark, [(1, "a")], "id int, k string"), [])
    ref = frame(spark, [("a", None)], "k string, t string")
    got = must_exist_with(df, ref, "k", F.col("t") != "Email", "k", "no", "wrong")
    assert messages(got) == {1: None}


def test_repeats_and_propagation_with_a_hot_key(spark):
    data = [(i, "hot" if i % 3 else f"k{i}", None, None) for i in range(3000)]
    data[7] = (7, "hot", "c", "bad")
    data[4] = (4, "hot", "c", "bad first")
    df = frame(spark, data, f"id int, k string, {E}").repartition(5)
    spread = messages(propagate_error(df, ["k"], "id"))
    for i in range(3000):
        hot = i % 3 != 0
        want = {7: "bad", 4: "bad first"}.get(i, "bad first" if hot else None)
        assert spread[i] == want
    once = messages(flag_repeats(df, ["k"], "id", "k", "again"))
    assert once[1] is None and once[4] == "bad first" and once[7] == "bad"
    assert all(once[i] == "again" for i in range(2, 3000) if i % 3 and i not in (4, 7))


def test_ticket_status(spark):
    df = conform(frame(spark, [(1, "10"), (2, "11"), (3, "12"), (4, "x"), (5, None)], "id int, Ticket string"), [])
    core = frame(spark, [(10, 1), (11, None)], "Ticket_ID int, Ticket_Status_ID int")
    status = frame(spark, [(1, "Closed")], "Ticket_Status_ID int, Status string")
    got = ticket_status(validate(df, amount_rules("Ticket")), core, status)
    text = {r[0]: r[1] for r in got.select("id", "Ticket").collect()}
    missing = "Ticket is not a known ticket"
    assert messages(got) == {1: None, 2: missing, 3: missing, 4: "Ticket is not numeric", 5: missing}
    assert text == {1: "10 - Closed", 2: "11", 3: "12", 4: "x", 5: None}


def test_split_and_summary_cover_every_row(spark):
    rng = random.Random(3)
    data = [(i, rng.choice("ab"), rng.choice(["1", "x", "-2", None])) for i in range(500)]
    df = validate(conform(frame(spark, data, "id int, g string, amt string"), []), amount_rules("amt"))
    good, bad = split_results(df)
    assert good.count() + bad.count() == 500
    summary = outcome_summary(df, "g").collect()
    assert sum(r["N_Ok"] + r["N_Error"] for r in summary) == 500


def test_joins(spark, rows):
    left = frame(spark, [(1, "a"), (2, "b"), (3, None)], "id int, k string")
    ref = frame(spark, [("a", "A"), ("c", "C"), (None, "N")], "k string, v string")
    assert rows(lookup(left, ref, ["k"], {"v": "v"}, "m"), "id", "v", "m") == [
        (1, "A", True),
        (2, None, False),
        (3, None, False),
    ]
    assert rows(narrow(ref, left, ["k"])) == [("a", "A")]
    assert mark_existing(left, ref.union(ref), ["k"], "m").count() == 3
    other = conditional_lookup(left, ref, F.col("id") == 2, ["k"], {"v": "v"})
    assert rows(other, "id", "v") == [(1, None), (2, None), (3, None)]
    staff = frame(spark, [("a", "Ann", "A"), ("a", "Ann", "A")], "Comp_Serial string, Full_Name string, Initials string")
    who = with_employee(left.withColumnRenamed("k", "Comp_Serial"), staff)
    assert rows(who, "id", "Full_Name", "_has_employee") == [(1, "Ann", True), (2, None, False), (3, None, False)]
    assert prefixed(left, "p_").columns == ["p_id", "p_k"]


def test_text_keys_meet_number_keys(spark, rows):
    left = frame(spark, [(1, "007"), (2, "7"), (3, "x7"), (4, None), (5, "8")], "id int, k string")
    ref = frame(spark, [(7,), (9,)], "k bigint")
    want = [(1, True), (2, True), (3, False), (4, False), (5, False)]
    assert rows(mark_existing(left, ref, ["k"], "m"), "id", "m") == want
    for own in (False, True):
        found = lookup(left, ref.withColumn("v", F.lit("v")), ["k"], {"v": "v"}, "m", own_shuffle=own)
        assert rows(found, "id", "m") == want
    assert rows(narrow(ref, left, ["k"]), "k") == [(7,)]
    assert rows(narrow(left, ref, ["k"]), "id") == [(1,), (2,)]
    # The other way round, two spellings of one key do not multiply a row.
    numbers, texts = frame(spark, [(7,), (9,)], "k bigint"), frame(spark, [("07",), ("7",)], "k string")
    assert rows(mark_existing(numbers, texts, ["k"], "m"), "k", "m") == [(7, True), (9, False)]


def test_repeated_changes_do_not_multiply_the_target(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b")], "k int, v string")
    changes = frame(spark, [(1, "x"), (1, "y")], "k int, v string")
    assert rows(apply_updates(target, changes, ["k"], ["v"]), "k", "v") == [(1, "y"), (2, "b")]


def test_effective_join_matches_brute_force(spark):
    rng = random.Random(11)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(1500))
    master = []
    for i in range(60):
        first = day()
        last = None if i % 5 == 0 else first + dt.timedelta(days=rng.randrange(-60, 400))
        master.append((f"b{i % 12}", i, first, last))
    facts = [(i, None if i % 17 == 0 else f"b{i % 14}", None if i % 19 == 0 else day()) for i in range(400)]
    m = frame(spark, master, "BAN string, ID int, Start_Date date, End_Date date")
    f = frame(spark, facts, "id int, BAN string, at date")
    as_of = dt.date(2024, 1, 31)
    got = {r[0]: r[1] for r in join_effective(f, m, as_of, "at", {"m": "ID"}).select("id", "m").collect()}
    month = lambda d: (d.year, d.month)
    for i, ban, at in facts:
        hits = [
            (s, x)
            for b, x, s, e in master
            if ban is not None and b == ban and at is not None and month(s) <= month(at) <= month(e or as_of)
        ]
        assert got[i] == (max(hits)[1] if hits else None)
    assert len(got) == 400
    calendar = account_calendar(f.select("BAN", F.last_day("at").alias("Month_End")), m, as_of)
    assert calendar.groupBy("BAN", "Month_End").count().filter("count > 1").isEmpty()
    overlaps = {(r["BAN"], r["Month_End"]): r["Periods"] for r in calendar.collect()}
    for (ban, end), n in overlaps.items():
        assert n == sum(b == ban and month(s) <= month(end) <= month(e or as_of) for b, _, s, e in master)


def test_relational(spark, rows):
    df = frame(spark, [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), (None, 5, "n")], "k string, o int, v string")
    assert rows(latest_by(df, ["k"], ["o", "v"])) == [("a", 3, "z"), (None, 5, "n")]
    assert rows(first_per(df, ["k"], [F.col("o").desc(), F.col("v").asc()])) == [("a", 3, "y"), (None, 5, "n")]
    other = frame(spark, [("a", 9)], "k string, w int")
    merged = collect_errors(df, df, other)
    assert merged.count() == 5 and merged.columns == ["k", "o", "v", "w"]
    text = frame(spark, [(1, "a, b,c"), (2, "d"), (3, "")], "id int, s string")
    assert rows(explode_csv(text, "s", "many")) == [(1, "a", 1), (1, "b", 1), (1, "c", 1), (2, "d", 0), (3, "", 0)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_ids_are_dense_and_do_not_depend_on_partitions(spark, partitions):
    values = list(range(1000))
    random.Random(partitions).shuffle(values)
    df = frame(spark, [(v,) for v in values], "v int").repartition(partitions)
    got = assign_ids(df, ["v"], {"a": 10, "b": 1}, partitions=partitions)
    assert {r["v"]: (r["a"], r["b"]) for r in got.collect()} == {v: (10 + v, 1 + v) for v in values}


def test_ids_of_copies_and_of_nothing(spark):
    same = spark.range(5000).select(F.lit(1).alias("v"))
    got = assign_ids(same, ["v"], 1, "id", partitions=6, break_ties=True)
    ids = [r["id"] for r in got.collect()]
    assert sorted(ids) == list(range(1, 5001))
    sizes = got.groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 2500
    assert assign_ids(same.limit(0), ["v"]).count() == 0
    assert next_id(same.limit(0), "v") == 1


def test_stable_copy_lies_in_the_named_folder(spark):
    import os

    before = len(os.listdir(work_dir(spark)))
    copy = stable(spark.range(3))
    assert copy.count() == 3 and len(os.listdir(work_dir(spark))) == before + 1
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_apply_updates(spark, rows):
    target = frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (None, "c", 3.0)], "id int, s string, x double")
    changes = frame(
        spark,
        [(1, "new", None, 2), (1, "lost", 9.0, 1), (7, "none", 1.0, 1), (None, "null", 0.0, 1)],
        "id int, s string, x double, n int",
    )
    got = apply_updates(target, changes, ["id"], ["s", "x"], order=[F.col("n").desc()])
    assert rows(got) == [(1, "new", None), (2, "b", 2.0), (None, "c", 3.0)]
    again = apply_updates(got, changes, ["id"], ["s", "x"], order=[F.col("n").desc()])
    assert rows(again) == rows(got)
    added = apply_updates(target, changes.filter("n = 2").select("id", F.lit("q").alias("y")), ["id"], ["y"])
    assert rows(added, "id", "y") == [(1, "q"), (2, None), (None, None)]


def test_default_start(spark, rows):
    sub = frame(spark, [(1, dt.date(2024, 1, 15)), (2, None), (3, None)], "Source_No long, Start_Date date")
    inv = frame(spark, [(1, "b"), (2, "b")], "BMI_ID long, BAN string")
    lim = frame(spark, [("b", 60)], "BAN string, Dispute_Limit int")
    got = rows(default_start(sub, inv, lim, NOW), "Source_No", "Start_Date")
    # 2024-01-31 - 60 + 15 days = 2023-12-17; then the end of the month before.
    assert got == [(1, dt.date(2023, 12, 31)), (2, dt.date(2023, 11, 30)), (3, None)]


def test_stamp_worklist(spark, rows):
    sub = frame(
        spark,
        [
            (1, "BMI", "1", "A", "why", None, None),
            (2, "BMI", "1", "B", "later", None, None),
            (3, "PCI", "1", "A", "other", None, None),
            (4, "BMI", "2", "A", "bad", "x", "x"),
            (5, "BMI", "3", "A", "zero", None, None),
            (6, "BMI", "4", "A", "untagged", None, None),
        ],
        f"Line_ID int, Source_TBL string, Source_ID string, Initials string, Why string, {E}",
    )
    work = frame(
        spark,
        [
            ("BMI", "1", "unmapped", None, None, None, None, None),
            ("BMI", "2", "unmapped", None, None, None, None, None),
            ("BMI", "3", "zero", None, None, None, None, None),
            ("BMI", "4", None, None, None, None, None, None),
            ("PCI", "9", "zero", None, None, None, None, None),
        ],
        "Source_TBL string, Source_ID string, TAG string, Max_CNR_Date date, Audit_Result string, "
        "Rep string, Comment string, Edit_Date timestamp_ntz",
    )
    unmapped, zero, new = stamp_worklist(sub, work, "Dispute Review", NOW, "Why", "Act")
    assert rows(unmapped, "Line_ID", "Rep", "Comment") == [(1, "A", "Act - why"), (2, "B", "Act - later")]
    assert rows(zero, "Line_ID", "Tag") == [(5, "zero")]
    assert rows(new, "Source_TBL", "Source_ID", "Rep", "Comment") == [
        ("BMI", "1", "B", "Act - later"),
        ("BMI", "2", None, None),
        ("BMI", "3", "A", "Act - zero"),
        ("BMI", "4", None, None),
        ("PCI", "9", None, None),
    ]


def test_mine_cost_unions_all_charge_tables(spark, rows):
    d = dt.date
    sub = frame(
        spark,
        [(1, "BMI", "1", 1, d(2024, 1, 31)), (2, "PCI", "5", 5, d(2024, 1, 31)), (3, "BMI", "x", None, d(2024, 1, 31))],
        "Line_ID int, Source_TBL string, Source_ID string, Source_No long, Start_Date date",
    )
    tables = {
        "mrc": frame(
            spark,
            [(1, d(2024, 2, 1), 7, 5.0), (1, d(2024, 1, 31), 8, 5.0), (1, d(2024, 3, 1), 9, 0.0)],
            "BMI_ID long, Invoice_Date date, BDT_MRC_ID long, Amount double",
        ),
        "occ": frame(
            spark,
            [("V", "B", "W", "C", d(2024, 2, 2), 4, "install", 1.0), ("V", "B", None, "C", d(2024, 2, 2), 5, "x", 1.0)],
            "Vendor string, BAN string, BTN string, Circuit_ID string, Invoice_Date date, "
            "BDT_OCC_ID long, Activity_Type string, Amount double",
        ),
        "bmi": frame(
            spark,
            [(1, "V", "B", "W", "C")],
            "BMI_ID long, Vendor string, BAN string, WTN string, Circuit_ID string",
        ),
        "paper_cost": frame(
            spark,
            [(5, 3, d(2024, 2, 5), 1.0, 0.0, 2.0)],
            "PCI_ID long, Seed long, Bill_Date date, MRC double, NRC double, FRAC double",
        ),
    }
    got = rows(mine_cost(sub, tables), "Line_ID", "Seed", "Cost_Type", "Record_Type")
    assert got == [
        (1, "4", "OCC", "INSTALL"),
        (1, "7", "MRC", "MRC"),
        (2, "3", "PC-FRAC", "FRAC"),
        (2, "3", "PC-MRC", "MRC"),
    ]
