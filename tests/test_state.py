"""Keys, counters and the layered state of a folder run; pruned mining."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import NOW, errors, frame, state, tables  # noqa: F401 - the fixture

from ledgerflow.operators.keys import number_lines, stable
from ledgerflow.operators.mining import mine_cost
from ledgerflow.plans import run, tables as plan_tables
from ledgerflow.plans.dispute import seed_disputes
from ledgerflow.plans.run import advance, review_folder
from ledgerflow.plans.state import Layers, changed_rows, compact, load_counters, load_state, save_base
from ledgerflow.plans.tables import JobResult
from ledgerflow.streaming.intake import serve_batch

REVIEW = "Line_ID long, Action string, Source_TBL string, Source_ID string, Comp_Serial string, Start_Date string, Amount_Or_Days string, Credit_Invoice_Date string"
ACTION = "Folder_Name string, Action string, DSB_ID string, Comp_Serial string, Action_Reason string"


def files_read(df):
    """For each file that the plan's scans read, how many scans read it."""
    plan = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    counts: dict[str, int] = {}
    for i in range(plan.size()):
        leaf = plan.apply(i)
        if not leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            continue
        paths = leaf.relation().location().rootPaths()
        for k in range(paths.size()):
            path = paths.apply(k).toString()
            counts[path] = counts.get(path, 0) + 1
    return counts


@pytest.mark.parametrize("bits", [0, 3, 14])
def test_number_lines_follows_the_lines(spark, rows, bits):
    """As `row_number` over all rows, whatever the gaps between the lines."""
    lines = [k for k in range(50)] + [(1 << 33) + 7 * k for k in range(50)] + [(5 << 33) + 3, (1 << 60) + 1]
    df = stable(frame(spark, [(x, str(x)) for x in lines], "Line_ID long, v string").repartition(7))
    got, total = number_lines(df, {"a": 10, "b": 1}, bits=bits)
    want = [(x, str(x), 10 + i, 1 + i) for i, x in enumerate(sorted(lines))]
    assert sorted(tuple(r) for r in got.collect()) == want and total == len(lines)
    none, total = number_lines(df.limit(0), {"a": 10}, bits=bits)
    assert none.count() == 0 and total == 0


def test_lines_in_a_bucket_are_bounded(spark):
    """No window holds more than 2^bits lines, and nothing is range-partitioned."""
    df = stable(spark.range(5000).select(F.col("id").alias("Line_ID")))
    got, _ = number_lines(df, {"a": 1}, bits=8)
    assert got.agg(F.min(F.col("a") - F.col("Line_ID")), F.max(F.col("a") - F.col("Line_ID"))).first()[:] == (1, 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_new_disputes_are_looked_up_once(spark, tables):  # noqa: F811
    """The four tables are columns of one written copy; the keys follow the lines."""
    rows = [(k, "S1", "MRC", "900") for k in (3, 1, 2)]
    sub = frame(spark, rows, "Line_ID long, Comp_Serial string, Cost_Type string, Cost_Type_Seed string")
    result = seed_disputes(sub, tables, NOW)
    read = [files_read(df) for df in result.appends.values()]
    assert all(len(r) == 1 for r in read) and len({next(iter(r)) for r in read}) == 1
    header, detail = (result.appends[t].orderBy("DSB_ID").collect() for t in ("dispute_header", "dispute_detail"))
    assert [(r["DSB_ID"], r["Orig_DH_ID"]) for r in header] == [(6, 105), (7, 106), (8, 107)]
    assert [(r["DS_ID"], r["DSB_ID"]) for r in detail] == [(1, 6), (2, 7), (3, 8)]
    assert result.counters == {"DSB_ID": 9, "DS_ID": 4, "DH_ID": 108}
    told = seed_disputes(sub, {k: v for k, v in tables.items() if not k.startswith("dispute_")}, NOW, starts={"DSB_ID": 50, "DS_ID": 60, "DH_ID": 70})
    assert sorted(r["DSB_ID"] for r in told.appends["dispute_header"].collect()) == [50, 51, 52]


def test_counters_go_from_batch_to_batch(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    """The keys in use are looked for once, when the state is made; replays repeat their keys."""
    root = str(tmp_path)
    save_base(tables, root)
    assert load_counters(spark, root, 0) == {"DSB_ID": 6, "DS_ID": 1, "DH_ID": 105, "DN_ID": 1}

    def never(*_):
        raise AssertionError("the table was searched for its greatest key")

    monkeypatch.setattr(plan_tables, "next_id", never)
    for batch_id in (0, 1, 1):  # the second is served twice
        batch = frame(spark, [("04_Dispute-Actions", "Escalate", str(batch_id + 1), "S1", "why")], ACTION)
        serve_batch(batch.withColumn("Folder_Rank", F.lit(4)), batch_id, lambda n: load_state(spark, root, n), root, lambda: NOW)
    assert load_counters(spark, root, 1)["DH_ID"] == 106
    assert load_counters(spark, root, 9) == {"DSB_ID": 6, "DS_ID": 1, "DH_ID": 107, "DN_ID": 1}
    history = load_state(spark, root, 9, ["dispute_history"])["dispute_history"]
    assert sorted(r["DH_ID"] for r in history.collect()) == [101, 102, 103, 104, 105, 106]
    monkeypatch.undo()
    compact(spark, root, 1, ["dispute_history", "dispute_header"])
    assert load_counters(spark, root, 9)["DSB_ID"] == 6


def test_fifth_action_reads_each_table_once(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    """Whatever came before, a table is its base and one written layer."""
    based = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        based[name] = spark.read.parquet(f"{tmp_path}/{name}")
    listed = ["Dispute Note", "Escalate Disputes", "Close Disputes", "Send to Audit", "Call A"]
    sub = frame(
        spark, [(i, a, "BMI", "11", "S1", None, "5", None) for i, a in enumerate(listed)], REVIEW
    )
    seen = []
    real = run.other_job
    monkeypatch.setattr(run, "other_job", lambda part, t, *a, **k: seen.append(t) or real(part, t, *a, **k))
    result = review_folder(sub, based, NOW, run.JobConfig(other_review_actions=("Call A",)))
    assert len(seen) == 1  # the fifth
    for name in ("worklist", "dispute_current"):
        read = files_read(seen[0][name])
        assert read.pop(next(p for p in read if p.endswith(f"/{name}"))) == 1
        assert len(read) == 1  # the layer: once for its keys, once for its rows
        assert sum(files_read(result.snapshots[name]).values()) <= 3
    after = state(result.snapshots["dispute_current"])
    assert after[1]["Status"] == "Open" and after[2]["Status"] == "Closed" and after[2]["Dispute_Note"] is None
    work = {(r["Source_TBL"], r["Source_ID"]): r["Audit_Result"] for r in result.snapshots["worklist"].collect()}
    assert work == {("BMI", "11"): "Call A", ("BMI", "12"): None, ("PCI", "11"): None}


def test_rows_added_and_then_changed_are_there_once(spark, tables):  # noqa: F811
    """A file that opens disputes and moves them: the state holds each once, as it was left."""
    charged = frame(spark, [(12, "V", "B1", "W", "C")], "BMI_ID long, Vendor string, BAN string, WTN string, Circuit_ID string")
    world = {**tables, "bmi": charged}
    sub = frame(
        spark,
        [(1, "Dispute", "BMI", "12", "S1", "2023-11-30", None, None), (2, "Dispute Note", "BMI", "12", "S1", None, "5", None)],
        REVIEW,
    )
    result = review_folder(sub, world, NOW)
    assert set(errors(result).values()) == {None}
    after = advance(world, result)["dispute_current"].collect()
    assert sorted(r["DSB_ID"] for r in after) == [1, 2, 3, 4, 5, 6, 7]
    noted = {r["DSB_ID"] for r in after if r["DN_ID"] is not None}
    assert noted == {3, 6, 7}
    assert {r["DSB_ID"] for r in changed_rows(result)["dispute_current"].collect()} == {3, 6, 7}


def test_layers_keep_the_last_state_of_a_key(spark):
    base = frame(spark, [(1, "a"), (2, "b"), (None, "c")], "DSB_ID long, v string")
    layers = Layers({"dispute_current": base})
    for rows in ([(1, "x")], [(1, "y"), (None, "z")], [(3, "new"), (3, "twin")]):
        layers.push(JobResult(base, changed={}, snapshots={"dispute_current": frame(spark, rows, "DSB_ID long, v string")},
                              changes={"dispute_current": frame(spark, rows, "DSB_ID long, v string")}))
    got = sorted((r["DSB_ID"] or 0, r["v"]) for r in layers.table("dispute_current").collect())
    assert got == [(0, "c"), (1, "y"), (2, "b"), (3, "new"), (3, "twin")]


# --- mining ---------------------------------------------------------------------------


def mined_world(spark, tables, tmp_path):  # noqa: F811
    """Charges laid out by invoice date."""
    out = dict(tables)
    months = [dt.date(2023, m, 28) for m in range(1, 13)]
    for name, key in (("mrc", "BDT_MRC_ID"), ("occ", "BDT_OCC_ID")):
        shape = tables[name].schema
        rows = []
        for i, day in enumerate(months):
            for source, line, circuit in ((11, "X", "C"), (12, "", "  "), (13, "", "")):
                row = dict.fromkeys(shape.names)
                row |= {"Vendor": "V", "BAN": "B1", "BTN": line, "Circuit_ID": circuit, "Invoice_Date": day, "Bill_Date": day,
                        "Amount": 5.0, key: 1000 * source + i, "State": "TX"}
                row |= {"BMI_ID": source} if name == "mrc" else {"Activity_Type": "once"}
                rows.append(tuple(row[c] for c in shape.names))
        frame(spark, rows, shape).write.partitionBy("Invoice_Date").parquet(f"{tmp_path}/{name}")
        out[name] = spark.read.parquet(f"{tmp_path}/{name}")
    out["bmi"] = frame(spark, [(11, "V", "B1", "X", "C"), (12, "V", "B1", "", "  "), (13, "V", "B1", None, "")],
                       "BMI_ID long, Vendor string, BAN string, WTN string, Circuit_ID string")
    return out


def submitted(spark):
    rows = [(1, 11, "11", "BMI", dt.date(2023, 10, 31)), (2, 12, "12", "BMI", dt.date(2023, 11, 30)), (3, 13, "13", "BMI", dt.date(2023, 11, 30))]
    return frame(spark, rows, "Line_ID long, Source_No long, Source_ID string, Source_TBL string, Start_Date date")


def test_least_start_prunes_the_partitions(spark, tables, tmp_path):  # noqa: F811
    world = mined_world(spark, tables, tmp_path)
    got = mine_cost(submitted(spark), world)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and ("/mrc" in line or "/occ" in line)]
    assert len(scans) == 2  # one of each
    assert all("PartitionFilters: [" in s and "(Invoice_Date" in s.split("PartitionFilters: [")[1].split("]")[0] and "2023-10-31" in s for s in scans)
    rows = [(r["Line_ID"], r["Cost_Type"], int(r["Seed"])) for r in got.collect()]
    assert sorted(r for r in rows if r[1] == "MRC") == [(1, "MRC", 11010), (1, "MRC", 11011), (2, "MRC", 12011), (3, "MRC", 13011)]
    # Sources 12 and 13 name no line, so they do not meet the charges that name none.
    assert sorted(r for r in rows if r[1] == "OCC") == [(1, "OCC", 11010), (1, "OCC", 11011)]


def test_carried_charges_are_what_a_lookup_finds(spark, tables, tmp_path):  # noqa: F811
    from ledgerflow.operators.enrich import CARRIED, enrich_by_cost_type, enrich_carried
    from ledgerflow.operators.conform import conform
    from ledgerflow.plans.dispute import SEED_COLUMNS

    world = mined_world(spark, tables, tmp_path)
    world["mrc_cmp"] = frame(spark, [(11010, dt.date(2023, 11, 28), c, b) for c, b in (("CP2", 7), ("CP1", 9))],
                             "BDT_MRC_ID long, Invoice_Date date, CPID string, BANMasterID long")
    mined = conform(mine_cost(submitted(spark), world, carry=True).withColumnRenamed("Seed", "Cost_Type_Seed"), SEED_COLUMNS)
    carried = enrich_carried(mined)
    looked = enrich_by_cost_type(mined.drop(CARRIED), world)
    assert carried.columns == looked.columns
    assert sorted(map(repr, carried.collect())) == sorted(map(repr, looked.collect()))
    assert {r["CPID"] for r in carried.collect()} == {"CP1", None}


def test_a_charge_makes_its_offer_after_it_met_a_source(spark, tables, tmp_path):  # noqa: F811
    """What a charge offers is not made, nor moved, for charges that no source takes."""
    from ledgerflow.operators.enrich import CARRIED
    from ledgerflow.operators.mining import paper, recurring

    world, since = mined_world(spark, tables, tmp_path), dt.date(2023, 10, 31)
    sub = submitted(spark)
    for got in (recurring(sub, world["mrc"], since, world["mrc_cmp"]), paper(sub, world["paper_cost"], since, True)):
        lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
        at = next(i for i, x in enumerate(lines) if "Join Inner" in x)
        below = [x for x, d in list(zip(lines, depth))[at + 1 :] if d > depth[at]]
        assert below and any(CARRIED in x for x in lines[:at])
        assert not any(f" AS {CARRIED}#" in x or "Record_Type" in x for x in below)


def test_mining_nothing(spark, tables, tmp_path):  # noqa: F811
    assert mine_cost(submitted(spark).limit(0), mined_world(spark, tables, tmp_path)).count() == 0
