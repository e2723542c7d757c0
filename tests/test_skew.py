"""A key with a third of the rows is split by adaptive execution, in the shapes the operators build."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import JobConfig
from ledgerflow.operators.conform import conform
from ledgerflow.operators.joins import lookup, mark_existing, narrow
from ledgerflow.operators.relational import first_per
from ledgerflow.operators.updates import apply_updates
from ledgerflow.operators.validate import flag_repeats, must_exist, propagate_error
from ledgerflow.plans import transitions
from ledgerflow.plans.transitions import ACTION_COLUMNS, SPECS, direct_actions, judge

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "6",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    n = 200_000
    yield spark.range(0, n, 1, 6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") == 30, "k").alias("Error_Columns"),
        F.when(F.col("id") == 30, "bad").alias("Error_Message"),
    )
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def is_split(spark, df):
    """Run the frame and tell whether a skewed join was split."""
    df.createOrReplaceTempView("hot")
    kept = spark.table("hot")
    rows = kept.toArrow().num_rows
    return rows, "skew=true" in kept._jdf.queryExecution().executedPlan().toString()


def ref_of(df):
    return df.select("k", F.lit(1).alias("v")).distinct()


def test_lookup_is_split(spark, skewed):
    ref = spark.range(-1, 200_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    rows, split = is_split(spark, lookup(skewed, ref, ["k"], {"v": "v"}))
    assert rows == 200_000 and split


def test_existence_check_is_split(spark, skewed):
    rows, split = is_split(spark, must_exist(skewed, ref_of(skewed), ["k"], "k", "no"))
    assert rows == 200_000 and split


def test_repeats_are_split(spark, skewed):
    flagged = flag_repeats(skewed, ["k"], "id", "k", "again")
    rows, split = is_split(spark, flagged)
    assert rows == 200_000 and split
    hot = 200_000 // 3 + 1
    assert flagged.filter("Error_Message = 'again'").count() == hot - 2


def test_sibling_errors_are_split(spark, skewed):
    spread = propagate_error(skewed, ["k"], "id")
    rows, split = is_split(spark, spread)
    assert rows == 200_000 and split
    assert spread.filter("Error_Message = 'bad'").count() == 200_000 // 3 + 1


def test_update_of_a_hot_target_is_split(spark, skewed):
    changes = ref_of(skewed).withColumn("payload", F.lit("new"))
    rows, split = is_split(spark, apply_updates(skewed, changes, ["k"], ["payload"]))
    assert rows == 200_000 and split


def test_update_with_ranked_changes_is_split(spark, skewed):
    changes = skewed.select("k", F.lit("new").alias("payload"), "id")
    updated = apply_updates(skewed, changes, ["k"], ["payload"], order=[F.col("id").asc()])
    rows, split = is_split(spark, updated)
    assert rows == 200_000 and split


def test_narrowing_a_hot_table_is_split(spark, skewed):
    rows, split = is_split(spark, narrow(skewed, ref_of(skewed), ["k"]))
    assert rows == 200_000 and split


def test_key_types_may_differ(spark, skewed):
    ints = skewed.select("id", F.col("k").cast("int").alias("k"))
    known = mark_existing(ints, ref_of(skewed), ["k"], "known")
    assert known.filter("known").count() == 200_000
    assert narrow(ints, ref_of(skewed), ["k"]).count() == 200_000


def test_narrow_sends_a_hot_key_once(spark, skewed):
    ref = spark.range(-1, 1000).select(F.col("id").alias("k"))
    assert narrow(ref, skewed, ["k"]).count() == 1 + sum(1 for i in range(1000) if i % 3)


def test_first_per_cuts_groups_before_the_shuffle(spark, skewed):
    one = first_per(skewed, ["k"], [F.col("id").desc()])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert one.count() == ref_of(skewed).count()


def above(plan: str, leaf: str) -> list[list[str]]:
    """For each scan of the table, the operators above it, from the scan up."""
    lines, found = plan.splitlines(), []
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for i, line in enumerate(lines):
        if leaf in line and "Scan" in line:
            chain, at = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    chain.append(lines[j].strip(" :+-*()0123456789"))
                    at = depth[j]
            found.append(chain)
    return found


@pytest.fixture
def kept(spark, skewed):
    """A state table in buckets of its key, next to a batch of which a third names one key."""
    from ledgerflow.plans.tables import load_bucketed, save_bucketed

    state = spark.range(-1, 200_000).select(F.col("id").alias("DSB_ID"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    save_bucketed({"dispute_current": state}, 6, "skew_")
    yield load_bucketed(spark, "skew_", ["dispute_current"])["dispute_current"]
    spark.sql("DROP TABLE skew_dispute_current")


def test_table_in_buckets_is_not_moved(spark, skewed, kept):
    batch = skewed.withColumn("DSB_ID", F.col("k").cast("string"))  # a file's keys are text
    part = narrow(kept, batch, ["DSB_ID"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    (chain,) = above(plan, "skew_dispute_current")
    joins = [i for i, op in enumerate(chain) if "Join" in op]
    assert joins and not any(op.startswith("Exchange") for op in chain[: joins[0]])
    # The same table without buckets is shuffled.
    plain = narrow(kept.select(F.col("DSB_ID").alias("DSB_ID", metadata={}), "v"), batch, ["DSB_ID"])
    (chain,) = above(plain._jdf.queryExecution().executedPlan().toString(), "skew_dispute_current")
    assert any(op.startswith("Exchange") for op in chain)
    assert part.count() == plain.count() == 133_334


def test_hot_key_that_meets_a_bucket_is_split(spark, skewed, kept):
    batch = skewed.withColumnRenamed("k", "DSB_ID")
    rows, split = is_split(spark, lookup(batch, narrow(kept, batch, ["DSB_ID"]), ["DSB_ID"], {"v": "v"}, "_has"))
    assert rows == 200_000 and split


def in_one_partition(df):
    """The greatest share of the rows that one partition holds."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_rows_without_a_key_are_dealt_out(spark, skewed):
    rows = skewed.withColumn("k", F.when(F.col("id") % 3 == 0, F.col("id")))
    ref = spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    got = lookup(rows, ref, ["k"], {"v": "v"}, "hit", spread="id").localCheckpoint()
    assert got.filter("hit <> (k IS NOT NULL) OR v <> k").count() == 0 and got.count() == 200_000


def test_actions_without_a_dispute_do_not_meet_in_one_task(spark, skewed):
    """None of the actions has a prior version to be looked up by; they stay apart all the same."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        act = spark.range(2000).select(F.col("id").alias("Line_ID"), F.lit("Close").alias("Action"), F.col("id").cast("string").alias("DSB_ID"), F.lit("S1").alias("Comp_Serial"))
        tables = {
            "employee": spark.createDataFrame([("S1", "One", "O")], "Comp_Serial string, Full_Name string, Initials string"),
            "dispute_current": spark.createDataFrame([(7, 70, "Email"), (8, None, "Email"), (9, 90, "Email")], "DSB_ID bigint, DH_ID bigint, Dispute_Type string"),
            "dispute_history": spark.createDataFrame([(70, 7)], "DH_ID bigint, DSB_ID bigint"),
        }
        got = judge(conform(act, ACTION_COLUMNS), tables, {"Close": SPECS["Close"]}, "2024-01-31 12:00:00", JobConfig())
        assert in_one_partition(got) < 0.5
        errors = {r["Line_ID"]: r["Error_Message"] for r in got.filter("Line_ID < 10").collect()}
        prior = "DSB_ID has no prior version in Dispute History"
        assert errors == dict.fromkeys(range(7), "DSB_ID does not exist in Dispute Current") | {7: None, 8: prior, 9: prior}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_repeated_actions_are_compared(spark, monkeypatch):
    """Of the rows of a file those whose dispute and action come twice are moved to be compared, others are not."""
    seen = []

    def counted(df, *args):
        seen.append(df.count())
        return flag_repeats(df, *args)

    monkeypatch.setattr(transitions, "flag_repeats", counted)
    act = spark.createDataFrame(
        [(i, a, d, "S1") for i, (a, d) in enumerate([("Close", "1"), ("Escalate", "2"), ("Close", "3"), ("Close", "03"), ("Escalate", "3"), ("Close", None), ("Close", "x")])],
        "Line_ID bigint, Action string, DSB_ID string, Comp_Serial string",
    )
    tables = {
        "employee": spark.createDataFrame([("S1", "One", "O")], "Comp_Serial string, Full_Name string, Initials string"),
        "dispute_current": spark.createDataFrame([(i, i * 10, "Email", "Open", "Filed", 0) for i in (1, 2, 3)], "DSB_ID bigint, DH_ID bigint, Dispute_Type string, Status string, Display_Status string, `#_Of_Escalations` int"),
        "dispute_history": spark.createDataFrame([(i * 10, i) for i in (1, 2, 3)], "DH_ID bigint, DSB_ID bigint"),
        "dispute_notes": spark.createDataFrame([], "DN_ID bigint, DSB_ID bigint"),
    }
    result = direct_actions(act, tables, "2024-01-31 12:00:00")
    errors = {r["Line_ID"]: r["Error_Message"] for r in result.results.collect()}
    unknown = "DSB_ID does not exist in Dispute Current"
    assert errors == {0: None, 1: None, 2: None, 3: "DSB_ID was already given for this action", 4: None, 5: unknown, 6: unknown}
    assert seen == [1, 2]
