"""Business-shaped views of the given tables, in Spark and as SQL text."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_NOW = "2024-01-31 12:00:00"
ORDER_NOW = "2001-08-15 12:00:00"
CATEGORY = "GRT CNR"


@cache
def _schema(path: str) -> T.StructType:
    """Read once per file; the test tables do not change."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def v_sub(spark: SparkSession, sf: str) -> DataFrame:
    """Submissions as text, with bad numbers, bad dates and nulls."""
    e = F.col("event_id")
    amount = (
        F.when(e % 11 == 0, "n/a")
        .when(e % 13 == 0, F.concat(F.lit("-"), text(e % 50)))
        .when(e % 17 == 0, None)
        .otherwise(text(e % 500 + 1))
    )
    day = (
        F.when(e % 7 == 0, "2024-13-01")
        .when(e % 5 == 0, None)
        .when(e % 3 == 0, "2024-02-29")
        .when(e % 2 == 0, "2023-12-31")
        .otherwise("2024-04-15")
    )
    return table(spark, sf, "events").select(
        e.alias("line_id"),
        F.col("event_type").alias("action"),
        F.when(e % 4 == 0, "PCI").otherwise("BMI").alias("source_tbl"),
        text("user_id").alias("source_id"),
        (e * 2).alias("dsb_id"),
        (F.col("user_id") % 120).alias("comp_serial"),
        amount.alias("amount_txt"),
        day.alias("date_txt"),
        F.concat_ws(" ", "event_type", text(e)).alias("reason"),
    )


def v_emp(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("comp_serial"),
        F.col("s_name").alias("full_name"),
        F.concat(F.lit("S"), text("s_suppkey")).alias("initials"),
    )


def v_ban(spark: SparkSession, sf: str) -> DataFrame:
    """Effective-dated master: two periods per account, every tenth under another number."""
    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    ban = F.when(key % 10 == 0, -key - 1).otherwise(key)
    first = s.select(
        text(ban).alias("ban"),
        (key * 2).alias("id"),
        F.col("s_nationkey").cast("long").alias("platform_id"),
        F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit("1998-06-30").cast("date").alias("end_date"),
    )
    second = s.select(
        text(ban).alias("ban"),
        (key * 2 + 1).alias("id"),
        ((F.col("s_nationkey") + 1) % 25).cast("long").alias("platform_id"),
        F.lit("1998-07-01").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )
    return first.unionByName(second)


def v_current(spark: SparkSession, sf: str) -> DataFrame:
    """Dispute state, one row per order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Denied - Pending")
        .when(F.col("o_orderpriority") == "2-HIGH", "Approved")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Partial Approved")
        .otherwise("Filed")
    )
    return table(spark, sf, "orders").select(
        key.alias("dsb_id"),
        F.when(cust % 4 == 0, "PCI").otherwise("BMI").alias("source_tbl"),
        text(cust).alias("source_id"),
        F.when(F.col("o_orderstatus") == "F", "Closed").otherwise("Open").alias("status"),
        status.alias("display_status"),
        F.when(cust % 3 == 0, "Email").otherwise("STC").alias("dispute_type"),
        F.when(key % 5 == 0, "Other").otherwise(CATEGORY).alias("dispute_category"),
        F.when(key % 4 == 0, None).otherwise((key % 3).cast("int")).alias("n_escalations"),
        F.col("o_totalprice").alias("dispute_amount"),
        F.concat(F.lit("Rep "), text(key % 7)).alias("disputer"),
        F.col("o_orderdate").alias("date_submitted"),
        F.when(key % 9 == 0, None).otherwise(key).alias("dh_id"),
    )


def v_history(spark: SparkSession, sf: str) -> DataFrame:
    """One prior version per order, keyed by dh_id."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("dh_id"),
        key.alias("dsb_id"),
        F.concat(F.lit("H "), F.col("o_orderpriority")).alias("dispute_category"),
        F.col("o_orderdate").alias("date_submitted"),
        F.when(key % 6 == 0, "Y").alias("escalate"),
        F.concat(F.lit("why "), text(key)).alias("dispute_reason"),
    )


# Name -> (SELECT text, views it uses). The text is what DuckDB runs.
SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "v_sub": (
        """
SELECT event_id AS line_id, event_type AS action,
       CASE WHEN event_id % 4 = 0 THEN 'PCI' ELSE 'BMI' END AS source_tbl,
       CAST(user_id AS VARCHAR) AS source_id,
       event_id * 2 AS dsb_id, user_id % 120 AS comp_serial,
       CASE WHEN event_id % 11 = 0 THEN 'n/a'
            WHEN event_id % 13 = 0 THEN '-' || CAST(event_id % 50 AS VARCHAR)
            WHEN event_id % 17 = 0 THEN NULL
            ELSE CAST(event_id % 500 + 1 AS VARCHAR) END AS amount_txt,
       CASE WHEN event_id % 7 = 0 THEN '2024-13-01'
            WHEN event_id % 5 = 0 THEN NULL
            WHEN event_id % 3 = 0 THEN '2024-02-29'
            WHEN event_id % 2 = 0 THEN '2023-12-31'
            ELSE '2024-04-15' END AS date_txt,
       event_type || ' ' || CAST(event_id AS VARCHAR) AS reason
FROM events""",
        (),
    ),
    "v_num": (
        """
SELECT *, TRY_CAST(amount_txt AS DECIMAL(19,4)) AS amount, TRY_CAST(date_txt AS DATE) AS day,
       amount_txt IS NOT NULL AND TRY_CAST(amount_txt AS DECIMAL(19,4)) IS NULL AS bad_number,
       COALESCE(TRY_CAST(amount_txt AS DECIMAL(19,4)) <= 0, FALSE) AS bad_sign,
       date_txt IS NOT NULL AND TRY_CAST(date_txt AS DATE) IS NULL AS bad_date,
       COALESCE(TRY_CAST(date_txt AS DATE) <> LAST_DAY(TRY_CAST(date_txt AS DATE)), FALSE) AS bad_eom,
       COALESCE(CAST(TRY_CAST(date_txt AS DATE) AS TIMESTAMP) < TIMESTAMP '2024-01-31 12:00:00', FALSE)
           AS bad_past
FROM v_sub""",
        ("v_sub",),
    ),
    "v_emp": (
        """
SELECT s_suppkey AS comp_serial, s_name AS full_name,
       'S' || CAST(s_suppkey AS VARCHAR) AS initials
FROM supplier""",
        (),
    ),
    "v_ban": (
        """
SELECT CAST(CASE WHEN s_suppkey % 10 = 0 THEN -s_suppkey - 1 ELSE s_suppkey END AS VARCHAR) AS ban,
       s_suppkey * 2 AS id, s_nationkey AS platform_id,
       DATE '1995-01-01' AS start_date, DATE '1998-06-30' AS end_date
FROM supplier
UNION ALL
SELECT CAST(CASE WHEN s_suppkey % 10 = 0 THEN -s_suppkey - 1 ELSE s_suppkey END AS VARCHAR),
       s_suppkey * 2 + 1, (s_nationkey + 1) % 25, DATE '1998-07-01', NULL
FROM supplier""",
        (),
    ),
    "v_current": (
        """
SELECT o_orderkey AS dsb_id,
       CASE WHEN o_custkey % 4 = 0 THEN 'PCI' ELSE 'BMI' END AS source_tbl,
       CAST(o_custkey AS VARCHAR) AS source_id,
       CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Denied - Pending' WHEN '2-HIGH' THEN 'Approved'
            WHEN '3-MEDIUM' THEN 'Partial Approved' ELSE 'Filed' END AS display_status,
       CASE WHEN o_custkey % 3 = 0 THEN 'Email' ELSE 'STC' END AS dispute_type,
       CASE WHEN o_orderkey % 5 = 0 THEN 'Other' ELSE 'GRT CNR' END AS dispute_category,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS INTEGER) END AS n_escalations,
       o_totalprice AS dispute_amount,
       'Rep ' || CAST(o_orderkey % 7 AS VARCHAR) AS disputer,
       o_orderdate AS date_submitted,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey END AS dh_id
FROM orders""",
        (),
    ),
    "v_history": (
        """
SELECT o_orderkey AS dh_id, o_orderkey AS dsb_id, 'H ' || o_orderpriority AS dispute_category,
       o_orderdate AS date_submitted, CASE WHEN o_orderkey % 6 = 0 THEN 'Y' END AS escalate,
       'why ' || CAST(o_orderkey AS VARCHAR) AS dispute_reason
FROM orders""",
        (),
    ),
}
