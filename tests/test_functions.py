import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow import functions as fn


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    ("given", "want"),
    [(" a ", "a"), ("\t\na b\r\n", "a b"), (" x　", "x"), ("", ""), (None, None)],
)
def test_strip(spark, given, want):
    assert one(spark, fn.strip("x"), given) == want
    assert given is None or given.strip() == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("0", Decimal(0)),
        ("-1", Decimal(-1)),
        ("1e5", Decimal(100000)),
        ("$5", Decimal(5)),
        ("1,234", Decimal(1234)),
        (" 2.5 ", Decimal("2.5")),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_to_money(spark, given, want):
    assert one(spark, fn.to_money("x"), given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("2024-01-31", dt.date(2024, 1, 31)),
        ("1/5/2024", dt.date(2024, 1, 5)),
        ("2024-01-31 10:00:00", dt.date(2024, 1, 31)),
        ("2024-01-31T10:00", dt.date(2024, 1, 31)),
        ("2024-13-01", None),
        ("13/40/2024", None),
        ("2024", None),
        ("2024-01-31 99:00:00", None),
        ("abc", None),
        (None, None),
    ],
)
def test_to_day(spark, given, want):
    assert one(spark, fn.to_day("x"), given) == want


def test_blank_and_first_non_blank(spark):
    df = spark.createDataFrame([(None, "  ", "c"), ("", "b ", "c"), (None, "", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(fn.first_non_blank("a", "b", "c")).collect()]
    assert got == ["c", "b ", None]


def test_comment_forms(spark):
    df = spark.createDataFrame([("why",), (None,)], "c string")
    both = [r[0] for r in df.select(fn.audit_comment("Act", "c")).collect()]
    assert both == ["Act - why", "Act - "]
    assert [r[0] for r in df.select(fn.audit_comment(None, "c")).collect()] == ["why", None]
    assert [r[0] for r in df.select(fn.audit_comment("Act", None)).collect()] == ["Act", "Act"]
    assert [r[0] for r in df.select(fn.audit_comment(None, None)).collect()] == [None, None]


def test_batch_date(spark):
    # 2024-01-31 is a Wednesday; the default is the Friday of the week before.
    assert one(spark, fn.batch_date("2024-01-31 12:00:00")) == dt.date(2024, 1, 26)
    assert one(spark, fn.batch_date("2024-01-29", 7, 0)) == dt.date(2024, 2, 5)
    assert one(spark, fn.batch_label("2024-02-04")) == "20240126"
    assert one(spark, fn.batch_label("2024-02-05")) == "20240202"


def test_month_helpers(spark):
    assert one(spark, fn.month_end(F.lit("2024-02-03").cast("date"))) == dt.date(2024, 2, 29)
    assert one(spark, fn.previous_month_end(F.lit("2024-03-31").cast("date"))) == dt.date(2024, 2, 29)
    assert one(spark, fn.same_day(F.lit("2024-01-31 23:59:59").cast("timestamp_ntz"), "2024-01-31 00:00:01"))


def test_claim_numbers(spark):
    df = spark.createDataFrame([("MRC", 7), (None, 7)], "kind string, seed long")
    got = [r[0] for r in df.select(fn.seed_claim_no(F.lit("20240126"), "kind", "seed")).collect()]
    assert got == ["20240126_M7", None]
    keys = spark.range(1000).select(fn.hash_claim_no(F.lit("b"), "id").alias("c"))
    assert keys.distinct().count() == 1000
    assert keys.exceptAll(spark.range(1000).repartition(3).select(fn.hash_claim_no(F.lit("b"), "id"))).isEmpty()
    assert all(r[0].startswith("b_X") and r[0][3:].isdigit() for r in keys.take(20))


def test_split_csv(spark):
    assert one(spark, fn.split_csv("x"), "a, b,c") == ["a", "b", "c"]
    assert one(spark, fn.split_csv("x"), "a") == ["a"]
    assert one(spark, fn.split_csv("x"), None) is None
