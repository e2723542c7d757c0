"""A third of the rows under one key is split by adaptive execution."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import url_filter, warc

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
def pages(spark):
    """Every third page has the same URL and the same payload."""
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    own = F.sha2(F.col("id").cast("string"), 512)
    hot = F.col("id") % 3 == 0
    yield spark.range(0, 60_000, 1, 6).select(
        F.col("id").alias("page_id"),
        F.when(hot, "http://hot.net/x").otherwise(F.concat(F.lit("http://a.net/"), own)).alias("url"),
        F.when(hot, F.repeat(F.lit("same "), 30)).otherwise(own).alias("html"),
        own.alias("more"),
    )
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def is_split(spark, df):
    df.createOrReplaceTempView("hot_pages")
    kept = spark.table("hot_pages")
    table = kept.toArrow()
    return table, "skew=true" in kept._jdf.queryExecution().executedPlan().toString()


def test_hot_url_is_split(spark, pages):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, action string")
    got, split = is_split(spark, url_filter.judge_urls(pages, rules))
    assert split and got.num_rows == 60_000 and set(got["verdict"].to_pylist()) == {"block"}


def test_hot_payload_is_split(spark, pages):
    got, split = is_split(spark, warc.decide(pages))
    assert split and got.num_rows == 60_000
    assert sum(x is not None for x in got["refers_to"].to_pylist()) == 19_999
