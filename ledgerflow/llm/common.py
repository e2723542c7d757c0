"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.keys import stable, work_dir  # noqa: F401 - used by the operators

# ASCII white space of the contracts, [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_worker(key: object, build: Callable):
    """What `build` makes, once for each Python worker process.

    Code that is sent by value has no module to keep such things in, so they
    hang on one made here.
    """
    name = "_ledgerflow_llm_worker"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """What is written inside goes to Python in batches of few rows; the session's setting is restored.

    The setting counts when a plan runs. A batch of the usual 10,000 rows of words or sets
    takes tens of MB, several times over: in the JVM, in the stream and in the worker.
    """
    before = spark.conf.get(ARROW_ROWS)
    if 0 < int(before) < rows:
        rows = int(before)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back when it is written; the session's setting is restored.

    Otherwise they stay until the driver happens to collect its garbage, so the steps of a job add up on the disks.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def discard(*written: DataFrame) -> None:
    """Delete the folders in the work folder that these `stable` frames read, when what was made of them is written."""
    for df in written:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        work = jvm.org.apache.hadoop.fs.Path(work_dir(df.sparkSession))
        files = work.getFileSystem(conf)
        for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
            folder = jvm.org.apache.hadoop.fs.Path(name)
            if files.makeQualified(folder.getParent()).equals(files.makeQualified(work)):
                files.delete(folder, True)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Words of a text, A-Z lower-cased; an empty array for null."""
    return F.filter(F.split(lower_ascii(F.coalesce(c, F.lit(""))), SPACE + "+"), lambda w: w != "")


def word_hashes(c: Column) -> Column:
    """A 64-bit hash for each word."""
    return F.transform(words(c), lambda w: F.xxhash64(w))


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with these columns at the end, in place of any of the same name (in any case)."""
    names = {n.lower() for n in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one made from it, that no column of the frame has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph; component is its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    every step links nodes to the smallest neighbour known, so a chain of links
    shrinks by about half. The edges of each round are written to the shared
    folder; only their number and a checksum come to the driver. The minimum
    of a node is a partial aggregate and joins back, so no node's neighbours
    meet in one task.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v"))
            )
        return out.where(F.col("u") != F.col("v")).distinct()

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(row)

    e = stable(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    )
    before = None
    for _ in range(rounds):
        e = stable(star(star(e, True), False))
        now = state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


SIEVE_BITS = 23


def sieve(ids: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of `doc_id`; 1 MB, whatever their number."""
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << SIEVE_BITS))
    got = (
        ids.select(bit.alias("b")).groupBy(F.shiftright("b", 5).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, int(b % 32)))").alias("bits")).toArrow()
    )
    out = np.zeros(1 << SIEVE_BITS - 5, dtype=np.uint32)
    out[got["at"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return out


def sift(docs: DataFrame, bits: np.ndarray, held: bool = True) -> DataFrame:
    """The rows whose doc_id may be in the bitmap (or those whose doc_id surely is not, nulls too).

    Saves shuffling most texts where few documents are concerned; with ever more
    ids it lets ever more pass, and what follows decides exactly.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    bit = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << SIEVE_BITS)).cast("int"), F.lit(-1))
    bit = F.when(F.col("doc_id").isNull(), -1).otherwise(bit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            b = batch.column(batch.num_columns - 1).to_numpy()
            hit = (own[b >> 5] >> (b & 31).astype(np.uint32) & 1).astype(bool) & (b >= 0)
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(hit if held else ~hit))

    return docs.withColumn(fresh(docs, "_sieve_bit"), bit).mapInArrow(run, docs.schema)


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is not among `ids`; only rows that may be are shuffled."""
    bits = sieve(ids)
    name = fresh(docs, "_gone")
    gone = ids.select(F.col("doc_id").cast("long").alias(name)).distinct()
    held = sift(docs, bits)
    return sift(docs, bits, held=False).unionByName(
        held.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
    )
