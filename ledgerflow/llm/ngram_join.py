"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

A document's set is its distinct `size`-word shingles. Documents link when
100 * |intersection| >= percent * |union|; each document gets the smallest
doc_id that links reach (its component).

1. Shingle frequencies go into a sketch of fixed size (2^18 counters over all
   documents). Its counts, then the hashes, order the shingles from rare to
   frequent; any fixed order keeps the join exact, a good one keeps it cheap.
2. Documents with equal sets become one class; only classes are joined.
3. The first n - ceil(t * n) + 1 shingles of a class are its prefix: linked classes
   share one. Pairs that share a prefix shingle must pass the length filter and the
   positional filter (the overlap still possible behind the shared shingle), then
   the suffix filter (counts by hash range bound the symmetric difference from
   below), and are verified on whole sets, once.
4. A group of classes on one shingle is not paired out. First every class meets one
   pivot: of the pivots of its shingles, the one in which the shared shingle stands
   earliest, which is the version with the fewest edits. Links found make
   components, and then only pairs across components are joined, which leaves
   nothing of a group whose members are all linked. No pair that could join two
   components is left out, so components are exact; links inside a component are
   not counted.

Groups are split by adaptive execution where they are large: all steps on a
shingle are partial aggregates or sort-merge joins. Set bytes are shuffled for
classes in a candidate pair only, which a bitmap of fixed size picks at the scan.

Defined results: null and empty texts have no shingles and link with nothing; a
text of fewer words than `size` is one shingle. Rows without doc_id get no
component. Rows that repeat a doc_id count as one document with several texts: it
links by any of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import components, drop_ids, sieve, sift, small_batches, stable, word_hashes

SKETCH_BITS = 18
RANGES = 64

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(flat: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on (as long as there are so many)."""
    h = flat.view(np.uint64)
    n = len(h) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            if n > 0:
                out = _mix(out + h[k : k + n] * _MULTIPLIERS[k % 5] + np.uint64(k + 1))
    return out


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one text, given the hashes of its words."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hashes, min(size, len(hashes))))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:]):
        yield flat[a:b]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what is made of each stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_hashes(F.col(f"`{text}`")).alias("words"))


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Document counts of shingles by the low bits of their hashes, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        for batch in slices(batches):
            sets = [shingle_set(w, size) & mask for w in _lists(batch.column(1))]
            if sets:
                count += np.bincount(np.concatenate(sets).astype(np.int64), minlength=len(count))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at], pa.int64())], names=["at", "n"])

    # At most 2^18 rows reach the driver, whatever the input.
    got = hashed(docs).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    out[got["at"].to_numpy()] = got["n"].to_numpy()
    return out


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, sig, tokens, ranges) of each row: set size, set digest, prefix and counts by hash range."""
    order = docs.sparkSession.sparkContext.broadcast(frequencies(docs, size))  # 2 MB
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = order.value
        for batch in slices(batches):
            n, sig, tokens, ranges = [], [], [], []
            for words in _lists(batch.column(1)):
                s = shingle_set(words, size)
                prefix = len(s) + (-len(s) * percent // 100) + 1 if len(s) else 0
                rare = np.lexsort((s, count[(s & mask).astype(np.int64)]))[:prefix]
                n.append(len(s))
                sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                tokens.append((s[rare] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                ranges.append(np.diff(np.searchsorted(s, np.arange(1, RANGES, dtype=np.uint64) << np.uint64(64 - 6)), prepend=0, append=len(s)))
            ends = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(sig, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([r.tolist() for r in ranges], pa.list_(pa.int32()))],
                names=["doc_id", "n", "sig", "tokens", "ranges"],
            )

    return hashed(docs).mapInArrow(run, "doc_id long, n int, sig binary, tokens array<int>, ranges array<int>")


def sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, set) of the documents in `ids` and a few others; nothing is shuffled."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [shingle_set(w, size).tobytes() for w in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "set"])

    return hashed(sift(own, sieve(ids))).mapInArrow(run, "doc_id long, set binary")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Suffix filter on the classes' counts, then whole sets."""
    of = classes.select("doc_id", "n", "ranges")
    apart = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    # 2 * overlap = n_a + n_b - difference
    possible = (F.col("n_a") + F.col("n_b") - apart) * (100 + percent) >= 2 * percent * (F.col("n_a") + F.col("n_b"))
    a, b = ([F.col(c).alias(t) for c, t in (("doc_id", s), ("n", f"n_{s}"), ("ranges", f"ranges_{s}"))] for s in "ab")
    left = stable(pairs.join(of.select(*a), "a").join(of.select(*b), "b").where(possible).select("a", "b").distinct())
    ids = left.select(F.col("a").alias("doc_id")).union(left.select("b"))
    sets = sets_of(docs, ids, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both * (100 + percent) >= percent * (len(p) + len(q)) and both > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return (
        left.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
        .select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long").distinct()
    )


def link_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """The rows' (doc_id, n_shingles, component_id); `docs` has doc_id and text."""
    # All that goes to Python is written in here: the frame that is returned reads copies.
    with small_batches(docs.sparkSession):
        return _linked(docs, size, percent)


def _linked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    signed = stable(signatures(docs, size, percent))
    classes = stable(
        signed.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("n", "sig")
        .agg(F.min("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.first("ranges").alias("ranges"))
    )
    postings = classes.select(F.posexplode("tokens").alias("i", "token"), F.col("doc_id").alias("id"), "n")
    pivots = (
        postings.groupBy("token").agg(F.min(F.struct("i", "id", "n")).alias("p"), F.count("*").alias("m"))
        .where(F.col("m") > 1).select("token", "m", F.col("p.i").alias("pi"), F.col("p.id").alias("pid"), F.col("p.n").alias("pn"))
    )

    def fits(n, i, m, j):
        """Length and positional filters of two classes of n and m shingles that share their i-th and j-th."""
        long_enough = F.least(n, m) * 100 >= F.greatest(n, m) * percent
        behind = F.least(n - i, m - j) * (100 + percent) >= (n + m) * percent
        return long_enough & behind

    c = F.col
    # A shingle of two classes that do not fit makes no pair: most shingles that meet by chance go here.
    shared = stable(
        postings.join(pivots, "token")
        .where((c("m") > 2) | (c("id") != c("pid")) & fits(c("n"), c("i"), c("pn"), c("pi")))
    )
    pair = [F.least("id", "pid").alias("a"), F.greatest("id", "pid").alias("b")]
    twos = shared.where(c("m") == 2).select(*pair).distinct()
    first = (
        shared.where((c("id") != c("pid")) & fits(c("n"), c("i"), c("pn"), c("pi")))
        .groupBy("id").agg(F.min(F.struct((c("i") + c("pi")).alias("at"), "pid")).alias("p"))
        .select(F.least("id", "p.pid").alias("a"), F.greatest("id", "p.pid").alias("b")).distinct()
    )
    links = stable(verify(first, classes, docs, size, percent))
    found = components(links)

    more = shared.where(c("m") > 2)
    labelled = more.join(found, more["id"] == found["node"], "left").select(
        "token", "i", "id", "n", F.coalesce("component", "id").alias("part")
    )
    mixed = labelled.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("token")
    across = stable(labelled.join(mixed, "token"))
    other = across.select("token", *[c(k).alias(f"{k}_") for k in ("i", "id", "n", "part")])
    rest = (
        across.join(other, "token")
        .where((c("part") != c("part_")) & (c("id") < c("id_")) & fits(c("n"), c("i"), c("n_"), c("i_")))
        .select(c("id").alias("a"), c("id_").alias("b"))
    )
    parts = {s: found.select(c("node").alias(s), c("component").alias(f"part_{s}")) for s in "ab"}
    apart = (
        twos.join(parts["a"], "a", "left").join(parts["b"], "b", "left")
        .where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    )
    rest = rest.union(apart).distinct().join(first, ["a", "b"], "left_anti")
    least = signed.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("sig").agg(F.min("doc_id").alias("class"))
    # A document that repeats with other texts is in several classes; they are linked by it.
    of = signed.where(F.col("n") > 0).select("doc_id", "sig").join(least, "sig").select("doc_id", "class")
    several = of.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("_last")).where("a < _last")
    same = of.join(several, "doc_id").where("class <> a").select("a", F.col("class").alias("b")).distinct()
    found = components(links.union(verify(rest, classes, docs, size, percent)).union(same))

    return (
        signed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "sig").join(least, "sig", "left")
        .join(found, F.col("class") == found["node"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id")).alias("component_id"))
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with one document of each component, that of the smallest doc_id.

    Of rows that repeat a doc_id one is kept; rows without doc_id are all kept.
    """
    found = stable(link_components(docs, size, percent).where(F.col("doc_id").isNotNull()))
    gone = found.where("component_id <> doc_id").select("doc_id")
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    left = drop_ids(docs, gone)
    bits = sieve(again)
    return sift(left, bits, held=False).unionByName(sift(left, bits).dropDuplicates(["doc_id"]))
