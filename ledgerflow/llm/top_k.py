"""Exact top-k search on a bit-sliced index.

Vectors are quantised to integers. A block of the index holds up to `BLOCK_ROWS`
vectors, ordered by id, and for each attribute one bitmap per bit of its value
above the block's least value. The score of a query against all rows of a block is
a sum of shifted slices: each signed digit of a query component (non-adjacent form)
adds the slices of its attribute, or their complements for a negative digit, and
the constants of offsets and complements are added at the end. Slices of one weight
are summed by carry-save addition, three bitmaps at a time.

The best rows are read off the sum from its most significant slice downward: rows
that are surely among the k best, and rows still tied. Ties left at the last slice
have equal scores and are resolved by id, as rows are in the order of their ids.

Blocks of queries meet blocks of the index on a grid, by an equi-join on the two
block numbers; a block pair gives k rows for each query, and ranks are cut again
over all blocks.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part. Rows that repeat a vec_id are one vector, the least of
them. Vectors meet only vectors of as many components. Sums are exact below 2^62.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stable

BLOCK_ROWS = 16384
BLOCK_QUERIES = 128
INDEX = "dim int, block int, n int, ids binary, low array<long>, bits array<int>, slices binary"


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, one row for each vec_id that takes part."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    return (
        vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
        .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("v"))
    )


def _index_block(t: pa.Table) -> pa.Table:
    t = t.sort_by("vec_id").combine_chunks()
    ids, dim = t["vec_id"].to_numpy(), t["dim"][0].as_py()
    v = np.stack([np.asarray(x.values) for x in t["v"]])
    low = v.min(0)
    u = (v - low).astype(np.uint64)
    bits = [int(m).bit_length() for m in u.max(0)]
    words = -(-len(ids) // 64)
    out = np.zeros((sum(bits), words * 8), np.uint8)
    at = 0
    for d in range(dim):
        for b in range(bits[d]):
            packed = np.packbits((u[:, d] >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little")
            out[at, : len(packed)] = packed
            at += 1
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()), "block": t["block"][:1].cast(pa.int32()), "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()), "low": pa.array([low.tolist()], pa.list_(pa.int64())),
            "bits": pa.array([bits], pa.list_(pa.int32())), "slices": pa.array([out.tobytes()], pa.binary()),
        }
    )


def build_index(vectors: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each block, written to the shared folder; `vectors` is (vec_id, v)."""
    blocks = max(1, -(-vectors.count() // rows))
    keyed = vectors.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    return stable(keyed.groupBy("dim", "block").applyInArrow(_index_block, INDEX))


def digits(q: int) -> list[tuple[int, int]]:
    """Non-adjacent form of an integer as (power, sign)."""
    out, k = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((k, d))
            q -= d
        q >>= 1
        k += 1
    return out


def weighted_sum(both: np.ndarray, first: np.ndarray, bits: np.ndarray, query: np.ndarray, low: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the scores, from the least significant, and the constant to add.

    `both` holds all slices and after them their complements; `first` is the place
    of each attribute's first slice.
    """
    half = len(both) // 2
    take: dict[int, list[int]] = defaultdict(list)
    constant = int(sum(int(q) * int(o) for q, o in zip(query, low)))
    for d, q in enumerate(query.tolist()):
        n, at = int(bits[d]), int(first[d])
        for power, sign in digits(q) if n else []:
            if sign < 0:
                constant -= ((1 << n) - 1) << power
            for b in range(n):
                take[power + b].append(at + b + (half if sign < 0 else 0))
    out: list[np.ndarray] = []
    carried: dict[int, list[np.ndarray]] = defaultdict(list)
    weight, top = 0, max(take, default=-1)
    while weight <= top or carried[weight]:
        parts = carried.pop(weight, [])
        if take.get(weight):
            parts = [both[take[weight]], *parts]
        if not parts:
            out.append(np.zeros(both.shape[1], both.dtype))
            weight += 1
            continue
        x = np.concatenate(parts) if len(parts) > 1 else parts[0]
        while len(x) > 1:
            m = len(x) // 3
            if m:
                a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
                t = a ^ b
                carried[weight + 1].append(a & b | t & c)
                x = np.concatenate((t ^ c, x[3 * m :])) if len(x) > 3 * m else t ^ c
            else:
                carried[weight + 1].append(x[:1] & x[1:])
                x = x[:1] ^ x[1:]
        out.append(x[0])
        weight += 1
    return out, constant


def best_rows(sums: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows of greatest sum among `alive`; ties go to the smaller place."""
    sure, tied = np.zeros_like(alive), alive
    for s in reversed(sums):
        more = tied & s
        n = int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(more).sum())
        if n > k:
            tied = more
        else:
            sure, tied = sure | more, tied & ~s
            if n == k:
                return np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    place = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    if len(place) < k:
        rest = np.flatnonzero(np.unpackbits(tied.view(np.uint8), bitorder="little"))
        place = np.concatenate((place, rest[: k - len(place)]))
    return place


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query but the query's own; `queries` is (vec_id, v)."""
    c = F.col
    asked = max(1, -(-queries.count() // BLOCK_QUERIES))
    blocks = index.agg(F.max("block")).first()[0]
    if blocks is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(asked)).cast("int")
    groups = (
        queries.groupBy(part.alias("part"), F.size("v").alias("dim")).agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
        .select("part", "dim", c("asked.vec_id").alias("qids"), F.flatten("asked.v").alias("qs"), F.explode(F.sequence(F.lit(0), F.lit(blocks))).alias("block"))
    )
    cells = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("part")).join(groups, ["dim", "block", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, ids, low, bits, slices, qids, qs, dim = (batch.column(i)[row] for i in range(8))
                n, dim = n.as_py(), dim.as_py()
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                low, bits, qids, qs = (np.asarray(v.values) for v in (low, bits, qids, qs))
                first = np.concatenate(([0], np.cumsum(bits)))[:-1]
                words = -(-n // 64)
                own = np.frombuffer(slices.as_buffer(), np.uint64).reshape(-1, words)
                both = np.concatenate((own, ~own))
                every = np.zeros(words * 64, np.uint8)
                every[:n] = 1
                every = np.packbits(every, bitorder="little").view(np.uint64)
                out = []
                for q, query in zip(qids.tolist(), qs.reshape(len(qids), dim)):
                    sums, constant = weighted_sum(both, first, bits, query, low)
                    alive, me = every, int(np.searchsorted(ids, q))
                    if me < n and ids[me] == q:
                        alive = every.copy()
                        alive[me >> 6] &= ~(np.uint64(1) << np.uint64(me & 63))
                    for place in best_rows(sums, alive, k).tolist():
                        word, bit = place >> 6, place & 63
                        score = sum((int(s[word]) >> bit & 1) << w for w, s in enumerate(sums))
                        out.append((q, int(ids[place]), score + constant))
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"])

    found = cells.select("n", "ids", "low", "bits", "slices", "qids", "qs", "dim").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(c("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(c("rank") <= k).select("query_id", "rank", "vec_id", "score")
