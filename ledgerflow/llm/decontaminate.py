"""Benchmark decontamination by SimHash windows, all in DataFrame expressions.

1. A window of a document that is similar to an item shares a `shingle`-word
   shingle with it, so only places that hold a shingle of some item are looked at.
   A bitmap of fixed size (2^20 bits, two tests for each shingle) sifts the places
   in the scan, without exploding or shuffling a text; the places left are joined
   with the items' shingles exactly.
2. Each such place lines a window up with an item: it has as many words as the
   item. Its SimHash is the majority, bit by bit, of its words' hashes.
3. The 64 bits fall into 4 blocks. Fingerprints within `RADIUS` (15) bits have a
   block within 3, so each item's block values are listed with all flips of up to 3
   bits and joined on block and value: no fingerprint within the radius is missed.
4. Windows within the radius are verified: the similarity is the weighted Jaccard
   of the shingles, each weighted with its count, and has to be `similarity`.

A radius of 15 leaves over four standard deviations to windows of 40 words with
one word in 40 changed. Shorter items than `shingle` words are one shingle.

Defined results: null and empty texts hold nothing; items without words match
nothing. Rows without doc_id are not judged. Repeated documents and items give one
row for each pair of ids, with the best window; of equal ones the first.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import drop_ids, stable, words

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, FLIPS = 4, 16, 3
RADIUS = BLOCKS * (FLIPS + 1) - 1
SIEVE_BITS = 20
# Up to so many rows, some tens of MB, the items' side is sent to every task; beyond, it is shuffled.
BROADCAST_ROWS = 2_000_000


def grams(of: Column, n: Column, size: int) -> Column:
    """Hashes of the `size` words from each place on."""
    one = lambda i: F.xxhash64(*[F.get(of, i + k) for k in range(size)])
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), one)).otherwise(F.array().cast("array<bigint>"))


def simhash(of: Column) -> Column:
    """Of each bit of the words' hashes, what most of the words have."""
    hashes = F.transform(of, lambda w: F.xxhash64(w))
    half = F.size(of) / F.lit(2.0)
    bit = lambda h, b: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("long"))
    count = lambda b: F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s + bit(h, b))
    one = lambda b: F.when(count(b) > half, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(one(b)))


def _block(fingerprint: Column, b: int) -> Column:
    return F.shiftrightunsigned(fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).cast("int")


def _flips() -> list[int]:
    """All masks of up to FLIPS of a block's bits."""
    return [sum(1 << b for b in bits) for n in range(FLIPS + 1) for bits in combinations(range(BLOCK_BITS), n)]


def _counted(of: Column) -> Column:
    """A multiset as a set: each value with the number of equal ones before it."""
    return F.transform(of, lambda x, i: F.struct(x.alias("x"), F.size(F.filter(F.slice(of, 1, i), lambda y: y == x)).alias("k")))


def _bits(seeds: DataFrame) -> Column:
    """The bitmap of the items' shingles, as a constant array of 64-bit words."""
    place = F.explode(F.array(_first("gram"), _second("gram")))
    got = (
        seeds.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, int(p & 63)))").alias("bits")).collect()
    )
    cells = [0] * (1 << SIEVE_BITS - 6)
    for row in got:
        cells[row["at"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")


def _first(gram) -> Column:
    gram = F.col(gram) if isinstance(gram, str) else gram
    return gram.bitwiseAND(F.lit((1 << SIEVE_BITS) - 1).cast("long"))


def _second(gram) -> Column:
    gram = F.col(gram) if isinstance(gram, str) else gram
    return F.shiftrightunsigned(gram, SIEVE_BITS).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1).cast("long"))


def _has(bits: Column, p: Column) -> Column:
    cell = F.get(bits, F.shiftright(p, 6).cast("int"))
    return F.call_function("shiftright", cell, p.bitwiseAND(F.lit(63).cast("long")).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def matches(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity) of the documents that hold an item.

    `docs` has doc_id and text, `items` item_id and text; start counts words from 0.
    """
    c = F.col
    items = stable(
        items.where(c("item_id").isNotNull()).select("item_id", words(c("text")).alias("iw"))
        .where(F.size("iw") > 0).distinct().withColumns({"m": F.size("iw"), "item_row": F.monotonically_increasing_id()})
    )
    short = [r["m"] for r in items.where(c("m") < shingle).select("m").distinct().collect()]  # under `shingle` values
    sizes = [shingle, *short]
    seeds = None
    for size in sizes:
        own = items.where((c("m") == size) if size < shingle else (c("m") >= shingle))
        part = own.select("m", F.posexplode(grams(c("iw"), c("m"), size)).alias("q", "gram"), F.lit(size).alias("size")).distinct()
        seeds = part if seeds is None else seeds.union(part)
    seeds = stable(seeds)
    n_items, n_seeds = items.count(), seeds.count()
    bits = _bits(seeds)

    split = docs.where(c("doc_id").isNotNull()).select("doc_id", words(c("text")).alias("w")).withColumn("n", F.size("w"))
    for size in sizes:
        split = split.withColumn(f"g{size}", grams(c("w"), c("n"), size))
    for size in sizes:
        g = c(f"g{size}")
        fits = lambda i: _has(bits, _first(F.get(g, i))) & _has(bits, _second(F.get(g, i)))  # noqa: E731, B023
        places = F.filter(F.sequence(F.lit(0), F.size(g) - 1), fits)
        held = F.transform(places, lambda i: F.struct(i.alias("p"), F.get(g, i).alias("gram")))  # noqa: B023
        split = split.withColumn(f"at{size}", F.when(F.size(g) > 0, held))
    any_place = F.lit(False)
    for size in sizes:
        any_place = any_place | (F.size(f"at{size}") > 0)
    # Documents with a place that may hold an item; written once, so that the texts are read once. The row
    # number stands below the filter, as one pushed past it would compute all the arrays for each test.
    numbered = split.select("doc_id", "w", "n", *[f"at{s}" for s in sizes], F.monotonically_increasing_id().alias("row"))
    held = stable(numbered.where(any_place))
    found = None
    for size in sizes:
        part = held.where(F.size(f"at{size}") > 0).select("row", "n", F.explode(f"at{size}").alias("at")).select(
            "row", "n", "at.p", "at.gram", F.lit(size).alias("size")
        )
        found = part if found is None else found.union(part)
    # Windows keep inside the text; a text shorter than the item is one window.
    start = F.greatest(F.lit(0), F.least(c("p") - c("q"), c("n") - c("m")))
    windows = (
        found.join(_sent(seeds, n_seeds), ["gram", "size"]).select("row", start.alias("start"), "m")
        .groupBy("row").agg(F.collect_set(F.struct("start", "m")).alias("of"))
    )
    printed = stable(
        held.select("row", "doc_id", "w").join(windows, "row")
        .select("doc_id", "w", F.explode("of").alias("of"))
        .select("doc_id", c("of.start").alias("start"), c("of.m").alias("m"), F.slice("w", c("of.start") + 1, c("of.m")).alias("ww"))
        .withColumn("print", simhash(c("ww")))
    )
    marked = items.withColumn("item_print", simhash(c("iw")))
    # Narrow rows, as there are thousands for each item; the items' words are joined to what is near.
    listed = marked.select(
        "item_row", "m", "item_print",
        F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(c("item_print"), b).alias("value")) for b in range(BLOCKS)])).alias("b"),
    ).select(
        "item_row", "m", "item_print", "b.block",
        F.explode(F.transform(F.split(F.lit(",".join(map(str, _flips()))), ",").cast("array<int>"), lambda f: f.bitwiseXOR(c("b.value")))).alias("value"),
    )
    probes = printed.withColumn(
        "b", F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(c("print"), b).alias("value")) for b in range(BLOCKS)]))
    ).select("doc_id", "start", "m", "ww", "print", "b.block", "b.value")
    distance = F.bit_count(c("print").bitwiseXOR(c("item_print")))
    near = (
        probes.join(_sent(listed, n_items * BLOCKS * len(_flips())), ["m", "block", "value"])
        .withColumn("distance", distance).where(c("distance") <= RADIUS)
        # One of the blocks within reach is enough: the first.
        .where(c("block") == _first_block(c("print"), c("item_print"))).drop("m")
        .join(_sent(items, n_items), "item_row")
    )
    k = F.least(F.lit(shingle), c("m"))
    compared = near.select("doc_id", "item_id", "start", "distance", F.size("ww").alias("n_words"), "ww", "iw", k.alias("k"))
    # A window of fewer words than the shingle has, in a text shorter than the item, has no shingle.
    one, two = F.array().cast("array<bigint>"), F.array().cast("array<bigint>")
    for size in sizes:
        one = F.when(c("k") == size, grams(c("ww"), F.size("ww"), size)).otherwise(one)
        two = F.when(c("k") == size, grams(c("iw"), F.size("iw"), size)).otherwise(two)
    measured = (
        compared.select("doc_id", "item_id", "start", "n_words", "distance", one.alias("g"), two.alias("h"))
        .select("doc_id", "item_id", "start", "n_words", "distance", _counted(c("g")).alias("g"), _counted(c("h")).alias("h"))
        .withColumn("both", F.size(F.array_intersect("g", "h")))
        .withColumn("similarity", c("both") / (F.size("g") + F.size("h") - c("both")))
        .where(c("similarity") >= similarity)
    )
    best = F.max(F.struct("similarity", (-c("start")).alias("s"), "n_words", "distance")).alias("best")
    return measured.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-c("best.s")).alias("start"), c("best.n_words").alias("n_words"),
        c("best.distance").alias("distance"), F.round("best.similarity", 6).alias("similarity"),
    )


def _first_block(a: Column, b: Column) -> Column:
    """The first block in which two fingerprints differ in at most FLIPS bits."""
    out = F.lit(-1)
    for k in reversed(range(BLOCKS)):
        out = F.when(F.bit_count(_block(a, k).bitwiseXOR(_block(b, k))) <= FLIPS, k).otherwise(out)
    return out


def clean(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` that hold no item; here an item needs no id."""
    items = items.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("item_id"), "text")
    return drop_ids(docs, stable(matches(docs, items, shingle, similarity).select("doc_id").distinct()))
