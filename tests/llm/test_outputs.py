"""Token files, whitened embeddings, fill in the middle: round trips and brute force."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import fill_middle, token_files, whitening

TEXTS = [
    (3, "Hello, World! it's 12 o'clock\tÜberß  x"), (1, ""), (None, "no id"), (2, None), (1, "again"), (1, "again"),
    (9, "word " * 30000), (7, "x" * 5000), (8, "<|endoftext|> a<|startoftext|>b 中文 \U0001f600 é"), (6, " \n\r\x0b\x0c\x1c "),
]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def crowded(df):
    """The frame with columns that the operators use or return themselves."""
    names = ("start", "n", "form", "output", "ids", "place", "of_text", "file", "part", "component", "whitened", "block", "at")
    return df.select("*", *[F.lit("x").alias(n) for n in names])


# --- token files ----------------------------------------------------------------------


@pytest.mark.parametrize("percentile", [0.0, 0.5, 0.9, 1.0])
def test_blocks_give_back_any_ids(percentile):
    rng = np.random.default_rng(5)
    for most in (1, 2, 300, 49408, 1 << 32):
        ids = rng.integers(0, most, token_files.BLOCK * 3, dtype=np.uint64).astype(np.uint32)
        ids[::5] //= 1000
        blocks = token_files.encode_blocks(ids, percentile)
        starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
        assert (token_files.decode_blocks(b"".join(blocks), starts) == ids).all()


def test_outliers_are_exceptions_and_the_width_is_the_percentile():
    ids = np.full(token_files.BLOCK, 70, dtype=np.uint32)
    ids[:100] += np.arange(100, dtype=np.uint32) % 4
    ids[500] = 1 << 31
    assert token_files.widths((ids - 70)[None, :], 0.99)[0] == 2
    (block,) = token_files.encode_blocks(ids, 0.99)
    assert len(block) == token_files.HEAD_BYTES + 2 * 128 + 6  # two bits an id, one exception


def test_any_range_is_read_by_the_block_starts(tmp_path):
    path = f"{tmp_path}/a/one.ids"
    out, rng = token_files.Writer(path), np.random.default_rng(1)
    docs = [rng.integers(0, 50000, n).astype(np.uint32) for n in (0, 1, 1023, 1024, 5000, 0, 700000, 3)]
    for k, ids in enumerate(docs):
        out.add(None if k == 2 else -k, ids)
    size = out.close()
    assert os.path.getsize(path) == size
    got, whole = token_files.TokenFile(path), np.concatenate(docs)
    for a, b in ((0, 0), (0, 1), (1023, 1025), (5, len(whole)), (len(whole) - 1, len(whole)), (300000, 300001)):
        assert (got.ids(a, b) == whole[a:b]).all()
    for (k, at, pieces), ids in zip(got.documents(), docs):
        assert (np.concatenate([np.empty(0, np.uint32), *pieces]) == ids).all() and got.known[k] == (k != 2)
    assert got.n_docs == len(docs) and got.n_ids == len(whole)


def _plain_ids(texts):
    tokenizers, vocabulary = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary.path("word_bpe_49k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_token_files_against_plain_encoding(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 10)  # many files
    monkeypatch.setattr(token_files, "PART_BYTES", 1000)  # long texts in parts
    docs = crowded(frame(spark, TEXTS).repartition(5))
    manifest = token_files.write_ids(docs)
    rows = token_files.read_documents(manifest, with_ids=True).orderBy("start").collect()
    want = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [d for d, _ in want]
    plain = {}
    for (d, _), ids in zip(want, _plain_ids([t for _, t in want])):
        plain.setdefault(d, []).append(ids)
    at = 0
    for r in rows:
        assert r["ids"] in plain[r["doc_id"]] and r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        plain[r["doc_id"]].remove(r["ids"])
        at += r["n_tokens"]
    assert manifest.count() >= 4 and token_files.read_documents(manifest).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_whole_texts_give_the_same_ids(spark):
    docs = frame(spark, TEXTS)
    a, b = (
        sorted(map(repr, token_files.read_documents(token_files.write_ids(docs, token_files.encoder(by_words=w))).collect()))
        for w in (True, False)
    )
    assert a == b


def test_no_documents_no_files(spark):
    manifest = token_files.write_ids(frame(spark, []))
    assert manifest.count() == 0 and token_files.read_documents(manifest).count() == 0


def test_rows_of_one_document_id_are_spread(spark):
    """A third of the rows with one id and one text do not meet in one task."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_ids(docs.repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.agg(F.max("n_docs")).first()[0] <= 0.35 * 3000
    rows = token_files.read_documents(manifest).orderBy("start").collect()
    assert [r["start"] for r in rows] == list(range(0, 9000, 3)) and [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


# --- whitening ------------------------------------------------------------------------


def _whitened(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, fit = whitening.whiten(crowded(df), **more)
    return got.collect(), fit


def _brute(rows, components):
    x = np.array([np.floor(1024 * np.array(v, dtype=np.float32).astype(float)) + 100000 for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    far = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return centred @ vectors / np.sqrt(values), values, far, np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("size,dims,block,columns", [(300, 12, 7, 1024), (300, 12, 64, 5), (40, 3, 1000, 1024)])
def test_whitening_against_brute_force(spark, monkeypatch, size, dims, block, columns):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", columns)
    rng = np.random.default_rng(size + block)
    data = rng.normal(size=(size, dims)) @ rng.normal(size=(dims, dims))
    good = [(int(i), [float(v) for v in row]) for i, row in enumerate(data)]
    bad = [(9000, None), (9001, []), (9002, [float("nan")] * dims), (9003, [None] * dims), (9004, [1.0]), (9005, [float("inf")] * dims)]
    rows, fit = _whitened(spark, good + bad, block_rows=block)
    k = min(8, dims)
    want, values, far, trace = _brute(good, k)
    assert len(rows) == size * k and fit.n == size
    by_component = {}
    for r in rows:
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r
    for c in range(k):
        own = by_component[c + 1]
        got = np.array([own[i]["whitened"] for i in range(size)])
        assert min(np.abs(got - want[:, c]).max(), np.abs(got + want[:, c]).max()) < 1e-8
        assert all(own[i]["explained"] == pytest.approx(values[c] / trace, rel=1e-9) for i in (0, size - 1))
        assert [int(own[i]["deviation"]) for i in range(size)] == far
    assert rows[0]["identity_error"] < 1e-9


def test_degenerate_embeddings(spark):
    assert _whitened(spark, [])[0] == []
    assert _whitened(spark, [(1, None)])[0] == []
    assert _whitened(spark, [(1, [1.0, 2.0])])[0] == []  # one row varies in nothing
    rows, fit = _whitened(spark, [(1, [1.0, 5.0]), (None, [2.0, 5.0]), (1, [3.0, 5.0])])
    assert {r["component"] for r in rows} == {1} and len(rows) == 3  # the constant direction is left out
    assert sorted(round(r["whitened"] * np.sign(rows[0]["whitened"] or 1), 6) for r in rows) in (
        sorted([-1.224745, 0, 1.224745]), sorted([1.224745, 0, -1.224745]))


def test_deviations_are_exact_beyond_long():
    x = np.array([[1 << 50, 3], [5, 1 << 40]], dtype=np.int64)
    sums = [int(x[:, 0].sum()), int(x[:, 1].sum())]
    want = [sum((2 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 2, sums) == want and max(want) > 1 << 63


# --- fill in the middle ---------------------------------------------------------------


def _brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    prefix, middle, suffix = ("".join(p) for p in (units[:low], units[low:high], units[high:]))
    if d % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_against_brute_force(spark):
    random.seed(2)
    rows = [(k, "".join(random.choices("abcXYZ  é\n<>.P\U0001f600", k=random.randint(0, 300)))) for k in range(400)]
    rows += [(None, "some text"), (400, None), (401, "a <M> b"), (7, rows[7][1]), (402, "long word " * 20000), (403, "<S"), (404, "P>x<"), (-5, "minus")]
    docs = crowded(frame(spark, rows))
    made = fill_middle.fill_in_middle(docs)
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = sorted(repr((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"])) for r in made.collect())
    assert got == sorted(repr((d, *_brute_fill(d, t), t or "")) for d, t in rows)
    assert {f for f in (_brute_fill(d, t)[1] for d, t in rows)} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(frame(spark, [])).count() == 0


@pytest.mark.parametrize("fan_out", [2, 3, 8, 64])
def test_skip_list_finds_every_rank_in_few_steps(fan_out):
    text = "".join(random.Random(fan_out).choices("ab 中.", k=20000))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    starts, length = fill_middle.unit_starts(text)
    at = np.cumsum([0] + [len(u) for u in units])
    skips = fill_middle.SkipList(starts, length, fan_out)
    ranks = [0, 1, len(units) - 1, len(units), *range(0, len(units), 97)]
    assert [skips.seek(r) for r in ranks] == [at[r] for r in ranks]
    # The lanes carry all units and all code points, and the search does not walk the lowest lane.
    assert all(u.sum() == len(units) and p.sum() == length for u, p, _ in skips.lanes)
    assert skips.steps / len(ranks) < 4 * fan_out * len(skips.lanes)
    assert fill_middle.SkipList(*fill_middle.unit_starts(""), fan_out).seek(0) == 0
