"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its byte trigrams, hashed into a fixed number of columns, and
one pseudo-term for the share of words that repeat the word before. Damped counts are weighted
by inverse document frequency and projected onto the leading singular directions
of a bounded sample of labelled texts (truncated SVD). The sample's vectors are
sent to every task; each block of documents is multiplied with all of them, which
gives every cosine exactly, and the `neighbours` nearest vote with their
similarities as weights.

What is fitted is bounded by `Settings.sample` rows: the labelled documents whose
hashed ids are smallest. Every document, and the whole of its text, is scored.

Defined results: a text without a term (null, or under three bytes) scores 0, as
does every text where no label can be learned from. Labels that are null are no
labels; several labels of one document count as their mean. Repeated rows are
scored alike; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import replacing
from ledgerflow.llm.pieces import _schema_with, _with_column


@dataclass(frozen=True)
class Settings:
    sample: int = 4000  # labelled documents that are learned from, at most
    columns: int = 4096  # hashed term columns
    rank: int = 64  # latent directions
    neighbours: int = 25
    sharpness: float = 8.0  # a neighbour's weight is its similarity to this power
    threshold: float = 0.7


BLOCK = 256
# Weight of the share of repeated words against the damped counts of trigrams.
REPEATS = 30.0


def terms(text: str | None, columns: int) -> np.ndarray | None:
    """Damped counts of a text's terms, or None if it has none."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return None
    code = raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)
    code = (code ^ code >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(7)
    count = np.bincount(code % np.uint32(columns - 1) + 1, minlength=columns).astype(np.float32)
    found = text.split()
    out = np.log1p(count)
    out[0] = REPEATS * sum(map(str.__eq__, found, found[1:])) / len(found) if found else 0
    return out


def term_block(texts: list[str | None], columns: int) -> np.ndarray:
    block = np.zeros((len(texts), columns), dtype=np.float32)
    for k, t in enumerate(texts):
        one = terms(t, columns)
        if one is not None:
            block[k] = one
    return block


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


@dataclass(frozen=True)
class Model:
    """Weights of the terms, latent directions, and the labelled vectors with their labels."""

    weight: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    settings: Settings

    def project(self, block: np.ndarray) -> np.ndarray:
        return _unit(_unit(block * self.weight) @ self.directions)

    def score(self, block: np.ndarray) -> np.ndarray:
        """Scores of a block of term counts."""
        if not len(self.labels):
            return np.zeros(len(block))
        cosine = self.project(block) @ self.vectors.T
        k = min(self.settings.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** self.settings.sharpness
        total = weight.sum(1)
        votes = (weight * self.labels[near]).sum(1)
        return np.where(total > 0, np.round(votes / np.where(total > 0, total, 1), 6), 0.0) * (block.any(1))


def fit(block: np.ndarray, labels: np.ndarray, settings: Settings) -> Model:
    """Truncated SVD of the weighted terms, by subspace iteration from a fixed start."""
    n = len(labels)
    used = (block > 0).sum(0)
    weight = (np.log((1 + n) / (1 + used)) + 1).astype(np.float32)
    if not n:
        return Model(weight, np.zeros((settings.columns, 1), np.float32), np.zeros((0, 1), np.float32), labels, settings)
    x = _unit(block * weight)
    rank = min(settings.rank, n)
    q = np.random.default_rng(7).standard_normal((settings.columns, min(rank + 16, n))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    directions = (q @ vt[:rank].T).astype(np.float32)
    return Model(weight, directions, _unit(x @ directions), labels, settings)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "quality") -> Model:
    """Fit on the sample of labelled documents; `labels` has doc_id and `label`.

    Only ids and labels are ordered to find the sample; its ids, at most
    `settings.sample`, are broadcast, and the terms of at most as many texts (64 MB
    with the defaults) come to the driver.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    )
    texts = docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(chosen), "doc_id")
    columns = settings.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t, columns) for t in batch.column(1).to_pylist()]
            keep = [k for k, x in enumerate(found) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(2).take(pa.array(keep, pa.int64())),
                 pa.array([found[k].astype(np.float16).tobytes() for k in keep], pa.binary())],
                names=["doc_id", "label", "terms"],
            )

    # A repeated document keeps one of its rows; `sample` rows are the most that can be left.
    got = (
        texts.mapInArrow(run, "doc_id long, label double, terms binary")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("terms").alias("terms"))
        .toArrow().sort_by("doc_id")
    )
    block = np.stack([np.frombuffer(t.as_py(), np.float16) for t in got["terms"]]) if got.num_rows else np.zeros((0, columns))
    return fit(block.astype(np.float32), got["label"].to_numpy().astype(np.float64), settings)


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """The rows with the scores of their texts; no shuffle. The model, about 2 MB, is broadcast."""
    # Arrays and numbers only: a broadcast class would have to be importable on the executors.
    settings = tuple(vars(model.settings).items())
    sent = df.sparkSession.sparkContext.broadcast((model.weight, model.directions, model.vectors, model.labels, settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *arrays, settings = sent.value
        own = Model(*arrays, Settings(**dict(settings)))
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                yield _with_column(batch, to, pa.array(own.score(term_block(texts, own.settings.columns)), pa.float64()))

    return df.mapInArrow(run, _schema_with(df, to, T.DoubleType()))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows with held_out, score and predicted, learned from the labels that are not held out."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))), settings)
    scored = score(docs, model)
    return replacing(
        scored,
        held_out=held_out(F.col("doc_id")),
        predicted=(F.col("score") >= settings.threshold).cast("int"),
    )
