"""Token counts by a linear longest-match automaton (after Song et al., 2021).

Greedy word-piece splitting takes, again and again, the longest vocabulary entry
at the start of what is left of a word. Here the vocabulary is a byte trie whose
nodes carry a failure link and the number of pieces popped on the way to it, both
computed once: when a node has no edge for the next byte, its popped count is
added and the scan goes on from the link, without reading a byte again and
without building a piece.

A word is a maximal run without ASCII white space, with one space put before it:
entries that begin with a space are the initial pieces, all others continue a
word. A word that cannot be split to its end counts as one token (unknown).

Defined results: null and empty texts have 0 tokens; the rows, repeated ones too,
pass through; an input column named like an output column is replaced.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.common import per_worker
from ledgerflow.llm.pieces import _schema_with, _with_column

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Distinct words remembered by a worker; when full, it starts anew.
REMEMBERED = 600_000


def read_ranks(path: str = RANKS) -> list[bytes]:
    """The entries of a ranks file: one base64 entry and its rank to a line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Trie with failure links and popped counts."""

    def __init__(self, vocabulary: Iterable[bytes]):
        goto: list[dict[int, int]] = [{}]
        entry = [False]
        for token in vocabulary:
            at = 0
            for b in token:
                to = goto[at].get(b)
                if to is None:
                    to = goto[at][b] = len(goto)
                    goto.append({})
                    entry.append(False)
                at = to
            entry[at] = at > 0
        # link -1: what has been read cannot be split.
        link, popped = [-1] * len(goto), [0] * len(goto)
        todo = deque([0])
        while todo:
            at = todo.popleft()
            for b, to in goto[at].items():
                if entry[to]:
                    link[to], popped[to] = 0, 1
                else:
                    z, n = link[at], popped[at]
                    while z >= 0 and b not in goto[z]:
                        n += popped[z]
                        z = link[z]
                    if z >= 0:
                        link[to], popped[to] = goto[z][b], n
                todo.append(to)
        self.goto, self.link, self.popped = goto, link, popped
        self.seen = _Words(self)

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 if it cannot be split."""
        goto, link, popped = self.goto, self.link, self.popped
        at = n = 0
        for b in word:
            while b not in goto[at]:
                n += popped[at]
                at = link[at]
                if at < 0:
                    return 1
            at = goto[at][b]
        while at:
            n += popped[at]
            at = link[at]
            if at < 0:
                return 1
        return n

    def tokens(self, text: bytes) -> tuple[int, int]:
        """Tokens and words of a text."""
        found = text.split()
        return sum(map(self.seen.__getitem__, found)), len(found)


class _Words(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.automaton.count(b" " + word)
        if len(word) < 64:
            self[word] = n
        return n


def token_counts(df: DataFrame, vocabulary: list[bytes], text: str = "text", tokens: str = "n_tokens", words: str = "n_words") -> DataFrame:
    """The rows with the number of tokens and words of their texts; no shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary
    key = ("longest match", hash(tuple(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = per_worker(key, lambda: Automaton(sent.value))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            counts = [automaton.tokens(t.as_py() or b"") for t in column]
            batch = _with_column(batch, tokens, pa.array([c[0] for c in counts], pa.int64()))
            yield _with_column(batch, words, pa.array([c[1] for c in counts], pa.int64()))

    schema = _schema_with(df, tokens, T.LongType())
    schema = T.StructType([*(f for f in schema if f.name.lower() != words.lower()), T.StructField(words, T.LongType())])
    return df.mapInArrow(run, schema)
