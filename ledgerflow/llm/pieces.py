"""SentencePiece encoding and decoding by one Viterbi pass over an Aho-Corasick automaton.

The automaton holds all ordinary pieces. Reading a character moves along its
goto and failure links; the output links of the state reached name every piece
that ends here, longest first, and each relaxes the best score at this position
from the one at its start. A character with no piece of its own may be taken
alone, at the least score of the vocabulary less 10, and becomes byte pieces (or
the unknown piece if the vocabulary has none).

A best segmentation never crosses a place that no piece crosses, so a text is
cut at those places first (before a run of spaces, around line feeds and tabs,
where the vocabulary allows it) and each distinct chunk is segmented once per
worker. The cuts follow from the vocabulary and change no result.

Normalisation: one space is put before the text and spaces become U+2581; white
space is kept as it is. A U+2581 of the text itself becomes byte pieces, so every
text decodes to itself if the vocabulary has byte pieces. Ties of the score go to
the longer last piece.

Defined results: null text has null ids and null decoded text, an empty text no
ids; unknown ids decode to nothing. Input columns named like an output column are
replaced; all others, and repeated rows, pass through.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.common import per_worker

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Distinct chunks remembered by a worker; when full, it starts anew.
REMEMBERED = 600_000


class Vocabulary:
    """Pieces by id: text, score, and kind ("piece", "byte", "unknown" or "other")."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.pieces = pieces

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if sp.is_byte(i):
                return "byte"
            if sp.is_unknown(i):
                return "unknown"
            return "other" if sp.is_control(i) or sp.is_unused(i) else "piece"

        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])


class Encoder:
    """Aho-Corasick automaton and Viterbi over one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        own = [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k == "piece" and p]
        self.alone = min((s for _, s, _ in own), default=0.0) - UNKNOWN_PENALTY
        self.goto: list[dict[str, int]] = [{}]
        # Of each state: its piece as (length, score, id), failure link, and nearest state with a piece.
        self.piece: list[tuple[int, float, int] | None] = [None]
        for text, score, i in own:
            at = 0
            for ch in text:
                to = self.goto[at].get(ch)
                if to is None:
                    to = self.goto[at][ch] = len(self.goto)
                    self.goto.append({})
                    self.piece.append(None)
                at = to
            if self.piece[at] is None or score > self.piece[at][1]:
                self.piece[at] = (len(text), score, i)
        self.fail = [0] * len(self.goto)
        outs: list[tuple] = [()] * len(self.goto)
        todo = deque(self.goto[0].values())
        for at in todo:
            outs[at] = (self.piece[at],) if self.piece[at] else ()
        while todo:
            at = todo.popleft()
            for ch, to in self.goto[at].items():
                f = self.fail[at]
                while f and ch not in self.goto[f]:
                    f = self.fail[f]
                self.fail[to] = f = self.goto[f].get(ch, 0)
                # The output links, followed once here: pieces that end in this state, longest first.
                outs[to] = ((self.piece[to],) if self.piece[to] else ()) + outs[f]
                todo.append(to)
        self.outs = outs
        inner = {c for p, _, _ in own if len(p) > 1 for c in p}
        self.marks_lead = all(SPACE_MARK not in p.lstrip(SPACE_MARK) for p, _, _ in own)
        single = [c for c in "\n\t\r" if c not in inner]
        apart = "".join(map(re.escape, single))
        if self.marks_lead:
            pattern = rf"{SPACE_MARK}*[^{SPACE_MARK}{apart}]+|{SPACE_MARK}+" + (f"|[{apart}]" if single else "")
        else:
            pattern = r"(?s).+"
        self.cut = re.compile(pattern).findall
        self.seen = _Chunks(self)

    def viterbi(self, text: str) -> list[int]:
        goto, fail, outs, alone = self.goto, self.fail, self.outs, self.alone
        n = len(text)
        best = [0.0] + [-1e300] * n
        # Of each end: start and id (-1: a character taken alone) of the best last piece.
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        at = 0
        for end in range(1, n + 1):
            ch = text[end - 1]
            while at and ch not in goto[at]:
                at = fail[at]
            at = goto[at].get(ch, 0)
            found = outs[at]
            top, link = -1e300, None
            for size, score, i in found:
                s = best[end - size] + score
                if s > top:
                    top, link = s, (end - size, i)
            if not found or found[-1][0] > 1:
                s = best[end - 1] + alone
                if s > top:
                    top, link = s, (end - 1, -1)
            best[end], back[end] = top, link
        ids: list[int] = []
        end = n
        while end:
            start, i = back[end]
            if i >= 0:
                ids.append(i)
            elif self.bytes:
                ids.extend(self.bytes.get(b, self.unknown) for b in reversed(text[start:end].encode()))
            else:
                ids.append(self.unknown)
            end = start
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as the bytes of 32-bit integers."""
        if not text:
            return b""
        if SPACE_MARK not in text:
            return b"".join(map(self.seen.__getitem__, self.cut(SPACE_MARK + text.replace(" ", SPACE_MARK))))
        # A mark of the text itself is none of the pieces' marks: a stand-in that no piece has takes its place.
        out = []
        for k, part in enumerate((" " + text).split(SPACE_MARK)):
            if k:
                out.append(array("i", [self.bytes.get(b, self.unknown) for b in SPACE_MARK.encode()] if self.bytes else [self.unknown]).tobytes())
            out.extend(map(self.seen.__getitem__, self.cut(part.replace(" ", SPACE_MARK))))
        return b"".join(out)


class _Chunks(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = array("i", self.encoder.viterbi(chunk)).tobytes()
        if len(chunk) < 64:
            self[chunk] = ids
        return ids


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n.lower() != name.lower()]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in kept), values], names=[*(batch.schema.names[i] for i in kept), name]
    )


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema if f.name.lower() != name.lower()), T.StructField(name, kind)])


# Rows worked on at once, so that what a batch makes stays small.
SLICE = 256


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their texts; no shuffle, one pass over each text."""
    sent = df.sparkSession.sparkContext.broadcast(vocabulary.pieces)  # as large as the vocabulary
    key = ("pieces", hash(tuple(vocabulary.pieces)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(key, lambda: Encoder(sent.value))
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                parts = [None if t is None else encoder.encode(t) for t in texts]
                sizes = np.array([len(p) // 4 if p else 0 for p in parts], dtype=np.int64)
                flat = np.frombuffer(b"".join(p for p in parts if p), dtype=np.int32)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                gone = pa.array([p is None for p in parts])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=gone)
                yield _with_column(batch, ids, lists)

    return df.mapInArrow(run, _schema_with(df, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids."""
    sent = df.sparkSession.sparkContext.broadcast(vocabulary.pieces)

    def surface() -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if kind == "byte" else b"" if kind == "other" else p.replace(SPACE_MARK, " ").encode()
            for p, _, kind in sent.value
        ]

    key = ("surface", hash(tuple(vocabulary.pieces)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_worker(key, surface)
        size = len(of)
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                column = batch.column(batch.schema.get_field_index(ids))
                out = []
                for k in range(batch.num_rows):
                    one = column[k]
                    if not one.is_valid:
                        out.append(None)
                        continue
                    raw = one.values.to_numpy().tolist() if not one.values.null_count else one.values.to_pylist()
                    joined = b"".join([of[i] for i in raw if i is not None and 0 <= i < size])
                    out.append(joined[joined[:1] == b" " :].decode(errors="replace"))
                yield _with_column(batch, text, pa.array(out, pa.string()))

    return df.mapInArrow(run, _schema_with(df, text, T.StringType()))
