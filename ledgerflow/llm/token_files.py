"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of its documents one after the other, in blocks of `BLOCK` ids:

- the block's least id is subtracted from all of them;
- what is left is packed at the width that holds the `PERCENTILE` least of them (32
  lanes of 32 values, so packing and unpacking are a few shifts of whole columns);
- ids that need more bits are exceptions: their places and their upper bits stand
  behind the packed words and are patched in when the block is read.

After the blocks come the index of block starts (so any range of ids is read without
the blocks before it), the index of documents, and a tail of fixed size that tells
where the two begin.

Documents are dealt to the tasks by ranges of doc_id and sorted, so the files, in the
order of the manifest, hold all documents in ascending doc_id order. A task writes files
of its own and returns a manifest row for each; a task that is run again writes new
files, and the manifest, written by the job that succeeded, names only those that
count. The ids before a file are a running sum over the manifest, one row a file.

The tokenizer of the `tokenizers` library meets distinct words (text between ASCII
white space); their ids are remembered, for `REMEMBERED` words in a worker. That gives the ids of the whole text where the tokenizer's own splitting never
joins characters across white space and drops it; other tokenizers take
`by_words=False` and whole texts.

Defined results: a null or empty text has the end id only. Null doc_ids come first. Rows
of one doc_id follow each other, ordered by a hash of the text; each row is a document
of its own. Other columns of the input are not read, whatever their names. Without rows
there are no files, and the manifest is empty.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import per_worker, stable, work_dir

BLOCK = 1024  # 32 lanes of 32 ids
LANES = 32
PERCENTILE = 0.9
END_ID = 1
FLUSH_IDS = 256 * BLOCK  # packed at once
FILE_IDS = 1 << 26  # a file that has grown past it is closed; a document is never split
FILE_DOCS = 1 << 20  # bounds the index of documents that a writer holds
READ_IDS = 256 * BLOCK  # unpacked at once
REMEMBERED = 1 << 20  # about 200 MB in a worker
WORD_BYTES = 64  # longer words are not remembered
PLAIN = r"([A-Za-z]+)([.,;:!?&%$#*()]*)"
PROVED = 256  # plain words that each worker encodes the long way too
PART_BYTES = 1 << 20  # of text, split into words at once
MAGIC = b"LFPFOR01"
HEAD = "<IHBB"  # least id, number of exceptions, width, unused
TAIL = "<QQQQI4x8s"  # ids, documents, blocks, place of the indexes, block size, magic
HEAD_BYTES, TAIL_BYTES = struct.calcsize(HEAD), struct.calcsize(TAIL)
MANIFEST = "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"


# --- blocks ---------------------------------------------------------------------------


def widths(deltas: np.ndarray, percentile: float = PERCENTILE) -> np.ndarray:
    """For each row, the bits that hold its values up to the percentile."""
    at = max(int(np.ceil(percentile * deltas.shape[1])) - 1, 0)
    return np.frexp(np.partition(deltas, at, axis=1)[:, at].astype(np.float64))[1]


def _mask(width: int) -> np.uint32:
    return np.uint32((1 << width) - 1)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of rows of BLOCK values, as width * LANES words a row."""
    v = values.reshape(len(values), -1, LANES) & _mask(width)
    out = np.zeros((len(values), width, LANES), dtype=np.uint32)
    for i in range(BLOCK // LANES):
        word, bit = divmod(i * width, 32)
        if width:
            out[:, word] |= v[:, i] << np.uint32(bit)
            if bit + width > 32:
                out[:, word + 1] |= v[:, i] >> np.uint32(32 - bit)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The values of `_pack`, from an array of shape (rows, width, LANES)."""
    out = np.zeros((len(words), BLOCK // LANES, LANES), dtype=np.uint32)
    for i in range(BLOCK // LANES):
        word, bit = divmod(i * width, 32)
        if width:
            v = words[:, word] >> np.uint32(bit)
            if bit + width > 32:
                v = v | words[:, word + 1] << np.uint32(32 - bit)
            out[:, i] = v & _mask(width)
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Whole blocks of ids (a multiple of BLOCK), packed."""
    rows = ids.astype(np.uint32, copy=False).reshape(-1, BLOCK)
    least = rows.min(axis=1)
    deltas = rows - least[:, None]
    width = widths(deltas, percentile)
    upper = (deltas.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype(np.uint32)
    packed: list[bytes] = [b""] * len(rows)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        words = _pack(deltas[at], w).astype("<u4", copy=False)
        for k, block in zip(at.tolist(), words):
            packed[k] = block.tobytes()
    row, place = np.nonzero(upper)
    first = np.searchsorted(row, np.arange(len(rows) + 1))
    place, high = place.astype("<u2"), upper[upper != 0].astype("<u4")
    out = []
    for k, (low, w) in enumerate(zip(least.tolist(), width.tolist())):
        a, b = first[k], first[k + 1]
        out.append(struct.pack(HEAD, low, b - a, w, 0) + packed[k] + place[a:b].tobytes() + high[a:b].tobytes())
    return out


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts` in `raw`."""
    out = np.empty((len(starts), BLOCK), dtype=np.uint32)
    heads = [struct.unpack_from(HEAD, raw, s) for s in starts.tolist()]
    width = np.array([h[2] for h in heads])
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        words = np.empty((len(at), w, LANES), dtype=np.uint32)
        for j, k in enumerate(at.tolist()):
            words[j] = np.frombuffer(raw, "<u4", w * LANES, int(starts[k]) + HEAD_BYTES).reshape(w, LANES)
        out[at] = _unpack(words, w)
    for k, (low, n, w, _) in enumerate(heads):
        if n:
            at = int(starts[k]) + HEAD_BYTES + 4 * w * LANES
            place, high = np.frombuffer(raw, "<u2", n, at), np.frombuffer(raw, "<u4", n, at + 2 * n)
            out[k, place] |= high << np.uint32(w)
        out[k] += np.uint32(low)
    return out.reshape(-1)


# --- files ----------------------------------------------------------------------------


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Writer:
    """One file of documents' ids. What it holds is one flush of ids and the two indexes."""

    def __init__(self, path: str, percentile: float = PERCENTILE):
        self.path, self.percentile = path, percentile
        system, place = _open(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(place, compression=None)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.at = 0
        self.starts, self.names, self.known, self.ends = array("Q"), array("q"), bytearray(), array("Q")

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.names.append(0 if doc_id is None else doc_id)
        self.known.append(doc_id is not None)
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= FLUSH_IDS:
            self._flush(self.n_held - self.n_held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for first in range(0, n, FLUSH_IDS):
            for block in encode_blocks(ids[first : min(first + FLUSH_IDS, n)], self.percentile):
                self.starts.append(self.at)
                self.out.write(block)
                self.at += len(block)
        self.held = [ids[n:].copy()] if n < len(ids) else []
        self.n_held = len(ids) - n

    def close(self) -> int:
        """Ends the file; its size."""
        if self.n_held:
            rest = -self.n_held % BLOCK
            last = np.concatenate(self.held)
            self.held.append(np.full(rest, last[-1], dtype=np.uint32))  # the tail tells how many ids count
            self.n_held += rest
            self._flush(self.n_held)
        places = self.at
        for part in (self.starts, self.names, self.ends):
            raw = np.frombuffer(part, dtype=part.typecode).astype("<i8" if part.typecode == "q" else "<u8") if part else b""
            self.out.write(bytes(raw))
        self.out.write(bytes(self.known))
        self.out.write(struct.pack(TAIL, self.n_ids, len(self.names), len(self.starts), places, BLOCK, MAGIC))
        size = places + 8 * len(self.starts) + 17 * len(self.names) + TAIL_BYTES
        self.out.close()
        return size


class TokenFile:
    """A file to read: documents by the index, any range of ids by the block starts."""

    def __init__(self, path: str):
        system, place = _open(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(TAIL_BYTES, size - TAIL_BYTES)
        self.n_ids, self.n_docs, n_blocks, self.places, block, magic = struct.unpack(TAIL, tail)
        if magic != MAGIC or block != BLOCK:
            raise ValueError(f"{path} is not a token file")
        raw = self.file.read_at(size - TAIL_BYTES - self.places, self.places)
        a, b, c = 8 * n_blocks, 8 * (n_blocks + self.n_docs), 8 * (n_blocks + 2 * self.n_docs)
        self.starts = np.append(np.frombuffer(raw[:a], "<u8"), self.places).astype(np.int64)
        self.names = np.frombuffer(raw[a:b], "<i8")
        self.ends = np.frombuffer(raw[b:c], "<u8").astype(np.int64)
        self.known = np.frombuffer(raw[c:], np.uint8).astype(bool)

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids from place `first` up to place `end`; only their blocks are read."""
        if end <= first:
            return np.empty(0, np.uint32)
        a, b = first // BLOCK, (end - 1) // BLOCK + 1
        base = int(self.starts[a])
        raw = self.file.read_at(int(self.starts[b]) - base, base)
        return decode_blocks(raw, self.starts[a:b] - base)[first - a * BLOCK : end - a * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, Iterator[np.ndarray]]]:
        """For each document its number, its place, and its ids in pieces of at most READ_IDS."""
        begins = np.append(0, self.ends[:-1]) if self.n_docs else self.ends
        held, low, high = np.empty(0, np.uint32), 0, 0

        def pieces(a: int, b: int) -> Iterator[np.ndarray]:
            nonlocal held, low, high
            while a < b:
                if not low <= a < high:
                    low = a - a % BLOCK
                    high = min(low + READ_IDS, self.n_ids)
                    held = self.ids(low, high)
                upto = min(b, high)
                yield held[a - low : upto - low]
                a = upto

        for k, (a, b) in enumerate(zip(begins.tolist(), self.ends.tolist())):
            yield k, a, pieces(a, b)

    def close(self) -> None:
        self.file.close()


# --- tokenizer ------------------------------------------------------------------------


class Words:
    """Ids of words, as bytes. A new plain word is asked of the tokenizer's model, piece by piece;
    any other new word of the whole tokenizer."""

    def __init__(self, tokenizer, plain: str | None):
        self.tokenizer = tokenizer
        self.plain = re.compile(plain) if plain else None
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.left = PROVED

    def piece(self, text: str) -> bytes:
        made = self.pieces.get(text)
        if made is None:
            made = array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
            if len(self.pieces) < REMEMBERED // 4:
                self.pieces[text] = made
        return made

    def of(self, word: bytes) -> bytes:
        text = word.decode()
        found = self.plain and self.plain.fullmatch(text)
        if not found or self.left:
            made = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if found:
            pieces = b"".join([self.piece(p.lower()) for p in found.groups() if p])
            if self.left:
                # The first plain words of a worker are encoded both ways.
                self.left -= 1
                if pieces != made:
                    raise ValueError(f"the tokenizer does not take plain words piece by piece: {text!r}")
            made = pieces
        if len(self.words) < REMEMBERED and len(word) <= WORD_BYTES:
            self.words[word] = made
        return made

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        near = Near(self)
        # bytes.split: at ASCII white space, in runs.
        return [np.frombuffer(b"".join(map(near.__getitem__, t.split())), dtype=np.uint32) for t in texts]


class Near(dict):
    """The words of a few texts: a table small enough to stay in the processor's cache."""

    def __init__(self, known: Words):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> bytes:
        made = self.known.words.get(word)
        self[word] = made = self.known.of(word) if made is None else made
        return made


def parts(text: bytes) -> Iterator[bytes]:
    """A long text cut before white space, into parts of about PART_BYTES."""
    at = 0
    while len(text) - at > PART_BYTES:
        found = re.compile(rb"[\x20\x09-\x0D]").search(text, at + PART_BYTES)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class Encoder(NamedTuple):
    """Makes, in a worker, the function from texts in UTF-8 to their ids. A worker keeps one function for a key."""

    key: str
    build: Callable[[], Callable[[list[bytes]], list[np.ndarray]]]


def encoder(path: str | None = None, by_words: bool = True, plain: str | None = PLAIN) -> Encoder:
    """The encoder of the tokenizer file at `path`.

    The file is read here and travels with the function: executors need no copy of it.
    `plain` describes words whose groups the tokenizer lower-cases and takes as pieces of
    their own; each goes to its model without the work before it. None: there are none.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        saved = f.read()

    def build() -> Callable[[list[bytes]], list[np.ndarray]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(saved)
        if by_words:
            known = Words(tokenizer, plain)

            def one(text: bytes) -> np.ndarray:
                return np.concatenate([known.encode([p])[0] for p in parts(text)])

            return lambda texts: known.encode(texts) if len(texts) > 1 else [one(t) for t in texts]
        return lambda texts: [
            np.array(tokenizer.encode(t.decode(), add_special_tokens=False).ids, dtype=np.uint32) for t in texts
        ]

    return Encoder(f"{hashlib.sha256(saved.encode()).hexdigest()} {by_words} {plain}", build)


def groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of the batch in order, each of about PART_BYTES of text or one longer text."""
    names = batch.column(0).to_pylist()
    own, texts, size = [], [], 0
    for k, name in enumerate(names):
        text = batch.column(1)[k].as_py()
        if texts and size + len(text) > PART_BYTES:
            yield own, texts
            own, texts, size = [], [], 0
        own.append(name)
        texts.append(text)
        size += len(text)
    if texts:
        yield own, texts


# --- Spark ----------------------------------------------------------------------------


def write_ids(
    docs: DataFrame,
    encode: Encoder | None = None,
    folder: str | None = None,
    end_id: int = END_ID,
    percentile: float = PERCENTILE,
) -> DataFrame:
    """Token files of `docs` (doc_id, text) in `folder`, and their manifest.

    Manifest: part, seq (the order of the files), file, n_docs, n_ids, n_bytes, first
    (the number of ids in the files before).
    """
    spark = docs.sparkSession
    folder = folder or f"{work_dir(spark)}/tokens-{uuid.uuid4().hex}"
    key, build = encode or encoder()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("of_text"),
        # Spreads rows that repeat both id and text over as many ranges as they need.
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["doc_id", "of_text", "place"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    end = np.array([end_id], dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = per_worker(key, build)
        part, done, out = TaskContext.get().partitionId(), [], None

        def close() -> None:
            size = out.close()
            done.append((part, len(done), out.path, len(out.names), out.n_ids, size))

        try:
            for names, texts in (g for batch in batches for g in groups(batch)):
                for name, ids in zip(names, ids_of(texts)):
                    if out is None:
                        out = Writer(f"{folder}/{uuid.uuid4().hex}.ids", percentile)
                    out.add(name, np.concatenate([ids, end]))
                    if out.n_ids >= FILE_IDS or len(out.names) >= FILE_DOCS:
                        close()
                        out = None
            if out is not None:
                close()
                out = None
        finally:
            if out is not None:
                out.out.close()
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(v, t) for v, t in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "file", "n_docs", "n_ids", "n_bytes"])

    manifest = stable(dealt.mapInArrow(run, MANIFEST))
    # One row a file: the only order over all of them.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    `with_ids` adds the ids (array of long); without them no document is held whole.
    """
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Not coalesced: a manifest row is small, what it leads to is not.
    placed = manifest.select("file", "first").repartition(parts, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + ([pa.list_(pa.int64())] if with_ids else [])
        labels = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
        rows, weight = [], 0

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=labels)

        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = TokenFile(path)
                for k, at, pieces in source.documents():
                    crc, n, own = 0, 0, []
                    for piece in pieces:
                        crc = zlib.crc32(piece.astype("<u4", copy=False).tobytes(), crc)
                        n += len(piece)
                        if with_ids:
                            own.append(piece)
                    name = int(source.names[k]) if source.known[k] else None
                    row = (name, first + at, n, crc)
                    rows.append((*row, np.concatenate(own).astype(np.int64)) if with_ids else row)
                    weight += n if with_ids else 1
                    if len(rows) >= 4096 or weight >= FLUSH_IDS:
                        yield table()
                        rows.clear()
                        weight = 0
                source.close()
        if rows:
            yield table()

    return placed.mapInArrow(run, READ + (", ids array<long>" if with_ids else ""))
