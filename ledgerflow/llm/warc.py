"""WARC archives: written with an index, read by coalesced byte ranges.

Every record is a gzip member of its own, so that it can be read by its offset and
length alone. A task writes its records into archives of its own in the shared
folder and returns the index of what it wrote: file, offset, length, URL, digest.
A task that is run again writes new files; the index, written by the job that
succeeded, names only those that count.

Payloads are compressed in the scan, so the one shuffle that decides which record
stands for equal payloads moves compressed bytes. Equal payloads of at least
`REVISIT_BYTES` bytes are stored once, under the smallest page_id; the others are
revisit records (profile identical-payload-digest) that refer to it.

Reading takes index rows, sorts them by file and offset, joins ranges that lie
close together into one read, and checks every payload against its digest.

Archives are opened with pyarrow's file systems by URI, which knows local paths,
S3, GCS and HDFS.

Defined results: null html is an empty payload, a null url an empty target URI. A
null page_id is never the smallest of a group with other ids. Rows that repeat both
page_id and payload are all response if they are the group's smallest. An input
column of another name is not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import small_batches, stable, work_dir
from ledgerflow.llm.ngram_join import slices

REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30  # an archive that has grown past it is closed
GAP_BYTES = 64 << 10  # ranges no farther apart are read at once
READ_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, file string, offset long, length long"


def _name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest[:16]}>"


def record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: int | None = None, date: str = DATE) -> bytes:
    """One gzip member; a response with the payload, or a revisit without."""
    revisit = payload is None
    block = HTTP + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",  # an extension field: a revisit has no payload to count
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to, digest)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, in lower case, and payload of one member; raises if it is not what it says."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and "sha256:" + hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"]:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return fields, payload


def _page(name: str) -> int | None:
    text = name.strip("<>").split(":")[2]
    return int(text) if text else None


def decide(pages: DataFrame) -> DataFrame:
    """The records, packed, and the page that each of them revisits.

    The first pages of equal payloads join back on digest and hash: so they get a shuffle
    of their own, and the rows of a payload that fills much of the table can be split.
    """
    c = F.col
    payload = F.coalesce(c("html"), F.lit(""))
    facts = pages.select(
        c("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    first = (
        facts.where(c("size") >= REVISIT_BYTES).groupBy(c("digest").alias("of")).agg(F.min("page_id").alias("first"))
        .withColumn("mark", F.xxhash64("of"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids, urls, html, digests, sizes = (batch.column(i).to_pylist() for i in range(5))
            made = [record(i, u, d, n, h.encode()) for i, u, h, d, n in zip(ids, urls, html, digests, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.binary()), batch.column(3), batch.column(4)],
                names=["page_id", "url", "member", "digest", "size"],
            )

    packed = facts.mapInArrow(pack, "page_id long, url string, member binary, digest string, size long")
    same = (c("digest") == c("of")) & (F.xxhash64("digest") == c("mark"))
    return packed.join(first, same, "left").select(
        "page_id", "url", "member", "digest", "size",
        F.when(c("first").isNotNull() & (c("size") >= REVISIT_BYTES) & ~c("page_id").eqNullSafe(c("first")), c("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archives of `pages` (page_id, url, html) in `folder`, and their index (one row per record)."""
    folder = folder or f"{work_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows, name, at = None, [], "", 0
        system = None
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length"]

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

        try:
            for batch in batches:
                ids, urls, _, digests, sizes, refers = (batch.column(i).to_pylist() if i != 2 else None for i in range(6))
                for k in range(batch.num_rows):
                    if out is None:
                        name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        system, place = fs.FileSystem.from_uri(name)
                        system.create_dir(place.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(place, compression=None)
                    to = refers[k]
                    member = batch.column(2)[k].as_py() if to is None else record(ids[k], urls[k], digests[k], sizes[k], None, to)
                    out.write(member)
                    rows.append((ids[k], urls[k], digests[k], sizes[k], "response" if to is None else "revisit", to, name, at, len(member)))
                    at += len(member)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                        yield table()
                        rows.clear()
        finally:
            if out is not None:
                out.close()
        if rows:
            yield table()

    # Pages may be large: a batch of the usual 10,000 would take as many times a page, in the JVM and in the worker.
    with small_batches(pages.sparkSession, 64):
        return stable(decide(pages).mapInArrow(write, INDEX))


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Reads (file, offset, length, row numbers) that cover rows (file, offset, length) sorted by file and offset."""
    file, start, end, own = "", 0, 0, []
    for k, (name, offset, length) in enumerate(rows):
        if own and name == file and offset - end <= GAP_BYTES and offset + length - start <= READ_BYTES:
            end = max(end, offset + length)
            own.append(k)
            continue
        if own:
            yield file, start, end - start, own
        file, start, end, own = name, offset, offset + length, [k]
    if own:
        yield file, start, end - start, own


def read_records(index: DataFrame) -> DataFrame:
    """The records of the given index rows, each as its archive has it.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to and
    payload (null for a revisit).
    """
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By file and not coalesced: an index row is small, what it leads to is not.
    placed = index.select("file", "offset", "length").repartition(parts, "file").sortWithinPartitions("file", "offset")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for file, start, length, own in ranges(rows):
                system, place = fs.FileSystem.from_uri(file)
                with system.open_input_file(place) as f:
                    raw = f.read_at(length, start)
                out = []
                for k in own:
                    _, offset, size = rows[k]
                    fields, payload = parse(raw[offset - start : offset - start + size])
                    refers = fields.get("warc-refers-to")
                    out.append((
                        _page(fields["warc-record-id"]), fields["warc-target-uri"], int(fields["warc-payload-length"]),
                        fields["warc-payload-digest"].partition(":")[2], fields["warc-type"],
                        _page(refers) if refers else None, payload if fields["warc-type"] == "response" else None,
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=names)

    return placed.mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
