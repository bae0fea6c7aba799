"""WARC archives: a sharded writer whose files depend on the records alone, and a reader.

Records are cut into shards by ranges of ``page_id``; the bounds are quantiles of a sample that a hash of
the id draws, so they follow from the table and not from how Spark read it. Each shard is sorted and
written by one task, which rolls to the next file by compressed size. Headers, digests and record ids
are made anew from url and payload; the same pages give the same bytes.

A task writes under a temporary name with its attempt in it and reports the file as a row of the manifest.
The manifest is a table that Spark commits, so of a task that ran twice one set of files is in it. Only
those are then renamed to their final names, which can be repeated at will, and readers go by the list of
renamed files. What lost attempts left behind stays temporary and is removed.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.words import only

SHARD_BYTES = 64 << 20  # of payload, about
FILE_BYTES = 16 << 20  # compressed; a file is closed by the record that reaches it
SAMPLED_PER_SHARD = 64
MIN_REVISIT_BYTES = 0
DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "shard bigint, file bigint, temporary string, final string, n_records bigint, n_bytes bigint, sha256 string"
_MANIFEST_NAMES = ["shard", "file", "temporary", "final", "n_records", "n_bytes", "sha256"]
RECORDS = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, intact boolean"
)
_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}:{repeat}')}>"


def _header_value(value: str) -> str:
    """Line breaks would end the header; they travel percent-encoded, as would a percent sign before them."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _from_header(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _headers(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first, *[f"{name}: {value}" for name, value in fields if value is not None]]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n"


class Page(NamedTuple):
    page_id: int | None
    url: str | None
    payload: bytes
    revisits: bool
    refers_to: int | None
    repeat: int  # how many rows of the same id and payload came before


def record(page: Page) -> bytes:
    """A record with headers and digests made from the page, as one gzip member."""
    sum_ = digest(page.payload)
    http = _headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(page.payload))])
    block = http if page.revisits else http + page.payload
    head = _headers("WARC/1.1", [
        ("WARC-Type", "revisit" if page.revisits else "response"),
        ("WARC-Record-ID", record_id(page.page_id, sum_, page.repeat)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if page.url is None else _header_value(page.url)),
        ("WARC-Profile", _PROFILE if page.revisits else None),
        ("WARC-Refers-To", record_id(page.refers_to, sum_, 0) if page.revisits else None),
        ("X-Refers-To-Page", page.refers_to if page.revisits else None),
        ("X-Page", page.page_id),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{sum_}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Length", len(block)),
    ])
    return _member(head + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _file_info(name: str) -> bytes:
    fields = f"software: labelloom\r\nformat: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
    head = _headers("WARC/1.1", [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
        ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(fields)),
    ])
    return _member(head + fields + b"\r\n\r\n")


class _Writer:
    """The open file of a shard."""

    def __init__(self, folder: str, shard: int, attempt: str):
        self._fs, self._path = pafs.FileSystem.from_uri(folder)
        self._shard, self._attempt = shard, attempt
        self._out, self._next = None, 0
        self.finished: list[tuple] = []

    def add(self, data: bytes, file_bytes: int) -> None:
        if self._out is None:
            final = f"{self._shard:06d}-{self._next:05d}.warc.gz"
            self._names = f"temporary/{final}.{self._attempt}", f"archives/{final}"
            self._out = self._fs.open_output_stream(f"{self._path}/{self._names[0]}", compression=None)
            self._n, self._size, self._sum = 0, 0, hashlib.sha256()
            self._write(_file_info(final))
        self._write(data)
        self._n += 1
        if self._size >= file_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self._size += len(data)
        self._sum.update(data)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.finished.append((self._shard, self._next, *self._names, self._n, self._size, self._sum.hexdigest()))
            self._out = None
            self._next += 1


def _shards_written(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        writer, shard, leader = None, None, None
        last, repeat = None, 0
        for batch in batches:
            finished = []
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "page_id", "sha1", "is_page", "leader", "url", "html")]):
                own = row[:3]
                if not row[3]:
                    leader = (own, row[4])
                    continue
                if own[0] != shard:
                    if writer is not None:
                        writer.close()
                        finished += writer.finished
                    shard = own[0]
                    writer = _Writer(folder, shard, attempt)
                repeat = repeat + 1 if own == last else 0
                last = own
                shared = leader is not None and leader[0] == own
                revisits = shared and (leader[1] != own[1] or repeat > 0)
                page = Page(own[1], row[5], row[6] or b"", revisits, leader[1] if revisits else None, repeat)
                writer.add(record(page), file_bytes)
            if writer is not None:
                finished += writer.finished
                writer.finished = []
            if finished:
                yield _manifest_rows(finished)
        if writer is not None:
            writer.close()
            if writer.finished:
                yield _manifest_rows(writer.finished)

    return write


def _manifest_rows(finished: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(_MANIFEST_NAMES, map(list, zip(*finished)))))


def _bounds(pages: DataFrame, shards: int, rows: int) -> np.ndarray:
    """Upper bounds of all shards but the last, by a sample of ``SAMPLED_PER_SHARD`` ids for each."""
    if shards == 1:
        return np.empty(0, np.int64)
    share = min(1.0, shards * SAMPLED_PER_SHARD / rows)
    drawn = pages.select("page_id").where("page_id IS NOT NULL").where(
        F.pmod(F.xxhash64("page_id"), F.lit(1_000_000_007)) < share * 1_000_000_007
    )
    ids = np.sort(drawn.toArrow()["page_id"].to_numpy())
    return ids[np.arange(1, shards) * len(ids) // shards] if len(ids) else np.empty(0, np.int64)


def write(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Archives every row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder``, a folder all
    machines share: ``archives``, ``manifest``, and ``committed``, which is complete when ``write`` returns.

    The payload is the html in UTF-8, empty where it is null. Of pages with equal payloads of at least
    ``min_revisit_bytes`` the one with the smallest id is a response and the others are revisits of it; a row
    that repeats the id and payload of another is a revisit too. A null id comes first in its order and is
    never the smallest unless all are null; a null url is left out of the headers. An empty table gives no
    archive.
    """
    spark = pages.sparkSession
    pages = only(pages, "page_id", "url", "html").select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("html")
    )
    total = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    shards = max(1, -(-(total[1] or 0) // shard_bytes))
    bounds = _bounds(pages, shards, max(1, total[0]))

    # Over Arrow, where a null does not turn the ids of its batch into floats.
    @F.arrow_udf("bigint")
    def shard_of(page_id: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, page_id.fill_null(-(2**63)).to_numpy(), side="right"), pa.int64())

    keyed = pages.select("page_id", F.sha1("html").alias("sha1"), F.octet_length("html").alias("size"))
    shared = keyed.where(F.col("size") >= min_revisit_bytes)
    leaders = shared.groupBy("sha1").agg(F.min("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    notes = shared.join(leaders, "sha1").select(
        "page_id", "sha1", F.lit(False).alias("is_page"), "leader", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("html"),
    )
    rows = pages.select(
        "page_id", F.sha1("html").alias("sha1"), F.lit(True).alias("is_page"), F.lit(None).cast("bigint").alias("leader"),
        "url", "html",
    )
    # Notes of what a page revisits travel along and sort before the page, so payloads move once. Shard i is partition i.
    sorted_ = (
        rows.unionByName(notes).withColumn("shard", shard_of("page_id")).repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "page_id", "sha1", "is_page", "url")
    )
    fs, path = pafs.FileSystem.from_uri(folder)
    for part in ("temporary", "archives"):
        fs.create_dir(f"{path}/{part}")
    sorted_.mapInArrow(_shards_written(folder, file_bytes), _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    listed = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    listed.repartition(shards, "final").mapInArrow(_renamed(folder), _MANIFEST).write.mode("overwrite").parquet(
        f"{folder}/committed"
    )
    fs.delete_dir(f"{path}/temporary")


def _renamed(folder: str):
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                there = fs.get_file_info(f"{path}/{row['temporary']}").type != pafs.FileType.NotFound
                if there:
                    fs.move(f"{path}/{row['temporary']}", f"{path}/{row['final']}")
                size = fs.get_file_info(f"{path}/{row['final']}").size
                if size != row["n_bytes"]:
                    raise OSError(f"{row['final']}: {size} bytes instead of {row['n_bytes']}")
            yield batch

    return rename


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpacker, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            data = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
            data = data or stream.read(chunk)
        else:
            data = stream.read(chunk)
    if parts:
        raise EOFError("the archive ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)


def parsed(data: bytes) -> tuple | None:
    """A row of ``RECORDS``; None for records that are no pages."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    n, is_response = int(_fields(http)["Content-Length"]), fields["WARC-Type"] == "response"
    payload_digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    intact = fields["WARC-Block-Digest"] == f"sha1:{digest(block)}" and (
        not is_response or (len(body) == n and digest(body) == payload_digest)
    )
    url, page, of = fields.get("WARC-Target-URI"), fields.get("X-Page"), fields.get("X-Refers-To-Page")
    return (
        None if page is None else int(page), None if url is None else _from_header(url), body if is_response else None,
        n, payload_digest, fields["WARC-Type"], None if of is None else int(of), intact,
    )


def _records_of(folder: str, with_payload: bool):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for final in batch.column("final").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{path}/{final}", compression=None) as stream:
                    for data in members(stream):
                        row = parsed(data)
                        if row is None:
                            continue
                        rows.append(row if with_payload else (*row[:2], None, *row[3:]))
                        size += len(data) if with_payload else 512
                        if size > 8 << 20:
                            yield _record_batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _record_batch(rows)

    return records


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORDS.types)], schema=_RECORDS)


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row of ``RECORDS`` for every page in the committed archives of a folder. ``intact`` tells whether the
    digests hold; a revisit has no payload of its own, its length and digest are those of the full one."""
    committed = spark.read.schema(_MANIFEST).parquet(f"{folder}/committed").select("final")
    return committed.mapInArrow(_records_of(folder, with_payload), RECORDS)
