"""WARC archives: written as one gzip stream, normalised to a member per record, indexed, read back.

``write_archives``   each task writes its rows as WARC files, each compressed whole
``find_revisits``    which records repeat an earlier found payload
``normalise``        inflates each file once as a stream, rewrites every record as a
                     gzip member of its own, payloads that repeat as ``revisit``
                     records, and writes a sidecar index of the members' offsets
``read_archives``    reads the normalised files by their index, member by member

Files lie in a folder that all executors share, named by any address that
``pyarrow.fs`` opens. A file is written under a passing name and then moved, so
that a task that runs again leaves the same file. A task holds one record at a
time. Rows of digests and offsets pass through Spark, payloads do not.

Of records with equal payloads of ``LEAST_BYTES`` bytes or more that with the
largest ``page_id`` is the response (all that repeat it); records with a null id
revisit it. Null payloads are empty. Empty tables make no file. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, slices
from ledgerline.session import shared_folder

ARCHIVE_BYTES = 256 << 20  # of records in one file, before compression
LEAST_BYTES = 1000
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CATALOG = "archive string, number bigint, page_id bigint, url string, payload_bytes bigint, digest string"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, archive string, offset bigint, length bigint"
)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def _page_id(record_id: str) -> int | None:
    found = record_id[len("<urn:page:") : -1]
    return None if found == "None" else int(found)


def _header(fields: dict[str, str]) -> bytes:
    """A record's header; line breaks in values would end it, so they are percent-encoded."""
    lines = ["WARC/1.1"]
    for name, value in fields.items():
        lines.append(f"{name}: {value}".replace("\r", "%0D").replace("\n", "%0A"))
    return "\r\n".join([*lines, "", ""]).encode()


def _http_header(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def response_record(page_id: int | None, url: str | None, payload: bytes, date: str) -> tuple[bytes, str]:
    """A response record and the payload's SHA-1 in hex."""
    digest = hashlib.sha1(payload)
    http = _http_header(len(payload))
    header = _header({
        "WARC-Type": "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Target-URI": url or "",
        "WARC-Date": date,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest.digest()).decode(),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(http) + len(payload)),
    })
    return header + http + payload + b"\r\n\r\n", digest.hexdigest()


def revisit_record(fields: dict[str, str], http: bytes, refers_to: int, url: str | None) -> bytes:
    """The revisit that stands for a response record, without its payload."""
    kept = {k: v for k, v in fields.items() if k not in ("WARC-Type", "Content-Length")}
    header = _header({
        "WARC-Type": "revisit",
        **kept,
        "WARC-Profile": PROFILE,
        "WARC-Refers-To": _record_id(refers_to),
        "WARC-Refers-To-Target-URI": url or "",
        "Content-Length": str(len(http)),
    })
    return header + http + b"\r\n\r\n"


def parse_header(block: bytes) -> dict[str, str]:
    """Fields of a record's header, without its first line."""
    lines = block.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:] if line)


class Inflated:
    """Reads from a gzip stream of any number of members, never more than asked for and one read ahead."""

    def __init__(self, stream):
        self.stream, self.inflate, self.buffer, self.at = stream, zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        raw = self.inflate.unconsumed_tail or self.inflate.unused_data
        if self.inflate.eof:
            raw = self.inflate.unused_data or self.stream.read(READ_BYTES)
            if not raw:
                return False
            self.inflate = zlib.decompressobj(31)
        elif not raw:
            raw = self.stream.read(READ_BYTES)
        data = self.inflate.decompress(raw, READ_BYTES)
        if not raw and not data and not self.inflate.eof:
            raise EOFError("the gzip stream is cut off")
        del self.buffer[: self.at]
        self.at = 0
        self.buffer += data
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the stream."""
        start = self.at
        while (found := self.buffer.find(mark, start)) < 0:
            left = len(self.buffer) - self.at
            if not self._more():
                if left:
                    raise EOFError("the archive ends within a record")
                return None
            start = max(0, left - len(mark))
        out = bytes(self.buffer[self.at : found + len(mark)])
        self.at = found + len(mark)
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise EOFError("the archive ends within a record")
        out = bytes(self.buffer[self.at : self.at + n])
        self.at += n
        return out


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzip stream."""
    source = Inflated(stream)
    while (header := source.until(b"\r\n\r\n")) is not None:
        fields = parse_header(header[:-4])
        block = source.exactly(int(fields["Content-Length"]))
        if source.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


class _NewFile:
    """A file that appears under its name when it is whole."""

    def __init__(self, path: str):
        self.system, self.path = fs.FileSystem.from_uri(path)
        folder, _, name = self.path.rpartition("/")
        self.passing = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.passing, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.passing, self.path)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every page as a response record and returns the catalog, a row per record, as a table."""
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_files, file, deflate, size, number, rows = TaskContext.get().partitionId(), 0, None, None, 0, 0, []
        for batch in batches:
            for part in slices(batch, "html"):
                payloads = pc.fill_null(part.column("html"), "").cast(pa.binary())
                for page_id, url, payload in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), payloads):
                    payload = payload.as_py()
                    if file is None:
                        name = f"{folder}/crawl-{task:06d}-{n_files:05d}.warc.gz"
                        file, deflate, size, number = _NewFile(name), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                        n_files += 1
                    record, digest = response_record(page_id, url, payload, date)
                    file.write(deflate.compress(record))
                    rows.append((name, number, page_id, url, len(payload), digest))
                    number += 1
                    size += len(record)
                    if size >= ARCHIVE_BYTES:
                        file.write(deflate.flush())
                        file.close()
                        file = None
                yield _batch(rows, CATALOG)
                rows = []
        if file is not None:
            file.write(deflate.flush())
            file.close()

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return materialize(rows.mapInArrow(run, CATALOG), "warc-catalog")


_TYPES = {"string": pa.string(), "bigint": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, names)], [name for name, _ in names]
    )


def find_revisits(catalog: DataFrame) -> DataFrame:
    """``archive``, ``number`` of each record that repeats a payload, and the response it refers to."""
    first = (
        catalog.where(F.col("payload_bytes") >= LEAST_BYTES)
        .groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("refers_url"), F.count("*").alias("n"))
        .where("n > 1 and refers_to is not null")
        .drop("n")
    )
    first = materialize(first, "warc-responses")
    return (
        catalog.join(first, ["digest", "payload_bytes"])
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("archive", "number", "refers_to", "refers_url")
    )


def normalise(catalog: DataFrame, revisits: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with a member per record and a sidecar index; a row per archive, as a table.

    ``path`` is the new file, ``path`` + ``.index`` its index: a JSON line for each
    record with offset, length, page id, type and digest.
    """
    own = revisits.groupBy("archive").agg(F.collect_list(F.struct("number", "refers_to", "refers_url")).alias("revisits"))
    archives = materialize(catalog.groupBy("archive").agg(F.count("*").alias("n")).join(own, "archive", "left"), "warc-work")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = {x["number"]: (x["refers_to"], x["refers_url"]) for x in row["revisits"] or ()}
                path = f"{folder}/{row['archive'].rpartition('/')[2].replace('crawl-', 'records-')}"
                n = _normalise(row["archive"], path, found)
                yield _batch([(path, n)], "path string, n_records bigint")

    return materialize(_apart(archives, "archive").mapInArrow(run, "path string, n_records bigint"), "warc-archives")


def _apart(rows: DataFrame, key: str) -> DataFrame:
    """Few rows that each stand for much work, in partitions of their own as far as hashing goes."""
    return rows.repartition(max(1, 2 * rows.count()), key)


def _normalise(source: str, target: str, revisits: dict[int, tuple[int, str | None]]) -> int:
    system, path = fs.FileSystem.from_uri(source)
    file, index, number = _NewFile(target), _NewFile(f"{target}.index"), -1
    with system.open_input_stream(path, compression=None) as stream:
        for number, (fields, block) in enumerate(records(stream)):
            if number in revisits:
                cut = block.index(b"\r\n\r\n") + 4
                record = revisit_record(fields, block[:cut], *revisits[number])
            else:
                record = _header(fields) + block + b"\r\n\r\n"
            deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = deflate.compress(record) + deflate.flush()
            entry = {
                "offset": file.size,
                "length": len(member),
                "page_id": _page_id(fields["WARC-Record-ID"]),
                "type": "revisit" if number in revisits else "response",
                "digest": fields["WARC-Payload-Digest"],
            }
            file.write(member)
            index.write(json.dumps(entry).encode() + b"\n")
    file.close()
    index.close()
    return number + 1


def read_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the record in one gzip member."""
    found = list(records(pa.BufferReader(member)))
    if len(found) != 1:
        raise ValueError(f"{len(found)} records in a member")
    return found[0]


def _read(path: str) -> Iterator[tuple]:
    system, own = fs.FileSystem.from_uri(path)
    with system.open_input_file(own) as file, system.open_input_stream(f"{own}.index", compression=None) as index:
        for line in _lines(index):
            entry = json.loads(line)
            fields, block = read_record(file.read_at(entry["length"], entry["offset"]))
            cut = block.index(b"\r\n\r\n") + 4
            digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            if fields["WARC-Type"] == "response":
                payload = block[cut:]
                n, refers = len(payload), None
                if hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"the payload of {fields['WARC-Record-ID']} has changed")
            else:
                n = int(block[:cut].rpartition(b"Content-Length: ")[2])
                refers = _page_id(fields["WARC-Refers-To"])
            url = fields["WARC-Target-URI"] or None
            yield (
                _page_id(fields["WARC-Record-ID"]), n, digest, fields["WARC-Type"], refers,
                url, path, entry["offset"], entry["length"],
            )


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(READ_BYTES):
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the normalised archives ``path``, read by their index; digests are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for row in _read(path):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(rows, RECORDS)
                        rows = []
                yield _batch(rows, RECORDS)

    return _apart(archives.select("path"), "path").mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes, normalises and reads back: a row per page, see ``RECORDS``."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    catalog = write_archives(pages, folder)
    return read_archives(normalise(catalog, find_revisits(catalog), folder))
