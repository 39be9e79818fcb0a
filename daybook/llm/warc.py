"""WARC archives of pages, compressed with a dictionary of their own (.warc.zst), and their reader.

Each archive begins with its Zstandard dictionary in a skippable frame; every record is then a frame of its own,
compressed with that dictionary, so that a reader can start at any record. The dictionary is built from the records
themselves: distinct payloads are drawn by hash over the whole table, as many as give about `dictionary_from` bytes (100
times the dictionary's size, which is what training can use; this bound is the parameter), one task trains on them, and
all archives of the run carry the result. Records too few or too small to train on make archives without a dictionary.

Of equal payloads of at least `smallest` bytes that of the largest page id is the response; the others become revisit
records, without payload. Payloads are compared by SHA-1 and size: only digests are shuffled, aggregated on the map
side first. The list of repeated ones is broadcast where a count proves it small; otherwise only payloads that a filter
says may be listed are shuffled (listed.py).

Archives are written in the shared folder under names that hold the task's attempt, and moved there only when whole;
the manifest lists those of the attempts that succeeded, so a lost executor or a speculative task leaves nothing that a
reader would see. The folder is named as Hadoop names it, so that Spark and the writers mean the same one; a store that
pyarrow can't open is refused with an error.

Defined cases: null html is the empty payload; a null page id has no id header, is never referred to, and is a
response where all equal payloads have null ids; rows with the id of the response are responses too; a null url
becomes urn:page:<id>; line breaks in urls are escaped; empty tables give no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import urllib.parse
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches
from daybook.llm.listed import joined
from daybook.scratch import Scratch, qualified

#: The skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 1 << 16
DICTIONARY_FROM = 100 * DICTIONARY_BYTES
ARCHIVE_BYTES = 1 << 29
LEVEL = 3
BROADCAST_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"


def _page(page_id) -> str:
    return f"page:{page_id}"


def _assemble(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, refers_to, number: str) -> bytes:
    """One response or (refers_to given) revisit record; size and digest are of the full payload."""
    name = _page(page_id) if refers_to is None and page_id is not None else number
    uri = urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:{_page(page_id)}"
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(name)), ("WARC-Date", DATE),
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", urllib.parse.quote(str(page_id))))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(_page(refers_to))),
            ("X-Refers-To-Page-Id", urllib.parse.quote(str(refers_to))),
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _assemble(headers, http + (payload or b"" if refers_to is None else b""))


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary from some records, or None if they are too few."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, records)) // 8)), records).as_bytes()
    except zstandard.ZstdError:
        return None


#: Schemes under which pyarrow knows the stores that Hadoop calls so.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store(root: str):
    """The pyarrow file system of a folder as Hadoop names it, and the path there."""
    from pyarrow import fs

    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    except pa.ArrowException as error:
        raise ValueError(f"archives can't be written to or read from {root}: {error}") from error


class ArchiveWriter:
    """Writes archives of one task; holds one record at a time."""

    def __init__(self, root: str, stem: str, dictionary: bytes | None, archive_bytes: int = ARCHIVE_BYTES):
        self.files, self.root = store(root)
        self.stem, self.dictionary, self.archive_bytes = stem, dictionary, archive_bytes
        data = zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_FULLDICT) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)
        self.done: list[tuple[str, int, int]] = []
        self.out = None

    def add(self, record: bytes) -> None:
        if self.out is None:
            self._open()
        self.records += 1
        self._compress(record)
        if self.written >= self.archive_bytes:
            self.close()

    def _open(self) -> None:
        self.name, self.records, self.written = f"{self.stem}-{len(self.done):04d}.warc.zst", 0, 0
        self.files.create_dir(self.root, recursive=True)
        self.out = self.files.open_output_stream(posixpath.join(self.root, f".{self.name}.part"), compression=None)
        if self.dictionary:
            self._write(struct.pack("<II", DICTIONARY_MAGIC, len(self.dictionary)) + self.dictionary)
        about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(self.name)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
        self._compress(_assemble(about, b"format: WARC File Format 1.1\r\n"))

    def _write(self, frame: bytes) -> None:
        self.out.write(frame)
        self.written += len(frame)

    def _compress(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.move(posixpath.join(self.root, f".{self.name}.part"), posixpath.join(self.root, self.name))
            self.done.append((self.name, self.records, self.written))
            self.out = None


def read_records(stream):
    """(headers, block) of every record of an open archive, whole or from its start."""
    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_MAGIC:
        data = stream.read(struct.unpack("<II", head)[1])
        if data[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        dictionary, head = zstandard.ZstdCompressionDict(data, zstandard.DICT_TYPE_FULLDICT), b""
    plain = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(_After(head, stream), read_across_frames=True)
    buffer = b""

    def fill(n: int) -> bool:
        nonlocal buffer
        parts, have = [buffer], len(buffer)
        while have < n and (more := plain.read(max(1 << 18, n - have))):
            parts.append(more)
            have += len(more)
        buffer = b"".join(parts)
        return have >= n

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("an archive ends inside a record")
        version, *lines = buffer[:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        if not fill(end + 8 + size):
            raise ValueError("an archive ends inside a record")
        yield headers, buffer[end + 4 : end + 4 + size]
        buffer = buffer[end + 8 + size :]


class _After:
    """A stream with some bytes put back before it."""

    def __init__(self, head: bytes, stream):
        self.head, self.stream = head, stream

    def read(self, n: int = -1) -> bytes:
        if self.head:
            out, self.head = self.head, b""
            return out
        return self.stream.read(n)


def _record_of(row: tuple, number: str) -> bytes:
    page_id, url, payload, sha1, size, refers_to = row
    return record(page_id, url, payload, size, base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to, number)


def dictionary_of(rows: DataFrame, digests: DataFrame, dictionary_from: int, size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary trained on about `dictionary_from` bytes of the records; rows as written, digests: their page_id, sha1, size."""
    distinct = digests.groupBy("sha1", "size").agg(F.max("page_id").alias("page_id")).where("page_id is not null")
    # With its headers a record has some hundred bytes more.
    total = distinct.agg(F.sum(F.col("size") + 500)).first()[0] or 0
    drawn = F.pmod(F.xxhash64("sha1"), F.lit(1 << 40)) / float(1 << 40)
    picked = distinct.where(drawn < min(1.0, dictionary_from / max(total, 1))).select("page_id", "sha1")

    def run(batches):
        records, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # What was drawn is about so many bytes, but for the chance of the draw.
                if held < 2 * dictionary_from:
                    records.append(_record_of(row, ""))
                    held += len(records[-1])
        yield pa.RecordBatch.from_arrays([pa.array([train(records, size)], pa.binary())], names=["dictionary"])

    # Repeated rows go before the shuffle, so that one task gets the drawn records once each.
    sample = rows.join(F.broadcast(picked), ["page_id", "sha1"]).dropDuplicates(["page_id", "sha1"]).repartition(1).sortWithinPartitions("page_id", "sha1")
    found = sample.select("page_id", "url", "payload", "sha1", "size", F.lit(None).cast(sample.schema["page_id"].dataType)).mapInArrow(run, "dictionary binary").collect()
    return bytes(found[0][0]) if found and found[0][0] else None


def write_archives(
    pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smallest: int = 0,
    dictionary_from: int = DICTIONARY_FROM, archive_bytes: int = ARCHIVE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Write all pages below root; returns the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    scratch, root = Scratch(spark, "warc"), qualified(spark, root)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    digests = scratch.save(rows.select("page_id", "sha1", "size"), "digests")
    repeated = digests.where(F.col("size") >= smallest).groupBy("sha1", "size").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
    repeated = scratch.save(repeated.where("n > 1").select("sha1", "size", "holder"), "repeated")

    with bounded_batches(spark):
        dictionary = dictionary_of(rows, digests, dictionary_from, dictionary_bytes)

        def run(batches):
            task = TaskContext.get()
            stem = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}"
            writer, n = ArchiveWriter(root, stem, dictionary, archive_bytes), 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    writer.add(_record_of(row, f"{stem}:{n}"))
                    n += 1
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"archive": a, "records": r, "bytes": b} for a, r, b in writer.done],
                schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

        refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
        rows = joined(rows, repeated, ["sha1", "size"], "left", BROADCAST_ROWS)
        rows = rows.select("page_id", "url", F.when(refers_to.isNull(), F.col("payload")).alias("payload"), "sha1", "size", refers_to.alias("refers_to"))
        return scratch.result(rows.mapInArrow(run, "archive string, records long, bytes long"), "manifest")


RECORD_SCHEMA = "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"


def read_archives(manifest: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The pages of the listed archives, one row per record; revisits have no payload. Digests are checked."""
    archives, root = manifest.count(), qualified(manifest.sparkSession, root)

    def run(batches):
        files, base = store(root)
        schema = pa.schema(
            [("page_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
        )
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(posixpath.join(base, name), compression=None) as stream:
                    for headers, block in read_records(stream):
                        kind = headers["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        digest = headers["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"{name}: the payload of {headers['WARC-Record-ID']} is damaged")
                        ids = [urllib.parse.unquote(x) if (x := headers.get(k)) is not None else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                        rows.append((ids[0], headers["WARC-Target-URI"], payload if payloads and kind == "response" else None, size, digest, kind, ids[1]))
                        held += len(payload) if payloads else 100
                        if held > 1 << 22:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                yield _batch(rows, schema)

    return manifest.select("archive").repartition(max(1, min(archives, 10_000))).mapInArrow(run, RECORD_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", smallest: int = 0) -> DataFrame:
    """Write all pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    scratch = Scratch(pages.sparkSession, "warc-archives")
    root = scratch.path("archives")
    manifest = write_archives(pages, root, id_col, smallest=smallest)
    kind = pages.select(id_col).schema[0].dataType
    back = read_archives(manifest, root, payloads=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
    return scratch.result(back)
