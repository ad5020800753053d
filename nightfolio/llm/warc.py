"""WARC archives in Zstandard frames that share a dictionary.

A dictionary is built from a sample of the records to come and stands, in a skippable
frame, at the head of every archive; each record follows as a frame of its own, so a reader
needs nothing but the archive and can start at any record. A payload that has been archived
under another page is a revisit record, which names the response and repeats its digest and
length but not its bytes.

Each task writes its archive under a name of its attempt and then moves it to its final
name, so that a task that is lost or runs twice leaves one whole archive. The dictionary is
fitted on at most ``SAMPLE_BYTES`` of records drawn by hash from all pages.

Defined results: a null payload is an empty one; payloads under ``MIN_REVISIT`` bytes are
always responses; of equal payloads all rows with the largest page id are responses, a null
id counting as smallest; a null url becomes ``urn:page:`` with the id; control characters
and spaces of a url are percent-encoded; repeated rows are archived each; other columns
are ignored. An empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import scratch_path, stored, uniform

MIN_REVISIT = 1000
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
#: The skippable frame that holds a dictionary. Fixed value.
DICTIONARY_FRAME = 0x184D2A5D
DATE = "2026-01-01T00:00:00Z"
_SPACE_ID = uuid.UUID("7f0e9d5c-3c55-5a0f-9a94-2f6b8f4f3f10")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_ID, f'{page_id}:{digest}')}>"


def target_uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    revisit: bool,
) -> bytes:
    """One WARC/1.1 record with its HTTP head; a revisit's has no body."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target_uri(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head.append(f"WARC-Profile: {_PROFILE}")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        head.append(f"X-Refers-To-Page-Id: {refers_to}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def classified(pages: DataFrame) -> DataFrame:
    """Each page with its payload's digest and whether it is a response or a revisit."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
    )
    keyed = rows.select(
        "page_id", F.sha2("html", 256).alias("key"), F.octet_length("html").alias("size")
    )
    shared = (
        keyed.filter(F.col("size") >= MIN_REVISIT)
        .groupBy("key")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "refers_to")
    )
    # Ids and keys meet first, so that the pages themselves move once, by id, evenly.
    revisits = (
        keyed.join(shared, "key")
        .filter("refers_to is not null and (page_id is null or page_id < refers_to)")
        .select(F.col("page_id").alias("id"), F.col("key").alias("same"), "refers_to")
        .distinct()
    )
    return (
        rows.withColumn("key", F.sha2("html", 256))
        .join(
            revisits,
            F.col("page_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("same")),
            "left",
        )
        .select("page_id", "url", "html", F.sha1("html").alias("digest"), "refers_to")
    )


def sample_dictionary(pages: DataFrame) -> bytes:
    """A dictionary of records, or none where they are too few to learn from.

    ``pages`` is sampled as it lies, before anything is joined or moved.
    """
    import zstandard

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1("html"))
    size = rows.agg(F.sum(F.octet_length("html") + 400).alias("n")).first()["n"] or 0
    rate = min(1.0, SAMPLE_BYTES / size) if size else 0.0
    chosen = rows.filter(uniform("page_id", "digest") < rate).select(
        "page_id", "url", F.substring("html", 1, 1 << 16).alias("html"), "digest"
    )
    samples, total = [], 0
    for r in sorted(chosen.collect(), key=lambda r: (r["page_id"] or 0, r["digest"])):
        samples.append(record(r["page_id"], r["url"], r["html"].encode(), r["digest"], None, False))
        total += len(samples[-1])
    if len(samples) < 16:
        return b""
    size = min(DICTIONARY_BYTES, max(1024, total // 10))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # the records have too little in common
        return b""


def _frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


_MANIFEST = "path string, records long, bytes long"


def _writer(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        system, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"{root}/pages-{task.partitionId():06d}.warc.zst"
        attempt = f"{name}.{task.taskAttemptId()}.tmp"
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)
        records = written = 0
        out = None
        for batch in batches:
            for page, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(attempt, compression=None)
                    written += out.write(_frame(dictionary))
                payload = html.encode("utf-8", "surrogatepass")
                whole = record(page, url, payload, digest, refers_to, refers_to is not None)
                written += out.write(press.compress(whole))
                records += 1
        if out is None:
            return
        out.close()
        system.move(attempt, name)
        yield pa.record_batch(
            [pa.array([name]), pa.array([records]), pa.array([written])], ["path", "records", "bytes"]
        )

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives below ``folder``, a URI; a row for each archive."""
    dictionary = sample_dictionary(pages)
    return stored(classified(pages).mapInArrow(_writer(folder, dictionary), _MANIFEST), "manifest")


class _Head(dict):
    def __missing__(self, key):
        return None


def parsed(whole: bytes) -> tuple[_Head, _Head, bytes]:
    """The heads and the payload of a record."""
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = _Head(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = _Head(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields, http_fields, payload


def records_of(stream) -> Iterator[bytes]:
    """The records of an archive, one frame after the other."""
    import zstandard

    mark, size = struct.unpack("<II", stream.read(8))
    if mark != DICTIONARY_FRAME:
        raise ValueError("the archive has no dictionary frame")
    dictionary = stream.read(size)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    reader = zstandard.ZstdDecompressor(dict_data=data)
    pending = b""
    while True:
        if not pending:
            pending = stream.read(1 << 20)
            if not pending:
                return
        unit, parts = reader.decompressobj(), io.BytesIO()
        while not unit.eof:
            if not pending:
                pending = stream.read(1 << 20)
                if not pending:
                    raise ValueError("an archive ends within a record")
            parts.write(unit.decompress(pending))
            pending = unit.unused_data
        yield parts.getvalue()


_PAGE = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload binary"
)


def _reader(folder: str, with_payload: bool):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _PAGE.split(", ")]

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with system.open_input_stream(path, compression=None) as stream:
                    for whole in records_of(stream):
                        head, http, payload = parsed(whole)
                        kind = head["WARC-Type"]
                        size, digest = int(http["Content-Length"]), head["WARC-Payload-Digest"][5:]
                        if kind == "response" and (
                            len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
                        ):
                            raise ValueError(f"a payload of {path} is damaged")
                        rows.append(
                            (
                                number(head["X-Page-Id"]), size, digest, kind,
                                number(head["X-Refers-To-Page-Id"]), head["WARC-Target-URI"],
                                payload if with_payload and kind == "response" else None,
                            )
                        )
                        if len(rows) >= 2000:
                            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``manifest`` names; payloads are checked.

    As many tasks as archives: their number is given, or the few bytes of the names would be
    brought together in one.
    """
    paths = manifest.select("path")
    paths = paths.repartition(max(1, paths.count()), "path")
    return paths.mapInArrow(_reader(folder, with_payload), _PAGE)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder, with_payload=False).drop("payload", "url")
