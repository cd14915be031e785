"""WARC archives with a Zstandard dictionary: written by tasks, read back by tasks.

A dictionary is trained on a bounded sample of the records. Every archive begins with a
skippable frame that holds it, and every record is a frame of its own, so an archive can
be read alone, and a record from its offset. Equal payloads are stored once: the others
revisit the record that holds them.
"""

from __future__ import annotations

import io
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import stored, stored_count
from leafmill.llm.tokens import python_ready
from leafmill.session import scratch_path

# The frame type of a dictionary in a Zstandard WARC file, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1000
# The dictionary is trained on at most so many records, and of each on a piece of at most so many bytes.
SAMPLE_RECORDS, SAMPLE_BYTES = 2000, 1 << 16
DICTIONARY_BYTES = 110 << 10
# Uncompressed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """A WARC record: a response with its payload, or a revisit of the response that holds it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url:
        address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {address}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an uncompressed stream, one at a time."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        head = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, block


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI that does not depend on a default file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def _dictionary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    samples = [
        record(None if pd.isna(p) else int(p), u, b, d, len(b), None)
        for rows in batches
        for p, u, b, d in zip(rows["page_id"], rows["url"], rows["payload"], rows["digest"], strict=True)
    ]
    try:
        made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        # Too few samples to train on: what they hold is the dictionary.
        made = b"".join(samples)[-DICTIONARY_BYTES:]
    yield pd.DataFrame({"dictionary": [made]})


def _piece() -> Column:
    """A piece of a payload, from a place anywhere in it that the digest decides; short payloads are whole."""
    places = F.greatest(F.octet_length("payload") - SAMPLE_BYTES + 1, F.lit(1))
    start = (F.pmod(F.xxhash64(F.lit("piece"), "digest"), places) + 1).cast("int")
    return F.substring("payload", start, F.lit(SAMPLE_BYTES))


def train_dictionary(rows: DataFrame) -> bytes:
    """A dictionary from a bounded sample, the records with the least hashes of digest and id.

    Hashes alone are ranked; payloads are then read below the last one's, so that a task
    never meets more of them than the sample holds.
    """
    rank = F.xxhash64("digest", "page_id")
    last = rows.select(rank.alias("rank")).orderBy("rank").limit(SAMPLE_RECORDS).agg(F.max("rank")).first()[0]
    if last is None:
        return b""
    sample = rows.filter(rank <= last).select("page_id", "url", _piece().alias("payload"), "digest").limit(SAMPLE_RECORDS)
    made = sample.coalesce(1).mapInPandas(_dictionary, "dictionary binary").first()
    return bytes(made[0]) if made else b""


def _usable(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None


def _writer(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _store(folder)
        usable = _usable(dictionary)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=usable, write_checksum=True)
        out, name, size, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records]}, pa.schema([("archive", pa.string()), ("records", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
                if out is None:
                    # A name of its own for every attempt: only what a finished task lists is read.
                    name, size, records = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = store.open_output_stream(f"{at}/{name}", compression=None)
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                one = record(row["page_id"], row["url"], row["payload"] or b"", row["digest"], row["payload_bytes"], row["refers_to"])
                out.write(squeeze.compress(one))
                size, records = size + len(one), records + 1
        if out is not None:
            yield closed()

    return run


def open_archive(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, with the dictionary that leads it."""
    store, at = _store(uri)
    with store.open_input_stream(at, compression=None) as file:
        magic, length = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{uri} does not begin with a dictionary")
        squeeze = zstandard.ZstdDecompressor(dict_data=_usable(file.read(length)))
        with squeeze.stream_reader(file, read_across_frames=True, closefd=False) as plain:
            yield from read_records(io.BufferedReader(plain, 1 << 20))


_ANSWER = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for row in batch.to_pylist():
            rows, seen = [], 0
            for head, block in open_archive(row["archive"]):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                if head["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{row['archive']}: a payload is not what its header says")
                rows.append((_page_of(head["warc-record-id"]), size, digest, head["warc-type"], _page_of(head.get("warc-refers-to"))))
                seen += 1
                if len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(_ANSWER.names, r, strict=True)) for r in rows], _ANSWER)
                    rows = []
            if seen != row["records"]:
                raise ValueError(f"{row['archive']} holds {seen} records of {row['records']}")
            yield pa.RecordBatch.from_pylist([dict(zip(_ANSWER.names, r, strict=True)) for r in rows], _ANSWER)


def with_revisits(pages: DataFrame, html: Column | None = None) -> DataFrame:
    """page_id, url, payload, digest, payload_bytes and `refers_to`: the page whose record holds the same payload."""
    body = F.coalesce(html if html is not None else F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    large = rows.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES).select("digest", "payload_bytes", "page_id")
    many = large.groupBy(F.col("digest").alias("d"), F.col("payload_bytes").alias("n")).agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("k"))
    holders = stored(many.filter("k > 1").drop("k"), "warc-holders")
    found = rows.join(holders, (F.col("digest") == F.col("d")) & (F.col("payload_bytes") == F.col("n")), "left")
    other = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return found.select("page_id", "url", "digest", "payload_bytes", F.when(other, F.col("holder")).alias("refers_to"), F.when(~other, F.col("payload")).alias("payload"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record into archives in a folder; one row per archive: its URI and number of records.

    The folder is one that driver and executors share. A task that is run again writes
    new archives; those of the attempt that was lost are not listed.
    """
    spark = pages.sparkSession
    python_ready(spark)
    home = _qualified(spark, folder)
    store, at = _store(home)
    store.create_dir(at, recursive=True)
    rows = with_revisits(pages)
    dictionary = train_dictionary(rows.filter("refers_to is null"))
    return stored(rows.mapInArrow(_writer(home, dictionary), "archive string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record in the listed archives."""
    python_ready(manifest.sparkSession)
    return manifest.repartition(max(1, stored_count(manifest))).mapInArrow(_reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame) -> DataFrame:
    """The pages written to archives in the shared folder and read back, one row per page.

    Of equal payloads of at least 1000 bytes the record with the largest page_id is the
    response and the others revisit it. `pages` needs page_id, url and html; other
    columns are left aside. Null and empty html is an empty response; a null url is left
    out of the record; a null page_id has no number in the record and reads back as null;
    repeated rows are records of their own (several responses if they hold the largest
    id); no rows give no archive and no rows.
    """
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc")))
