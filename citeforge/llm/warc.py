"""WARC archives in Zstandard, one frame per record, with the dictionary in the leading skippable frame.

Writing: a bounded sample of payloads trains the dictionary (``SAMPLE`` payloads of ``SAMPLE_BYTES`` at most);
each task writes archives of about ``ARCHIVE_BYTES`` into the shared folder under names of its own, and the
list of archives is committed as a Parquet table, so files of tasks that failed or ran twice are never read.
Reading: load the dictionary from the skippable frame (magic 0x184D2A5D), walk the frames, decode one at a
time, and validate version line, lengths, digests and that a frame holds one record and nothing else.

Payloads that are equal and have at least ``MIN_REVISIT`` bytes are stored once: the smallest page_id is the
response, the others are revisits that refer to it and carry no payload. Every record has a WARC-Record-ID of its own
and the WARC-Date of the run; page ids, which may be null or repeat, are extension fields (WARC-Page-ID, and
WARC-Refers-To-Page-ID in revisits), as is a URL that no header line can hold (in base64, WARC-Target-URI-Base64).
Null html is an empty payload; rows without page_id or url are written without one. Repeated rows (the same page_id) that
hold the smallest id are all responses. An empty table makes no archive and no row.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, small_batches, staged

MAGIC = 0x184D2A5D
SAMPLE, SAMPLE_BYTES, DICT_BYTES, ARCHIVE_BYTES, MIN_REVISIT, LEVEL = 200, 16_384, 32_768, 16 << 20, 100, 3
FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class BadArchive(ValueError):
    pass


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow's file systems reach: file:, hdfs:, s3:, gs:."""
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record."""
    block = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        plain = url and not re.search(r"[\x00-\x20\x7f<>]", url)
        head.append(f"WARC-Target-URI: {url}" if plain else "WARC-Target-URI-Base64: " + base64.b64encode(url.encode("utf-8", "surrogatepass")).decode())
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields and the payload of one record; BadArchive if it is not exactly one sound record."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise BadArchive("no WARC/1.1 header")
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(": ")
        if not colon or k in fields:
            raise BadArchive(f"header line {line[:60]!r}")
        fields[k] = v
    try:
        size, whole, kind = int(fields["Content-Length"]), int(fields["WARC-Payload-Length"]), fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        uuid.UUID(fields["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">"))
        dt.datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")
        page, refers_to = (int(fields[k]) if k in fields else None for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID"))
    except (KeyError, ValueError) as e:
        raise BadArchive(f"header field: {e}") from e
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length is {size}, the block has {len(rest) - 4}")
    payload = rest[:size]
    if kind == "response":
        if size != whole or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive("payload does not match its digest")
    elif kind != "revisit" or size or refers_to is None:
        raise BadArchive(f"record of type {kind}")
    url = fields.get("WARC-Target-URI")
    if url is None and "WARC-Target-URI-Base64" in fields:
        url = base64.b64decode(fields["WARC-Target-URI-Base64"]).decode("utf-8", "surrogatepass")
    return {"page_id": page, "url": url, "payload_bytes": whole, "payload_digest": digest, "record_type": kind, "refers_to": refers_to if kind == "revisit" else None, "payload": payload}


class Writer:
    """Appends records to one archive."""

    def __init__(self, sink, dictionary: bytes):
        self.sink, self.size, self.records = sink, 0, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True, write_checksum=True)
        self._put(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)

    def _put(self, raw: bytes) -> None:
        self.sink.write(raw)
        self.size += len(raw)

    def add(self, raw: bytes) -> None:
        self._put(self.packer.compress(raw))
        self.records += 1


def read_archive(source, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one decoded frame at a time; a frame cut short is an error."""
    head = source.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != MAGIC:
        raise BadArchive("no leading dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    raw = source.read(size)
    if len(raw) != size:
        raise BadArchive("the dictionary is cut short")
    if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    rest = b""
    while True:
        if not rest and not (rest := source.read(piece)):
            return
        frame, out = unpacker.decompressobj(), io.BytesIO()
        while True:
            try:
                out.write(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise BadArchive(f"frame: {e}") from e
            if frame.eof:
                rest = frame.unused_data
                break
            if not (rest := source.read(piece)):
                raise BadArchive("a frame is cut short")
        yield out.getvalue()


def train(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample: the payloads with the least hashes, cut to SAMPLE_BYTES each. Empty if there is too little to learn from.

    Hashes alone are ranked first, so no more than the sample itself ever leaves the tasks.
    """
    hashed = pages.where(F.octet_length("html") > 0).select(F.xxhash64("html").alias("k"), "html")
    least = [r["k"] for r in hashed.select("k").distinct().orderBy("k").limit(SAMPLE).collect()]
    if len(least) < 8:
        return b""
    rows = hashed.where(F.col("k") <= least[-1]).groupBy("k").agg(F.min(F.substring("html", 1, SAMPLE_BYTES)).alias("h")).orderBy("k").collect()
    samples = [r["h"].encode("utf-8", "surrogatepass") for r in rows]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to (the response's page_id, for revisits)."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256).alias("digest"), F.octet_length(F.coalesce(F.col("html"), F.lit(""))).alias("n"))
    # a short row for each page with a payload that may repeat; a hot payload is reduced before the shuffle
    firsts = staged(plain.where((F.col("n") >= MIN_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("response"), F.max("page_id").alias("last")).where("last > response").select("digest", "response"), "warc-repeats")
    # short payloads find no partner; each has a key of its own, so that the empty ones do not meet
    key = F.when(F.col("n") >= MIN_REVISIT, F.col("digest")).otherwise(F.concat_ws("-", F.monotonically_increasing_id().cast("string"), F.lit("short")))
    joined = plain.withColumn("key", key).join(firsts.withColumnRenamed("digest", "key"), "key", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(F.col("response") < F.col("page_id"), F.col("response")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, date: str | None = None) -> DataFrame:
    """Writes pages(page_id, url, html) as archives; the committed list of them: path, records, bytes. ``date``: WARC-Date, now if not given."""
    spark = pages.sparkSession
    small_batches(spark)
    folder, date = folder or new_path(spark, "warc"), date or now()
    dictionary = spark.sparkContext.broadcast(train(pages))  # DICT_BYTES at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        done, at, out, w = [], None, None, None
        for b in batches:
            for page, url, html, digest, refers in zip(b["page_id"], b["url"], b["html"], b["digest"], b["refers_to"]):
                if w is None or w.size >= ARCHIVE_BYTES:
                    if w is not None:
                        out.close()
                        done.append((at, w.records, w.size))
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    at, out = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
                    w = Writer(out, dictionary.value)
                revisit = not pd.isna(refers)
                payload = b"" if html is None else html.encode("utf-8", "surrogatepass")
                w.add(record(None if pd.isna(page) else int(page), url, payload, digest, "revisit" if revisit else "response", int(refers) if revisit else None, date))
        if w is not None:
            out.close()
            done.append((at, w.records, w.size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    return staged(with_revisits(pages).mapInPandas(run, "path string, records long, bytes long"), "warc-list")


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the listed archives, an archive per row of work; payloads only on demand."""
    small_batches(archives.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, records in zip(b["path"], b["records"]):
                store, at = _open(path)
                rows, held, n = [], 0, 0
                with store.open_input_stream(at, compression=None) as source:
                    for raw in read_archive(source):
                        r = parse(raw)
                        if not payloads:
                            del r["payload"]
                        rows.append(r)
                        n, held = n + 1, held + (len(raw) if payloads else 200)
                        if held > 4 << 20:
                            yield pd.DataFrame(rows).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows, held = [], 0
                if n != records:
                    raise BadArchive(f"{path} has {n} records, {records} were committed")
                if rows:
                    yield pd.DataFrame(rows).astype({"page_id": "Int64", "refers_to": "Int64"})

    spread = archives.repartition(archives.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInPandas(run, FIELDS + (", payload binary" if payloads else ""))
