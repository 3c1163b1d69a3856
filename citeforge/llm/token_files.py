"""Token ids in files of directly addressable codes: any token of any document is read without decoding a block.

Ids are split into chunks of bits, the lowest first. Level 1 has the first chunk of every id, level k + 1 the next chunk of
those ids that go on, in the same order; each level but the last has a bitmap of which ids go on and a directory of how many
do before every 512th one. Token i is chunk i of level 1 and, if bit i is set, token rank(i) of the rest: a few reads of
known places. The widths of the chunks (4, 8, 16 or 32 bits) are chosen for each file, the least bits in total.

Documents are dealt by ranges of (doc_id, hash of the text, row), null ids first, each range is encoded where it lies, and
written as files of FILE_TOKENS ids at most, or of one document. The list of files is committed as a Parquet table, with
the number of tokens before each; files of tasks that failed or ran twice are in no list. Every file carries a checksum
of its sections, and its directory of documents: id and first token.

Null text is an empty document: the end id alone. Documents of any length are encoded whole. Rows that share a doc_id lie
side by side, ordered by a hash of their text; repeated rows are written as often as they occur. An empty table makes no file
and no row. Further columns are ignored. The vocabulary's path, the end id and whether strings of special tokens in a text
become those tokens (the library's default) are parameters.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoders
from .common import new_path, small_batches, staged
from .mixing import running
from .warc import _open

MAGIC, VERSION, BLOCK = b"DACTOKEN", 1, 512
FILE_TOKENS, END = 8 << 20, 0
#: Stretches of text that a worker keeps with their ids.
KEPT = 800_000


class BadFile(ValueError):
    pass


def widths_of(ids: np.ndarray) -> list[int]:
    """Chunk widths (4, 8, 16 or 32 bits) with the least bits in total: what is left after each possible cut is counted, then cuts are chosen from the end."""
    top = -(-max(1, int(ids.max()).bit_length() if len(ids) else 1) // 4) * 4
    longer = {b: int(np.count_nonzero(ids >= np.uint32(1 << b))) if b else len(ids) for b in range(0, top, 4)}  # ids with more than b bits
    best: dict[int, tuple[float, list[int]]] = {top: (0.0, [])}
    for b in range(top - 4, -1, -4):
        fits = [w for w in (4, 8, 16, 32) if b + w <= top] + [w for w in (8, 16, 32) if b + w > top][:1]
        best[b] = min((longer[b] * (w + (b + w < top) * (1 + 32 / BLOCK)) + best[min(top, b + w)][0], [w, *best[min(top, b + w)][1]]) for w in fits)
    return best[0][1]


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits one after another, the lowest bit first."""
    if width > 4:
        return values.astype(f"<u{width // 8}").tobytes()
    half = np.append(values, 0).astype(np.uint8) if len(values) % 2 else values.astype(np.uint8)
    return (half[::2] | half[1::2] << 4).tobytes()


def unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    if width > 4:
        return np.frombuffer(raw, f"<u{width // 8}", n).astype(np.uint32)
    data = np.frombuffer(raw, np.uint8)
    return np.stack((data & 15, data >> 4), axis=1).ravel()[:n].astype(np.uint32)


def _sections(ids: np.ndarray, widths: list[int]) -> list[bytes]:
    """For each level its chunks and, but for the last, bitmap and directory."""
    out, rest = [], ids
    for k, w in enumerate(widths):
        out.append(pack(rest & np.uint32((1 << w) - 1), w))
        if k + 1 == len(widths):
            break
        rest = rest >> np.uint32(w)
        on = rest > 0
        bits = np.packbits(on, bitorder="little")
        per = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.int64) if len(on) else np.empty(0, np.int64)
        out += [bits.tobytes(), (np.cumsum(per) - per).astype("<u4").tobytes()]
        rest = rest[on]
    return out


def dump(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """A file of documents (id, token ids) in their order."""
    ids = np.concatenate([d[1] for d in docs]).astype(np.uint32) if docs else np.empty(0, np.uint32)
    widths = widths_of(ids)
    names = np.array([0 if d[0] is None else d[0] for d in docs], "<i8").tobytes()
    known = np.packbits(np.array([d[0] is not None for d in docs], bool), bitorder="little").tobytes()
    starts = np.concatenate(([0], np.cumsum([len(d[1]) for d in docs]))).astype("<i8").tobytes()
    parts = [bytes(widths), names, known, starts, *_sections(ids, widths)]
    head = MAGIC + struct.pack("<IIQQ", VERSION, len(parts), len(docs), len(ids))
    head += struct.pack(f"<{len(parts)}Q", *map(len, parts)) + struct.pack(f"<{len(parts)}I", *map(zlib.crc32, parts))
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(parts)


class Reader:
    """A file of token ids. ``source``: anything with seek() and read(); only what is asked for is read."""

    def __init__(self, source):
        self.source = source
        head = self._at(0, 32)
        if len(head) < 32 or head[:8] != MAGIC:
            raise BadFile("no token file")
        version, n, self.n_docs, self.n_tokens = struct.unpack("<IIQQ", head[8:])
        if version != VERSION or not 5 <= n <= 200:
            raise BadFile(f"version {version} with {n} sections")
        rest = self._at(32, 12 * n + 4)
        if len(rest) < 12 * n + 4 or zlib.crc32(head + rest[:-4]) != struct.unpack("<I", rest[-4:])[0]:
            raise BadFile("the header is damaged")
        self.sizes = struct.unpack(f"<{n}Q", rest[: 8 * n])
        self.checks = struct.unpack(f"<{n}I", rest[8 * n : 12 * n])
        self.places = np.concatenate(([0], np.cumsum(self.sizes)))[:-1] + 36 + 12 * n
        self.widths = list(self._section(0))

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def _section(self, k: int) -> bytes:
        """A whole section, checked."""
        raw = self._at(int(self.places[k]), self.sizes[k])
        if len(raw) != self.sizes[k] or zlib.crc32(raw) != self.checks[k]:
            raise BadFile(f"section {k} is damaged")
        return raw

    def _some(self, k: int, begin: int, end: int) -> bytes:
        return self._at(int(self.places[k]) + begin, min(end, self.sizes[k]) - begin)

    def token(self, i: int) -> int:
        """Token i of the file: for each level a chunk, a bit and a part of the bitmap of one block at most."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for level, w in enumerate(self.widths):
            k = 4 + 3 * level
            first = i * w // 8
            raw = int.from_bytes(self._some(k, first, (i * w + w + 7) // 8), "little")
            value |= ((raw >> (i * w - 8 * first)) & ((1 << w) - 1)) << shift
            shift += w
            if level + 1 == len(self.widths):
                break
            block = i // BLOCK
            bits = int.from_bytes(self._some(k + 1, block * BLOCK // 8, i // 8 + 1), "little")
            if not bits >> (i % BLOCK) & 1:
                break
            before = struct.unpack("<I", self._some(k + 2, 4 * block, 4 * block + 4))[0]
            i = before + (bits & ((1 << (i % BLOCK)) - 1)).bit_count()
        return value

    def document(self, nth: int) -> tuple[int | None, int, int]:
        """(id, first token, end) of the nth document of the file."""
        if not 0 <= nth < self.n_docs:
            raise IndexError(nth)
        name = struct.unpack("<q", self._some(1, 8 * nth, 8 * nth + 8))[0]
        known = self._some(2, nth // 8, nth // 8 + 1)[0] >> nth % 8 & 1
        return (name if known else None, *struct.unpack("<qq", self._some(3, 8 * nth, 8 * nth + 16)))

    def all(self) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """(ids of documents, their starts and the end, all tokens); every section is checked."""
        names = np.frombuffer(self._section(1), "<i8").tolist()
        known = np.unpackbits(np.frombuffer(self._section(2), np.uint8), count=self.n_docs, bitorder="little").tolist()
        starts = np.frombuffer(self._section(3), "<i8")
        tokens, where, shift = np.zeros(self.n_tokens, np.uint32), None, 0
        n = self.n_tokens
        for level, w in enumerate(self.widths):
            k = 4 + 3 * level
            chunk = unpack(self._section(k), w, n) << np.uint32(shift)
            if where is None:
                tokens = chunk
            else:
                tokens[where] |= chunk
            shift += w
            if level + 1 < len(self.widths):
                on = np.flatnonzero(np.unpackbits(np.frombuffer(self._section(k + 1), np.uint8), count=n, bitorder="little"))
                directory = np.frombuffer(self._section(k + 2), "<u4")
                if len(directory) != -(-n // BLOCK) or not np.array_equal(directory, np.searchsorted(on, np.arange(len(directory)) * BLOCK)):
                    raise BadFile("a directory does not fit its bitmap")
                where = on if where is None else where[on]
                n = len(on)
        return [a if b else None for a, b in zip(names, known)], starts, tokens


FILES = "path string, first struct<doc_id: bigint, h: bigint, row: bigint>, n_docs bigint, n_tokens bigint"


def write(docs: DataFrame, folder: str | None = None, vocabulary: str = encoders.BYTE_LEVEL, end: int = END, special: bool = True, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes docs(doc_id, text) as token files; the committed list of them: path, n_docs, n_tokens, start (tokens in files before)."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or new_path(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "text")
    order = ["doc_id", "h", "row"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        encoder = encoders.byte_level(vocabulary, False, special, KEPT)
        held: list[tuple[int | None, np.ndarray]] = []
        size, first = 0, None

        def put() -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(dump(held))
            return pd.DataFrame([(f"{folder}/{name}", first, len(held), size)], columns=["path", "first", "n_docs", "n_tokens"])

        for b in batches:
            ids, counts, _ = encoder.encode(["" if t is None else t for t in b["text"]])
            ids, bounds = np.insert(ids, np.cumsum(counts), end), np.concatenate(([0], np.cumsum(counts + 1)))
            for i, (doc, h, row) in enumerate(zip(b["doc_id"], b["h"], b["row"])):
                tokens = ids[bounds[i] : bounds[i + 1]]
                if held and size + len(tokens) > file_tokens:
                    yield put()
                    held, size = [], 0
                doc = None if pd.isna(doc) else int(doc)
                if not held:
                    first = {"doc_id": doc, "h": int(h), "row": int(row)}
                held.append((doc, tokens))
                size += len(tokens)
        if held:
            yield put()

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = staged(dealt.mapInPandas(run, FILES), "token-files")
    return running(files, [F.col("first")], start=F.col("n_tokens")).select("path", "n_docs", "n_tokens", "start")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start (tokens in all documents before), n_tokens, ids_crc32 for each document of the listed files, a file per row of work."""
    small_batches(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, n_docs, n_tokens, base in zip(b["path"], b["n_docs"], b["n_tokens"], b["start"]):
                store, at = _open(path)
                with store.open_input_file(at) as source:
                    reader = Reader(source)
                    if (reader.n_docs, reader.n_tokens) != (n_docs, n_tokens):
                        raise BadFile(f"{path} has {reader.n_docs} documents, {n_docs} were committed")
                    names, starts, tokens = reader.all()
                raw = tokens.astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1], starts[1:])]
                out = pd.DataFrame({"doc_id": pd.array(names, "Int64"), "start": starts[:-1] + base, "n_tokens": np.diff(starts), "ids_crc32": sums})
                for i in range(0, len(out), 1 << 16):
                    yield out.iloc[i : i + (1 << 16)]

    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path")
    return spread.mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def load(raw: bytes) -> Reader:
    return Reader(io.BytesIO(raw))
