"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training words.

Words are maximal runs of ASCII letters and digits (A-Z lowered) and of all characters beyond ASCII. A
window is ``n`` consecutive words of a benchmark item; an item with fewer words, but some, is one window.
Every word of the benchmark gets a number; a document becomes the numbers of its words (0: foreign), rolling
hashes of all windows are looked up in the sorted set, and every hit is verified on the numbers themselves.

The set is broadcast only while the benchmark has at most ``max_words`` words (some 100 bytes each); a larger one
is cut into pieces of that size (a longer item into overlapping parts). Pieces are read one after the other: the driver
and the cluster hold one at a time, the documents are scanned once for each, its hits are written out, and all are united.

Null text, or one without a word: no words, no hits. Items without words never count. Words of an item with a null id
are hit, but it adds nothing to the items found. Repeated rows are documents of their own; items that share an id count
once. Empty tables: no rows, or no hits. Other columns are ignored by ``scan`` and kept by the removing functions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, discard, free_name, mix64, small_batches, staged

N, MAX_WORDS = 10, 2_000_000
_KEEP = np.arange(256, dtype=np.uint8)
_KEEP[:0x80] = 0x20
for _a, _b, _to in ((b"0", b"9", b"0"), (b"a", b"z", b"a"), (b"A", b"Z", b"a")):
    _KEEP[_a[0] : _b[0] + 1] = np.arange(_b[0] - _a[0] + 1, dtype=np.uint8) + _to[0]
_FOLD = _KEEP.tobytes()
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every window of n numbers."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for j in range(n):
        out = out * U64(0x100000001B3) + ids[j : len(ids) - n + 1 + j]
    return mix64(out)


class WindowSet:
    """The windows of benchmark items: item numbers by window, and the sorted hashes to look them up."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.number: dict[bytes, int] = {}
        self.names: list[str | None] = []
        self.by_length: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]] = {}
        found: dict[int, dict[bytes, list[int]]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        for name, ws in items:
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in ws], np.uint64)
            k = min(n, len(ws))
            self.names.append(name)
            hashes.setdefault(k, []).append(rolling(ids, k))
            for i in range(len(ws) - k + 1):
                of = found.setdefault(k, {}).setdefault(ids[i : i + k].tobytes(), [])
                if not of or of[-1] != len(self.names) - 1:
                    of.append(len(self.names) - 1)
        for k, windows in found.items():
            every = np.unique(np.concatenate(hashes[k]))
            low = np.zeros(1 << 16, bool)
            low[every & U64(0xFFFF)] = True
            self.by_length[k] = (every, low, windows)

    def scan(self, ws: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the names of the items."""
        hit, names = np.zeros(len(ws) + 1, np.int64), set()
        ids = np.fromiter((self.number.get(w, 0) for w in ws), np.uint64, len(ws))
        for k, (every, low, windows) in self.by_length.items():
            if len(ws) < k:
                continue
            h = rolling(ids, k)
            at = np.flatnonzero(low[h & U64(0xFFFF)])
            at = at[every[np.minimum(np.searchsorted(every, h[at]), len(every) - 1)] == h[at]]
            for i in at.tolist():
                if of := windows.get(ids[i : i + k].tobytes()):
                    hit[i] += 1
                    hit[i + k] -= 1
                    names.update(self.names[x] for x in of)
        return np.cumsum(hit[:-1]) > 0, names - {None}


Piece = list[tuple[str | None, list[bytes]]]


def _pieces(benchmark: DataFrame, max_words: int, n: int) -> Iterator[Piece]:
    """Items in pieces of at most max_words words (n at least), each read from the table when it is asked for; one at least."""
    most = max(max_words, n)
    piece, room, none = [], most, True
    for row in benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator():
        ws = words(row["text"])
        step = most if len(ws) <= most else most - n + 1  # windows that cross a cut belong to the part before it
        for at in range(0, len(ws) if len(ws) <= most else len(ws) - n + 1, step):
            part = ws[at : at + most]
            if len(part) > room and piece:
                yield piece
                piece, room, none = [], most, False
            piece.append((row["i"], part))
            room -= len(part)
    if piece or none:
        yield piece


def _digest(names: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N, max_words: int = MAX_WORDS) -> DataFrame:
    """One row for each of docs: its words, hit words, the items found, and ``spans``, the runs of hit words [begin, end)."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = _pieces(benchmark, max_words, n)
    first, second = next(pieces), next(pieces, None)
    many = second is not None
    schema = "key string, doc_id long, n_words long, items array<string>, spans array<struct<begin:long,end:long>>"
    given = docs.select(F.uuid().alias("key") if many else F.lit("").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if many:
        given = staged(given, "scan-docs")  # the key names a row, equal rows as well

    def one(shared) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            windows = shared.value
            for b in batches:
                rows = []
                for key, doc, text in zip(b["key"], b["doc_id"], b["text"]):
                    ws = words(text)
                    hit, names = windows.scan(ws)
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    rows.append((key, None if pd.isna(doc) else int(doc), len(ws), sorted(names), [{"begin": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)]))
                yield pd.DataFrame(rows, columns=["key", "doc_id", "n_words", "items", "spans"]).astype({"doc_id": "Int64"})

        return given.mapInPandas(run, schema)

    if not many:
        return one(spark.sparkContext.broadcast(WindowSet(first, n))).drop("key")
    every = None
    for piece in chain([first, second], pieces):
        shared = spark.sparkContext.broadcast(WindowSet(piece, n))
        found = staged(one(shared) if every is None else one(shared).where(F.size("spans") > 0), "scan-piece")
        shared.destroy()
        every = found if every is None else every.unionByName(found)
    discard(given)
    merged = every.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")
    )
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<begin:long,end:long>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (x["begin"] <= F.element_at(acc, -1)["end"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))),
    )
    return merged.select("doc_id", "n_words", "items", F.when(F.size("spans") > 0, joined).otherwise(F.col("spans")).alias("spans"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of scan()."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["begin"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not shared.value.scan(words(t))[0].any() for t in texts], dtype=bool)

    return clean


SPANS = "array<struct<begin:bigint,end:bigint>>"


def _hits(shared):
    """The runs of hit words of each text, beside those found before."""

    @F.pandas_udf(SPANS)
    def hits(texts: pd.Series, before: pd.Series) -> pd.Series:
        out = []
        for text, old in zip(texts, before):
            hit = shared.value.scan(words(text))[0]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).reshape(-1, 2)
            out.append([*old, *({"begin": int(x), "end": int(y)} for x, y in edge)])
        return pd.Series(out, dtype=object)

    return hits


def _without():
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans):
            hit = np.zeros(max((s["end"] for s in found), default=0), bool)
            for s in found:
                hit[s["begin"] : s["end"]] = True
            out.append(text if text is None or not len(hit) else cut_words(text, hit))
        return pd.Series(out, dtype=object)

    return cut


def _piecewise(docs: DataFrame, benchmark: DataFrame, n: int, max_words: int, step) -> DataFrame:
    """step(docs, broadcast set) for one piece after the other; between pieces the documents are written out and the set is dropped."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = _pieces(benchmark, max_words, n)
    piece = next(pieces)
    while True:
        shared = spark.sparkContext.broadcast(WindowSet(piece, n))
        docs = step(docs, shared)
        if (piece := next(pieces, None)) is None:
            return docs
        docs = staged(docs, "scan-docs")
        shared.destroy()


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = N, max_words: int = MAX_WORDS) -> DataFrame:
    """docs without those in which a window occurs; row by row, every column as it was."""
    return _piecewise(docs, benchmark, n, max_words, lambda d, shared: d.where(_clean(shared)("text")))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N, max_words: int = MAX_WORDS) -> DataFrame:
    """docs with the hit words cut out of ``text`` (what stands between them stays). Hits of all pieces are judged on the input, and cut once."""
    spot = free_name(docs.columns, "hits")
    found = _piecewise(docs.withColumn(spot, F.array().cast(SPANS)), benchmark, n, max_words, lambda d, shared: d.withColumn(spot, _hits(shared)("text", spot)))
    return found.withColumn("text", F.when(F.size(spot) > 0, _without()("text", spot)).otherwise(F.col("text"))).select(*docs.columns)


def cut_words(text: str, hit: np.ndarray) -> str:
    if not hit.any():
        return text
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(_FOLD), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))).reshape(-1, 2)
    keep = np.ones(len(raw), bool)
    for begin, end in edge[: len(hit)][hit]:
        keep[begin:end] = False
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode("utf-8", "surrogatepass")
