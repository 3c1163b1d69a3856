"""Suffix-array dedup: every byte covered by a LENGTH-byte string that also starts elsewhere is removed.

The suffix array is sparse. Of every LENGTH-byte string one GRAM-byte piece is an anchor: the one with the least hash
(so equal strings have their anchor at the same place). Anchors whose piece occurs nowhere else are dropped at once. Around
the others, the bytes to the right and, reversed, to the left are sorted per piece by deep-shallow sorting; the
common prefixes of neighbours tell, for each of the LENGTH - GRAM + 1 starts that an anchor can serve, which strings
are equal: those in the same class to the left and in the same class to the right.

Equal texts are reduced to one before. What surrounds a piece that is hotter than GROUP places is split by content before
the sort: for each STEP of starts by the core that all strings of these starts hold; cores that nothing else has
are dropped, equal surroundings become one row. A core that is still hotter than GROUP is dealt over several sorts, and
their classes meet in partial aggregates, one row a class and sort, by a 128-bit hash of the string that they stand for.
Nothing is capped.

The same search, over words (runs without ASCII white space; by hashes) instead of bytes, counts the
words inside strings of WORDS words that another document has too; these are reported, not removed.

Null text counts as empty. Texts under LENGTH bytes lose nothing. Texts are named by 16 bytes of their SHA-256, so null
and shared ids do no harm; equal rows are copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, free_shuffles, grams, lanes, prefix_hash, small_batches, span_hash, staged, text_id, word_edges, word_hashes
from .deep_shallow import sort_with_lcp

LENGTH, GRAM, WORDS, WORD_GRAM = 400, 200, 51, 20
GROUP, BATCH, CHUNK = 1024, 8192, 4096
PIECE = 1 << 17  # arrays that stay in a core's cache


def _sliding(x: np.ndarray, w: int, f: np.ufunc, fill) -> np.ndarray:
    """f over every window of w values."""
    n = len(x)
    pad = np.concatenate((x, np.full(-n % w, fill, x.dtype))).reshape(-1, w)
    ahead = f.accumulate(pad, axis=1).ravel()
    back = f.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[: n - w + 1], ahead[w - 1 : n])


def _anchors_in(s: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of symbols with prefix hashes ``s``; no string reaches beyond ``ends`` of its first symbol."""
    n, w = len(ends), length - gram + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = grams(s, n, gram) | np.uint64(1)
    low = _sliding(h, w, np.minimum, np.uint64(2**64 - 1))  # for each string, the least hash of its pieces
    low[ends[: n - length + 1] < np.arange(length, n + 1)] = 0
    edge = np.zeros(w - 1, np.uint64)
    best = _sliding(np.concatenate((edge, low, edge)), w, np.maximum, np.uint64(0))  # the strings that hold a piece
    own = np.flatnonzero(best == h)
    return own, h[own]


def anchors(symbols: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text's bytes or words, in pieces that overlap by a string."""
    places, hashes = [], []
    for at in range(0, max(1, len(symbols) - length + 1), PIECE):
        data = symbols[at : at + PIECE + length - 1]
        own, h = _anchors_in(prefix_hash(data), np.full(len(data), len(data)), length, gram)
        places.append(own + at)
        hashes.append(h)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def anchors_of_texts(raws: list[bytes]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each of some short texts, read as one: its number of words, and places and hashes of the anchors of both units."""
    sizes = np.array([len(r) for r in raws])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    data = np.frombuffer(b" ".join(raws), np.uint8)
    s = prefix_hash(data)
    at, stop = word_edges(data)
    of = np.searchsorted(begin, at, "right") - 1
    n_words = np.bincount(of, minlength=len(raws))
    first_word = np.concatenate(([0], np.cumsum(n_words)[:-1]))
    by_byte, by_word = units()
    ws = span_hash(s, at, stop)
    place, h = _anchors_in(s, np.repeat(begin + sizes, sizes + 1)[: len(data)], by_byte.length, by_byte.gram)
    wplace, wh = _anchors_in(prefix_hash(ws), np.cumsum(n_words)[of], by_word.length, by_word.gram)
    mine, wmine = np.searchsorted(begin, place, "right") - 1, of[wplace]
    cuts, wcuts = np.searchsorted(mine, np.arange(1, len(raws))), np.searchsorted(wmine, np.arange(1, len(raws)))
    parts = (np.split(place - begin[mine], cuts), np.split(h, cuts), np.split(wplace - first_word[wmine], wcuts), np.split(wh, wcuts))
    return [(int(n), *_marked(p, x, q, y)) for n, p, x, q, y in zip(n_words, *parts)]


def _marked(place: np.ndarray, h: np.ndarray, wplace: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of both units together: the last bit of a hash tells the unit."""
    return np.concatenate((place, wplace)), np.concatenate((h & np.uint64(2**64 - 2), wh | np.uint64(1))).view(np.int64)


@dataclass(frozen=True)
class Symbols:
    """A text's symbols as bytes, forth and back."""

    there: bytes
    back: bytes

    @staticmethod
    def of(raw: bytes, words: bool) -> Symbols:
        if not words:
            return Symbols(raw, raw[::-1])
        ids = word_hashes(raw).astype(np.uint32)
        return Symbols(ids.tobytes(), ids[::-1].tobytes())


@dataclass(frozen=True)
class Unit:
    """What strings are made of: symbols of ``size`` bytes. The last bit of an anchor's hash tells the unit.

    ``across``: a string counts only if another text has it.
    """

    length: int
    gram: int
    size: int
    across: bool
    step: int

    def around(self, text: Symbols, p: int, first: int, last: int) -> tuple[bytes, bytes]:
        """What strings that begin first .. last - 1 symbols before p cover to the left, reversed, and to the right."""
        z, back = self.size, len(text.there) - self.size * p
        return text.back[back : back + z * (last - 1)], text.there[z * p : z * (p + self.length - first)]

    def owner(self, name: bytes, places: list[int]) -> tuple[int, int]:
        """Two numbers, equal for what counts as one occurrence."""
        if not self.across and len(places) > 1:
            return -(2**63), 2**63 - 1
        own = int.from_bytes(name[:8] if self.across else xxhash.xxh3_64_digest(name + b"%d" % places[0]), "little", signed=True)
        return own, own


def units() -> tuple[Unit, Unit]:
    """Bytes, and the low halves of the words' hashes."""
    return Unit(LENGTH, GRAM, 1, False, 67), Unit(WORDS, WORD_GRAM, 4, True, 16)


def _encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def repeated_starts(group: np.ndarray, left: list[bytes], right: list[bytes], first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """For members of groups (rows sorted by group): which starts, first .. last - 1 before the anchor, begin a string at
    all, and which one that another owner has, as ``low`` and ``high`` (the least and largest owner of each member) tell.
    """
    n, span = len(group), unit.length - unit.gram
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [n]))
    orders, lcps = [], []
    for strings in (left, right):
        order, lcp = np.empty(n, np.int64), np.empty(n, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            o, c = sort_with_lcp(strings[a:b])
            order[a:b], lcp[a:b] = np.array(o) + a, np.array(c) // unit.size
            lcp[a] = -1  # a class never reaches beyond its group
        orders.append(order)
        lcps.append(lcp)
    sizes = [np.array([len(s) // unit.size for s in x]) for x in (left, right)]
    there, twin = np.zeros((n, span + 1), bool), np.zeros((n, span + 1), bool)
    offsets = np.arange(span + 1)
    there |= (offsets >= np.maximum(first, unit.length - sizes[1])[:, None]) & (offsets <= np.minimum(last - 1, sizes[0])[:, None])
    # what shares too little with its neighbours on both sides shares no string with anything
    best = []
    for order, lcp in zip(orders, lcps):
        near = np.empty(n, np.int64)
        near[order] = np.maximum(lcp, np.concatenate((lcp[1:], [-1])))
        best.append(near)
    several = low != high
    open_rows = (best[0] + best[1] >= unit.length) | several
    cls = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for o in range(span + 1):
        at = np.flatnonzero(there[:, o] & open_rows)
        if not len(at):
            continue
        for side, need in ((0, o), (1, unit.length - o)):
            cls[side][orders[side]] = np.cumsum(lcps[side] < need)
        code, _ = pd.factorize(cls[0][at] * (n + 1) + cls[1][at])
        if unit.across:
            by = np.argsort(code, kind="stable")
            begin = np.flatnonzero(np.diff(code[by], prepend=-1))
            shared = np.minimum.reduceat(low[at][by], begin) != np.maximum.reduceat(high[at][by], begin)
        else:  # each row has owners of its own
            shared = (np.bincount(code) > 1) | (np.bincount(code, several[at]) > 0)
        twin[at, o] = shared[code]
    return there, twin


def _with_anchors(docs: DataFrame) -> DataFrame:
    """A row for each of docs: doc_id, text_id, n_bytes, n_words, sha256, and its anchors of both units."""
    small_batches(docs.sparkSession)
    by_byte, by_word = units()

    def read(raws: list[bytes]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        if len(raws) > 1 or raws and len(raws[0]) < PIECE:
            return anchors_of_texts(raws)
        ws = word_hashes(raws[0])
        return [(len(ws), *_marked(*anchors(np.frombuffer(raws[0], np.uint8), by_byte.length, by_byte.gram), *anchors(ws, by_word.length, by_word.gram)))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raws = [_encode(t) for t in b["text"]]
            found, held, size = [], [], 0
            for raw in raws:  # some PIECE bytes at a time; a longer text by itself
                if held and size + len(raw) >= PIECE:
                    found += read(held)
                    held, size = [], 0
                held.append(raw)
                size += len(raw) + 1
            found += read(held) if held else []
            hashed = [hashlib.sha256(raw) for raw in raws]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").array, "text_id": [x.digest()[:16] for x in hashed], "n_bytes": [len(raw) for raw in raws], "n_words": [f[0] for f in found], "sha256": [x.hexdigest() for x in hashed], "places": [f[1] for f in found], "hashes": [f[2] for f in found]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, text_id binary, n_bytes long, n_words long, sha256 string, places array<long>, hashes array<long>")


CONTEXT = ["hash long", "lane long", "split boolean", "name binary", "places array<long>", "left binary", "right binary", "first int", "last int", "low long", "high long"]
FOUND = "words boolean, name binary, begin long, end long, string binary, low long, high long"


def _chunks(rows: Iterator[tuple], schema: list[str]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in schema]
    while held := list(islice(rows, CHUNK)):
        yield pd.DataFrame(dict(zip(names, map(list, zip(*held)))))
    yield pd.DataFrame({c: [] for c in names}, dtype=object)


def _each_mark(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, list, tuple[Symbols | None, Symbols | None]]]:
    """(text_id, marks, symbols by unit) of rows (text_id, text, marks)."""
    for b in batches:
        for tid, text, marks in zip(b["text_id"], b["text"], b["marks"]):
            raw, have = _encode(text), {m["hash"] & 1 for m in marks}
            yield tid, marks, tuple(Symbols.of(raw, k == 1) if k in have else None for k in (0, 1))


def _contexts(texts: DataFrame) -> DataFrame:
    """One CONTEXT row for each text, anchor that is not hot and distinct surroundings."""
    small_batches(texts.sparkSession)
    both = units()

    def rows(batches) -> Iterator[tuple]:
        for tid, marks, symbols in _each_mark(batches):
            same: dict[tuple, list[int]] = {}
            for m in marks:
                p, h = m["place"], m["hash"]
                unit = both[h & 1]
                same.setdefault((h, *unit.around(symbols[h & 1], p, 0, unit.length - unit.gram + 1)), []).append(p)
            for (h, x, y), ps in same.items():
                unit = both[h & 1]
                yield h, 0, False, tid, ps, x, y, 0, unit.length - unit.gram + 1, *unit.owner(tid, ps)

    return texts.mapInPandas(lambda batches: _chunks(rows(batches), CONTEXT), ", ".join(CONTEXT))


CORE = ["core binary", "text_id binary", "places array<long>", "hash long", "first int", "low long", "high long"]


def _cores(texts: DataFrame) -> DataFrame:
    """CORE rows: for hot anchors, what all strings of a step of starts hold, by a 128-bit hash; a row for each text."""
    small_batches(texts.sparkSession)
    both = units()

    def rows(batches) -> Iterator[tuple]:
        for tid, marks, symbols in _each_mark(batches):
            same: dict[tuple, list[int]] = {}
            for m in marks:
                unit, own, p = both[m["hash"] & 1], symbols[m["hash"] & 1], m["place"]
                for first in range(0, unit.length - unit.gram + 1, unit.step):
                    a, b = unit.size * (p - first), unit.size * (p + unit.length - min(first + unit.step, unit.length - unit.gram + 1) + 1)
                    if 0 <= a and b <= len(own.there):
                        same.setdefault((xxhash.xxh3_128_digest(b"%d:" % first + own.there[a:b]), m["hash"], first), []).append(p)
            for (core, h, first), ps in same.items():
                yield core, tid, ps, h, first, *both[h & 1].owner(tid, ps)

    return texts.mapInPandas(lambda batches: _chunks(rows(batches), CORE), ", ".join(CORE))


MEMBER = ["name binary", "text_id binary", "places array<long>"]


def _core_contexts(texts: DataFrame, members: bool) -> DataFrame:
    """CONTEXT rows of hot anchors, named by their content, one for each text; or, of ``members``, MEMBER rows."""
    small_batches(texts.sparkSession)
    both = units()

    def rows(batches) -> Iterator[tuple]:
        for tid, marks, symbols in _each_mark(batches):
            same: dict[bytes, tuple] = {}
            for m in marks:
                unit, first = both[m["hash"] & 1], m["first"]
                last = min(first + unit.step, unit.length - unit.gram + 1)
                key = int.from_bytes(m["core"][:8], "little", signed=True) & -2 | m["hash"] & 1
                for p in m["places"]:
                    x, y = unit.around(symbols[m["hash"] & 1], p, first, last)
                    name = xxhash.xxh3_128_digest(b"%d:%d:%d:" % (key, first, len(x)) + x + y)
                    same.setdefault(name, (key, m["sorts"], x, y, first, last, []))[-1].append(p)
            for name, (key, sorts, x, y, first, last, ps) in same.items():
                if members:
                    yield name, tid, ps
                else:
                    yield key, int.from_bytes(name[8:], "little") % sorts, sorts > 1, name, [0], x, y, first, last, *both[key & 1].owner(tid, ps)

    schema = MEMBER if members else CONTEXT
    return texts.mapInPandas(lambda batches: _chunks(rows(batches), schema), ", ".join(schema))


def _runs(flags: np.ndarray) -> np.ndarray:
    """[begin, end) of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).reshape(-1, 2)


def _judged(rows: list[tuple], unit: Unit) -> Iterator[tuple]:
    """FOUND rows of sorted contexts: stretches, and for sorts of a split group the classes that others may have too.

    Such a row has ``string``; low and high are the least and largest owner in its class, a row without a name stands for
    a class that is shared already.
    """
    group = np.unique(np.array([r[:2] for r in rows], np.int64), axis=0, return_inverse=True)[1].ravel()
    first, last, low, high = (np.array([r[k] for r in rows], np.int64) for k in (7, 8, 9, 10))
    there, twin = repeated_starts(group, [r[5] for r in rows], [r[6] for r in rows], first, last, low, high, unit)
    words = unit.across
    for i in np.flatnonzero(twin.any(axis=1)).tolist():
        for a, b in _runs(twin[i]).tolist():
            for p in rows[i][4]:
                yield words, rows[i][3], int(p) - (b - 1), int(p) - a + unit.length, None, 0, 0
    seen: set[bytes] = set()
    for i, (h, _, split, name, places, left, right, begin, _, lo, hi) in enumerate(rows):
        if not split:
            continue
        for o in np.flatnonzero(there[i]).tolist():
            string = xxhash.xxh3_128_digest(b"%d:%d:" % (h, o) + left[: o * unit.size] + right[: (unit.length - o) * unit.size])
            if not twin[i, o]:
                for p in places:
                    yield words, name, int(p) - o, int(p) - o + unit.length, string, lo, hi
            elif string not in seen:
                seen.add(string)
                yield words, None, 0, 0, string, -(2**63), 2**63 - 1


def _sorted(contexts: DataFrame) -> DataFrame:
    """FOUND rows, from deep-shallow sorts of whole groups or lanes of them."""
    small_batches(contexts.sparkSession)
    both, schema = units(), FOUND.split(", ")

    def judged(held: list[tuple]) -> Iterator[tuple]:
        for k, unit in enumerate(both):
            if own := [r for r in held if r[0] & 1 == k]:
                yield from _judged(own, unit)

    def rows(batches) -> Iterator[tuple]:
        held: list[tuple] = []
        for b in batches:
            for r in zip(*(b[c] for c in b.columns)):
                if len(held) >= BATCH and r[:2] != held[-1][:2]:  # whole groups, of about GROUP rows at most
                    yield from judged(held)
                    held = []
                held.append((*r[:5], bytes(r[5]), bytes(r[6]), *r[7:]))
        yield from judged(held)

    keys = ["hash", "lane"]
    dealt = contexts.repartition(lanes(contexts.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(lambda batches: (t.astype({"words": bool, **{c: "int64" for c in ("begin", "end", "low", "high")}}) for t in _chunks(rows(batches), schema)), FOUND)


def _settled(found: DataFrame) -> DataFrame:
    """(words, name, begin, end) of staged FOUND rows, once classes of different sorts have met."""
    again = found.where("string is not null").groupBy("string").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("string")
    stretch = ["words", "name", "begin", "end"]
    return found.where("string is null").select(*stretch).unionByName(found.where("name is not null").join(again, "string").select(*stretch))


def _hot_stretches(texts: DataFrame) -> DataFrame:
    """(words, text_id, begin, end) around hot anchors, staged, from rows (text_id, text, marks)."""
    cores = staged(_cores(texts), "suffix-cores")
    shared = cores.groupBy("core").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high").select("core", F.ceil(F.col("n") / GROUP).cast("int").alias("sorts"))
    picked = cores.join(shared, "core").groupBy("text_id").agg(F.collect_list(F.struct("places", "hash", "first", "core", "sorts")).alias("marks"))
    left = staged(texts.select("text_id", "text").join(picked, "text_id"), "suffix-hot")
    every = _core_contexts(left, False)
    keep = [c.split()[0] for c in CONTEXT if c.split()[0] not in ("name", "low", "high")]
    one = every.groupBy("name").agg(*[F.any_value(c).alias(c) for c in keep], F.min("low").alias("low"), F.max("high").alias("high"))
    found = staged(_sorted(one.select(*[c.split()[0] for c in CONTEXT])), "suffix-found")
    members = _core_contexts(left, True)
    met = members.join(_settled(found), "name").select("words", "text_id", "begin", "end", F.explode("places").alias("place"))
    out = met.select("words", "text_id", (F.col("place") + F.col("begin")).alias("begin"), (F.col("place") + F.col("end")).alias("end"))
    out = staged(out, "suffix-hot-stretches")
    discard(cores, left, found)
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, the number of maximal removed runs, and how many bytes they have."""
    gone = _covered(len(raw), spans)
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), len(_runs(gone)), int(gone.sum())


def _covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for a, b in spans:
        edge[a] += 1
        edge[b] -= 1
    return np.cumsum(edge[:-1]) > 0


def _search(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staged: a row for each document, the texts that have repeated pieces, the stretches found in each text, and texts that are copied."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = staged(_with_anchors(docs), "suffix-anchors")
    long_enough = (F.col("n_bytes") >= LENGTH) | (F.col("n_words") >= WORDS)
    one = F.any_value(F.struct("places", "hashes"))
    distinct = staged(every.where(long_enough).groupBy("text_id").agg(F.count(F.lit(1)).alias("copies"), one.alias("a")), "suffix-distinct")
    marks = distinct.select("text_id", F.explode(F.arrays_zip("a.places", "a.hashes")).alias("m")).select("text_id", F.col("m.places").alias("place"), F.col("m.hashes").alias("hash"))
    shared = staged(marks.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash", F.ceil(F.col("n") / GROUP).cast("int").alias("sorts")), "suffix-shared")
    wanted = marks.join(shared.hint("merge"), "hash").groupBy("text_id").agg(F.collect_list(F.struct("place", "hash", "sorts")).alias("marks"))
    wanted = staged(wanted, "suffix-wanted")
    # copies of a text become one row before the corpus is shuffled, once
    named = docs.select(text_id(F.col("text")).alias("text_id"), "text").groupBy("text_id").agg(F.any_value("text").alias("text"))
    texts = staged(named.join(wanted.hint("merge"), "text_id"), "suffix-texts")
    copied = staged(distinct.where("copies > 1").select("text_id"), "suffix-copied")
    discard(distinct, shared, wanted)
    free_shuffles(docs.sparkSession)
    of = lambda hot: texts.withColumn("marks", F.filter("marks", lambda m: (m["sorts"] > 1) == F.lit(hot))).where(F.size("marks") > 0)
    found = staged(_sorted(_contexts(of(False))), "suffix-found")
    free_shuffles(docs.sparkSession)
    hot = _hot_stretches(of(True))
    stretches = found.select("words", F.col("name").alias("text_id"), "begin", "end").unionByName(hot)
    listed = staged(stretches.groupBy("text_id").agg(F.collect_set(F.struct("words", "begin", "end")).alias("spans")), "suffix-listed")  # as long as the text itself at most
    discard(found, hot)
    free_shuffles(docs.sparkSession)
    return every, texts, listed, copied


def _cut(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """(text_id, n_removed, n_spans, n_shared_words, kept_sha256) of texts in which something was found."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for tid, text, spans in zip(b["text_id"], b["text"], b["spans"]):
                raw = _encode(text)
                kept, n, removed = kept_bytes(raw, [(s["begin"], s["end"]) for s in spans if not s["words"]])
                words = [(s["begin"], s["end"]) for s in spans if s["words"]]
                rows.append((tid, removed, n, int(_covered(max((e for _, e in words), default=0), words).sum()), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["text_id", "n_removed", "n_spans", "n_shared_words", "kept_sha256"])

    return texts.select("text_id", "text").join(listed, "text_id").mapInPandas(run, "text_id binary, n_removed long, n_spans long, n_shared_words long, kept_sha256 string")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_words, n_shared_words for every row of docs(doc_id, text).

    n_shared_words: words inside strings of WORDS words that another document has too.
    """
    every, texts, listed, copied = _search(docs)
    lost = staged(copied.withColumn("copied", F.lit(True)).join(_cut(texts, listed), "text_id", "full"), "suffix-lost")
    discard(texts, listed, copied)
    out = every.drop("places", "hashes").join(lost, "text_id", "left")
    whole = F.coalesce("copied", F.lit(False))
    gone = whole & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", zero)).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        "n_words",
        F.when(whole & (F.col("n_words") >= WORDS), F.col("n_words")).otherwise(F.coalesce("n_shared_words", zero)).alias("n_shared_words"),
    )


def remove(docs: DataFrame) -> DataFrame:
    """docs, all rows and columns, with the repeated bytes cut out of ``text``; bytes left over from a cut character go too."""
    small_batches(docs.sparkSession)
    _, texts, listed, copied = _search(docs)
    discard(texts)
    key, spans, whole = (free_name(docs.columns, n) for n in ("text_id", "spans", "copied"))
    lost = copied.select(F.col("text_id").alias(key), F.lit(True).alias(whole)).join(listed.select(F.col("text_id").alias(key), F.filter("spans", lambda s: ~s["words"]).alias(spans)), key, "full")

    @F.pandas_udf("string")
    def cut(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else kept_bytes(_encode(t), [(s["begin"], s["end"]) for s in f])[0].decode("utf-8", "ignore") for t, f in zip(text, found)], dtype=object)

    gone = F.coalesce(whole, F.lit(False)) & (F.octet_length("text") >= LENGTH)
    some = F.size(F.coalesce(F.col(spans), F.array())) > 0
    text = F.when(gone, F.lit("")).when(some, cut(F.when(some, F.col("text")), spans)).otherwise(F.col("text"))
    joined = docs.withColumn(key, text_id(F.col("text"))).join(lost, key, "left")
    return joined.withColumn("text", text).select(*docs.columns)
