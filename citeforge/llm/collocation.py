"""Phrase collocations: contiguous phrases of 2 to 4 words that are frequent, scored by how firmly their parts hold together.

Texts in lower case are cut into pieces at punctuation and line ends, and pieces into words. Words are counted for each
language; the frequent ones get dense numbers, the most frequent first. Texts are rewritten as numbers, with a break wherever a
piece ends or a word is not frequent, as no frequent phrase holds one. Windows of 2 to 4 numbers are packed into keys of two
64-bit words (four numbers of 32 bits, 0 where a phrase is shorter), radix-sorted and run-length counted in the tasks,
dealt by ranges of keys, radix-sorted and counted again. Longer phrases are packed only where all their pairs of
neighbours pass a fixed-size bitmap of the frequent pairs; it holds all of them, so nothing is lost.

The HEAD most frequent words (of HEAD_BYTES at most) are broadcast; every other frequent word passes a bitmap of fixed size, goes
with its place to a join with the dictionary, and comes back as a number. Numbers are of 32 bits, so there may be 4e9 of
frequent words. Parts and longer phrases are joined by key, best-of sums before the shuffle; the last of each language are ranked
from what each task keeps of it, ``keep`` rows.

Null text counts as empty, null languages as ``und``. Texts are read whole, and repeated rows count as often as they occur. Ties
of the score go to the larger count, then to the phrase that comes first in UTF-8 bytes. An empty table gives no rows.
Further columns are ignored. Scores are exact: decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .alignment import runs
from .common import small_batches, staged
from .mixing import running

LEAST, LONGEST, KEEP, SCALE, COVER = 30, 4, 2000, 2_000_000, 80
#: Words that are broadcast, the longest of them in bytes, and the bits of the two bitmaps (words that are not, pairs).
HEAD, HEAD_BYTES, WORD_BITS, PAIR_BITS = 200_000, 48, 22, 25
#: Distinct words, and packed windows, that a task holds before it hands them on.
HELD_WORDS, HELD_KEYS = 150_000, 600_000
#: Characters of texts that are cut into words at once.
SLICE = 1 << 17
#: Rows that a task hands on at once: Arrow buffers lie outside the heap, and what they leave there is not given back.
HANDED = 50_000
#: Rows of keys for each range partition, few enough for a task to hold its distinct keys.
RANGE_ROWS = 800_000
_STOP = b"\xff"  # no byte of UTF-8
_MAP = bytes(0xFF if chr(i) in ".,;:!?" or 0x0A <= i <= 0x0D else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))
UNKNOWN = "und"


def words_of(texts: list[str]) -> list[bytes]:
    """The words of all texts, with a STOP where a piece ends."""
    return _STOP.join(t.encode("utf-8", "surrogatepass") for t in texts).translate(_MAP).replace(_STOP, b" \xff ").split()


def by_language(rows: pd.DataFrame, most: int = SLICE) -> Iterator[tuple[str, list[str]]]:
    """Each language's texts, in slices of ``most`` characters or one text: words take many times the bytes of their texts."""
    for lang, group in rows.groupby("lang", sort=False):
        part: list[str] = []
        size = 0
        for t in group["text"]:
            if t:
                if part and size + len(t) > most:
                    yield lang, part
                    part, size = [], 0
                part.append(t)
                size += len(t)
        if part:
            yield lang, part


def word_counts(docs: DataFrame, held: int = HELD_WORDS) -> DataFrame:
    """lang, word, n over docs(text, lang), staged; summed in the tasks first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, Counter] = {}

        def out() -> Iterator[pd.DataFrame]:
            for lang, c in sums.items():
                words = list(c)
                for i in range(0, len(words), HANDED):
                    part = words[i : i + HANDED]
                    yield pd.DataFrame({"lang": lang, "word": [w.decode("utf-8", "surrogatepass") for w in part], "n": [c[w] for w in part]})
            sums.clear()

        for rows in batches:
            for lang, texts in by_language(rows):
                sums.setdefault(lang, Counter()).update(words_of(texts))
                sums[lang].pop(_STOP, None)
                if sum(map(len, sums.values())) > held:
                    yield from out()
        yield from out()

    plain = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    return staged(plain.mapInPandas(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")


def numbered(words: DataFrame) -> DataFrame:
    """lang, word, n, id (from 1, the most frequent first) of words(lang, word, n), staged."""
    out = running(words, [F.col("n").desc(), F.col("lang"), F.col("word")]).withColumnRenamed("nth", "id")
    if (out.agg(F.max("id")).first()[0] or 0) >= 1 << 32:
        raise ValueError("more than 4e9 frequent words")
    return out


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Which of 2**bits places(p) occur, as packed bits, united bucket by bucket; the driver gets 2**bits / 8 bytes at most."""
    united = places.groupBy(F.expr("p div 32768").alias("k")).agg(F.bitmap_construct_agg(F.expr("p % 32768")).alias("b"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in united.collect():
        out[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["b"], np.uint8)
    return out


def _bits(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (packed[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def pair_place(hi: np.ndarray) -> np.ndarray:
    """A place in the bitmap of pairs, of 64-bit keys of two numbers: the top bits of a product."""
    return (hi * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


ENCODED = "row bigint, ids binary, places array<int>, lang string, words array<string>"


def rewritten(docs: DataFrame, dictionary: DataFrame, head: int = HEAD) -> DataFrame:
    """Texts as numbers (32-bit, 0 for a break), staged: a row for each slice of a batch's texts of one language; ids binary, numbers of rarer words filled in."""
    spark = docs.sparkSession
    short = F.octet_length("word") <= HEAD_BYTES
    near = dictionary.where((F.col("id") <= head) & short)
    rare = dictionary.where((F.col("id") > head) | ~short)
    known: dict[str, dict[bytes, int]] = {}
    for r in near.select("lang", "word", "id").collect():  # ``head`` words of HEAD_BYTES at most
        known.setdefault(r["lang"], {})[r["word"].encode("utf-8", "surrogatepass")] = r["id"]
    places = bitmap(rare.select((F.crc32(F.col("word").cast("binary")) % (1 << WORD_BITS)).alias("p")), WORD_BITS)
    shared = spark.sparkContext.broadcast((known, places if places.any() else None))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, places = shared.value
        mask = (1 << WORD_BITS) - 1
        for rows in batches:
            out = []
            for lang, texts in by_language(rows):
                words = words_of(texts)
                ids = np.fromiter(map(known.get(lang, {}).get, words, repeat(0)), np.uint32, len(words))
                at: list[int] = []
                if places is not None:
                    open_ = np.array([i for i in np.flatnonzero(ids == 0).tolist() if words[i] != _STOP], np.int64)
                    at = open_[_bits(places, np.array([zlib.crc32(words[i]) & mask for i in open_.tolist()], np.int64))].tolist()
                out.append((ids.tobytes(), at, lang, [words[i].decode("utf-8", "surrogatepass") for i in at]))
            yield pd.DataFrame(out, columns=["ids", "places", "lang", "words"])

    plain = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    schema = "ids binary, places array<int>, lang string, words array<string>"
    texts = staged(plain.mapInPandas(run, schema).withColumn("row", F.monotonically_increasing_id()), "phrase-numbers")
    asked = texts.where(F.size("places") > 0)
    each = asked.select("row", "lang", F.explode(F.arrays_zip("places", "words")).alias("x")).select("row", "lang", F.col("x.places").alias("place"), F.col("x.words").alias("word"))
    got = each.join(rare.select("lang", "word", "id"), ["lang", "word"]).groupBy("row").agg(F.collect_list(F.struct("place", "id")).alias("got"))  # of one batch of texts

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for raw, got in zip(rows["ids"], rows["got"]):
                ids = np.frombuffer(raw, np.uint32).copy()
                if got is not None and len(got):
                    ids[[g["place"] for g in got]] = [g["id"] for g in got]
                out.append(ids.tobytes())
            yield pd.DataFrame({"ids": out})

    return texts.where(F.size("places") == 0).select("ids").unionByName(asked.join(got, "row", "left").select("ids", "got").mapInPandas(filled, "ids binary"))


def radix_order(*digits: np.ndarray) -> np.ndarray:
    """The order of keys of several 64-bit words, the first the highest: stable passes over 16 bits each, from the lowest; bits that are the same in all are left out."""
    order = np.arange(len(digits[0]))
    for d in reversed(digits):
        varied = int(np.bitwise_or.reduce(d) & ~np.bitwise_and.reduce(d)) if len(d) else 0
        for shift in range(0, 64, 16):
            if varied >> shift & 0xFFFF:
                order = order[np.argsort((d[order] >> np.uint64(shift)).astype(np.uint16), kind="stable")]  # a radix sort for 16 bits
    return order


def counted(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = radix_order(hi, lo)
    hi, lo, n = hi[order], lo[order], n[order]
    first, _ = runs(hi, lo)
    return hi[first], lo[first], np.add.reduceat(n, first) if len(first) else n


def _summed(windows, held: int, step: int = 1 << 62, least: int = 1):
    """mapInPandas function that counts the keys (hi, lo, n) which ``windows`` makes of each batch, or of each ``step`` rows of it.

    Where a task has to hand keys on only once, at its end, those that occur less than ``least`` times stay behind: the caller must
    have dealt all of a key's rows to one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[tuple] = []
        size, whole = 0, True

        def merged() -> tuple:
            return counted(*(np.concatenate(x) for x in zip(*parts)))

        def out(keys: tuple) -> Iterator[pd.DataFrame]:
            for i in range(0, len(keys[0]), HANDED):
                hi, lo, n = (k[i : i + HANDED] for k in keys)
                yield pd.DataFrame({"hi": hi.astype(np.int64), "lo": lo.astype(np.int64), "n": n})

        for rows in (batch.iloc[i : i + step] for batch in batches for i in range(0, len(batch), step)):
            keys = windows(rows)
            if len(keys[0]):
                parts.append(keys)
                size += len(keys[0])
            if size > held:
                parts = [merged()]
                size = len(parts[0][0])
                if size > held // 2:
                    yield from out(parts[0])
                    parts, size, whole = [], 0, False
        if parts:
            keys = merged()
            yield from out(tuple(k[keys[2] >= least] for k in keys) if whole else keys)

    return run


KEYS = "hi bigint, lo bigint, n bigint"


def frequent(windows, texts: DataFrame, least: int, held: int = HELD_KEYS) -> DataFrame:
    """KEYS of the windows that occur ``least`` times, staged: counted in the tasks, dealt by ranges of keys, counted again.

    Each task sends a key once for each time that it had to hand on what it held, so no key is hot in the second count.
    """
    spark = texts.sparkSession
    each = staged(texts.mapInPandas(_summed(windows, held, 1), KEYS), "phrase-keys")  # a row is a slice of texts
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-each.count() // RANGE_ROWS))
    own = lambda rows: (rows["hi"].to_numpy(np.int64).astype(np.uint64), rows["lo"].to_numpy(np.int64).astype(np.uint64), rows["n"].to_numpy(np.int64))
    dealt = each.repartitionByRange(parts, "hi", "lo").mapInPandas(_summed(own, held, least=least), KEYS)
    # a range with more distinct keys than a task holds hands them on more than once, rare ones too; of the others only frequent keys come here
    return staged(dealt.groupBy("hi", "lo").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrase-frequent")


def phrases(docs: DataFrame, least: int = LEAST, head: int = HEAD, held: int = HELD_KEYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frequent words: lang, word, n, id; frequent phrases: KEYS; words of each language: lang, n) of docs(text, lang)."""
    spark = docs.sparkSession
    small_batches(spark)
    words = word_counts(docs)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    dictionary = numbered(words.where(F.col("n") >= least))
    texts = staged(rewritten(docs, dictionary, head), "phrase-texts")

    def pairs(rows: pd.DataFrame) -> tuple:
        hi = [x[:-1] << np.uint64(32) | x[1:] for x in _numbers(rows)]
        hi = np.concatenate([h[(h >> np.uint64(32) > 0) & (h & np.uint64(0xFFFFFFFF) > 0)] for h in hi]) if hi else np.empty(0, np.uint64)
        return hi, np.zeros(len(hi), np.uint64), np.ones(len(hi), np.int64)

    two = frequent(pairs, texts, least, held)
    places = _pair_bitmap(two)
    shared = spark.sparkContext.broadcast(places)

    def longer(rows: pd.DataFrame) -> tuple:
        his, los = [], []
        for x in _numbers(rows):
            if len(x) < 3:
                continue
            pair = x[:-1] << np.uint64(32) | x[1:]
            good = (x[:-1] > 0) & (x[1:] > 0)
            good[good] = _bits(shared.value, pair_place(pair[good]))
            three = np.flatnonzero(good[:-1] & good[1:])
            his.append(pair[three])
            los.append(x[three + 2] << np.uint64(32))
            four = three[:-1][np.diff(three) == 1] if len(three) else three
            his.append(pair[four])
            los.append(pair[four + 2])
        hi, lo = (np.concatenate(p) if p else np.empty(0, np.uint64) for p in (his, los))
        return hi, lo, np.ones(len(hi), np.int64)

    more = frequent(longer, texts, least, held)
    return dictionary, two.unionByName(more), totals


def _numbers(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(raw, np.uint32).astype(np.uint64) for raw in rows["ids"]]


def _pair_bitmap(two: DataFrame) -> np.ndarray:
    """The bitmap of frequent pairs: each task's own places, then all of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"p": np.unique(pair_place(rows["hi"].to_numpy(np.int64).astype(np.uint64)))})

    return bitmap(two.select("hi").mapInPandas(run, "p bigint"), PAIR_BITS)


def _number(k: int) -> str:
    """The kth of four numbers of a key, from 1."""
    word, shift = ("hi", "lo")[(k - 1) // 2], 32 * (k % 2)
    return f"shiftrightunsigned({word}, {shift}) & 4294967295" if shift else f"{word} & 4294967295"


def _key(numbers: list[str]) -> str:
    """struct(hi, lo) of up to four numbers."""
    a, b, c, d = [*numbers, *["0L"] * (4 - len(numbers))]
    return f"named_struct('hi', shiftleft({a}, 32) | {b}, 'lo', shiftleft({c}, 32) | {d})"


def scored(dictionary: DataFrame, found: DataFrame, scale: int = SCALE, cover: int = COVER) -> DataFrame:
    """hi, lo, a, l, r, score, id1 .. id4 of the phrases that no longer one covers."""
    each = staged(found.select("hi", "lo", F.col("n").alias("a"), *[F.expr(_number(k)).alias(f"id{k}") for k in range(1, 5)]).withColumn("words", F.expr("2 + int(id3 > 0) + int(id4 > 0)")), "phrase-candidates")
    id_of = [f"id{k}" for k in range(1, 5)]
    counts = each.select(F.struct("hi", "lo").alias("part"), F.col("a").alias("f")).unionByName(dictionary.select(F.expr("named_struct('hi', shiftleft(id, 32), 'lo', 0L)").alias("part"), F.col("n").alias("f")))
    # every cut of every phrase into two parts, and every shorter phrase inside
    cut = lambda n, k: f"struct({k} AS k, 0 AS side, {_key(id_of[:k])} AS part), struct({k} AS k, 1 AS side, {_key(id_of[k:n])} AS part)"
    cuts = "CASE words " + " ".join(f"WHEN {n} THEN array({', '.join(cut(n, k) for k in range(1, n))})" for n in (2, 3, 4)) + " END"
    parts = each.select("hi", "lo", "a", F.explode(F.expr(cuts)).alias("x")).select("hi", "lo", "a", "x.*")
    sides = parts.join(counts, "part").groupBy("hi", "lo", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"(cast(a AS decimal(20, 0)) * {scale}) div (cast(l AS decimal(20, 0)) + r)")
    best = sides.withColumn("score", score).groupBy("hi", "lo").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = [(3, 2), (4, 2), (4, 3)]
    within = "CASE words " + " ".join(f"WHEN {n} THEN array({', '.join(_key(id_of[i : i + m]) for w, m in inside if w == n for i in range(n - m + 1))})" for n in (3, 4)) + " END"
    longest = each.where("words > 2").select(F.explode(F.expr(within)).alias("part"), F.col("a").alias("longer")).groupBy("part").agg(F.max("longer").alias("longer"))
    longest = longest.select(F.col("part.hi").alias("hi"), F.col("part.lo").alias("lo"), "longer")
    kept = each.join(longest, ["hi", "lo"], "left").where(f"longer IS NULL OR cast(longer AS decimal(20, 0)) * 100 < cast(a AS decimal(20, 0)) * {cover}")
    return kept.join(best, ["hi", "lo"]).select("hi", "lo", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"), *id_of)


def collocations(docs: DataFrame, least: int = LEAST, keep: int = KEEP, head: int = HEAD, held: int = HELD_KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``keep`` of each language by score, count and phrase."""
    dictionary, found, totals = phrases(docs, least, head, held)
    rows = scored(dictionary, found)
    # the language is that of the first word; those that cannot be among the first go before words are looked up
    tongues = dictionary.select(F.col("id").alias("id1"), "lang")
    rows = rows.join(tongues, "id1")
    close = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    rows = rows.withColumn("_r", F.rank().over(close)).where(F.col("_r") <= keep).drop("_r")
    each = rows.select("lang", "hi", "lo", "a", "l", "r", "score", F.posexplode(F.array(*[f"id{k}" for k in range(1, 5)])).alias("nth", "id")).where("id > 0")
    named = each.join(dictionary.select("id", "word"), "id").groupBy("lang", "hi", "lo", "a", "l", "r", "score").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    first = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
