"""Alignment of two tokenisers: where both end a token, which tokens overlap, and how often ids meet in the corpus.

The texts of a whole Arrow batch lie one after another as bytes. Token sizes are summed up to ends, the ends of either
side are counted in one bincount over all bytes of the batch, and the text is cut where both have one. Prefix sums of the
ends give each stretch between neighbouring ends its token on either side, which is a link (two tokens overlap in one
stretch and no other), and differences at the documents' byte offsets give back what belongs to which document.

Ids are encoded once and kept as a table; links are made from them twice, to be counted over the corpus and to be looked up. The
most frequent pairs, HEAD at most whatever the corpus, are broadcast with their counts; links of the others meet theirs in a
join, each document's reduced to its distinct pairs first.

Null and empty texts, and texts that either side doesn't give back byte by byte, have no tokens, zeros and ''. Texts of any
length are encoded whole. Repeated rows, null and shared ids are rows of their own. An empty table gives no rows. Further
columns are ignored. Strings of special tokens are ordinary text. Both vocabularies are parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoders
from .common import small_batches, staged

#: Pairs that are broadcast, of 17 bytes each, and pairs that a task holds before it hands them on.
HEAD, HELD = 400_000, 600_000
ENCODED = "row bigint, doc_id bigint, a binary, b binary"
_B = 32  # bits of a pair's second id


def bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


class Batch:
    """The tokens of some documents on both sides, cut into groups and links. ``a``, ``b``: ids; ``na``, ``nb``: how many each document has."""

    def __init__(self, a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, table_a: encoders.Table, table_b: encoders.Table):
        self.a, self.b, self.at_a, self.at_b = a, b, bounds(na), bounds(nb)
        ends_a, ends_b = np.cumsum(table_a.sizes[a]), np.cumsum(table_b.sizes[b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        ends = np.bincount(ends_a, minlength=total + 1).astype(np.uint8) | np.bincount(ends_b, minlength=total + 1).astype(np.uint8) << 1
        self.offsets = np.concatenate(([0], ends_a))[self.at_a]  # of documents, in bytes
        stops = np.flatnonzero(ends)  # each closes a link
        kind = ends[stops]
        self.link_a, self.link_b = (np.cumsum(x, dtype=np.int64) - x for x in (kind & 1, kind >> 1))  # ends before it
        self.at_links = np.searchsorted(stops, self.offsets, side="right")
        cuts = stops[kind == 3]
        self.at_groups = np.searchsorted(cuts, self.offsets, side="right")
        self.cut_a, self.cut_b = np.searchsorted(ends_a, cuts, side="right"), np.searchsorted(ends_b, cuts, side="right")  # tokens up to each cut

    def pairs(self) -> np.ndarray:
        return self.a[self.link_a].astype(np.uint64) << np.uint64(_B) | self.b[self.link_b]

    def documents(self) -> np.ndarray:
        """The document of each link."""
        return np.repeat(np.arange(len(self.at_links) - 1), np.diff(self.at_links))

    def digests(self, digits: encoders.Table) -> list[str]:
        """SHA-256 of each document's groups as text; ``digits`` has the decimal form of each id and a byte to be set."""
        before_a, before_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        # tokens in the order of the text: a group's A tokens, then its B tokens
        size = before_a + before_b
        begin = np.cumsum(size) - size
        own_a = encoders.stretches(begin, before_a)
        own_b = encoders.stretches(begin + before_a, before_b)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[own_a], ids[own_b] = self.a, self.b
        text = digits.joined(ids)
        last = np.cumsum(digits.sizes[ids]) - 1
        text[last] = 0x2C  # ,
        text[last[begin + before_a - 1]] = 0x7C  # |
        text[last[begin + size - 1]] = 0x3B  # ;
        at = np.concatenate(([0], last + 1))[np.concatenate((begin, [len(ids)]))[self.at_groups]].tolist()
        raw = text.tobytes()
        return [hashlib.sha256(raw[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:])]


def decimal(size: int) -> encoders.Table:
    return encoders.Table([b"%d," % i for i in range(size)])


def encoded(docs: DataFrame, a: str = encoders.BYTE_LEVEL, b: str = encoders.PIECES) -> DataFrame:
    """ENCODED, staged: a row for each of docs(doc_id, text), with the ids of both sides as 16-bit (32-bit in large vocabularies) integers."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = encoders.byte_level(a, True, False), encoders.of_pieces(b)
        for rows in batches:
            texts = [t or "" for t in rows["text"]]
            sides = []
            for e in (one, two):
                ids, counts, sound = e.encode(texts)
                sides.append((ids.astype(width(e.table)), bounds(counts), sound))
            good = [bool(t) and bool(x) and bool(y) for t, x, y in zip(texts, sides[0][2], sides[1][2])]
            out = [[ids[at[i] : at[i + 1]].tobytes() if ok else b"" for i, ok in enumerate(good)] for ids, at, _ in sides]
            yield pd.DataFrame({"row": rows["row"], "doc_id": rows["doc_id"].astype("Int64"), "a": out[0], "b": out[1]})

    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(plain.mapInPandas(run, ENCODED), "alignment-ids")


def width(table: encoders.Table) -> str:
    return "<u2" if len(table.sizes) <= 1 << 16 else "<u4"


def _batch(rows: pd.DataFrame, one: encoders.Encoder, two: encoders.Encoder) -> Batch:
    sides = []
    for column, e in (("a", one), ("b", two)):
        kind = np.dtype(width(e.table))
        raw = [bytes(x) for x in rows[column]]
        sides += [np.frombuffer(b"".join(raw), kind).astype(np.uint32), np.array([len(x) // kind.itemsize for x in raw], np.int64)]
    return Batch(*sides, one.table, two.table)


def runs(*sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, length) of each run of equal keys, which may be columns."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, n))


def sliced(batches: Iterator[pd.DataFrame], most: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Batches of about ``most`` bytes of ids, or of one row: what is made of a batch is many times as large."""
    for rows in batches:
        part = np.cumsum([len(a) + len(b) for a, b in zip(rows["a"], rows["b"])]) // most
        for i, j in zip(cuts := np.searchsorted(part, np.unique(part)), [*cuts[1:], len(rows)]):
            yield rows.iloc[i:j]


def pair_counts(tokens: DataFrame, a: str = encoders.BYTE_LEVEL, b: str = encoders.PIECES, held: int = HELD) -> DataFrame:
    """pair, b, n, top of every id pair, staged: how many links hold it, and whether no pair with its B id has more. Counts are summed in the tasks first."""
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = encoders.byte_level(a, True, False), encoders.of_pieces(b)
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, sums = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            keys, sums = keys[order], sums[order]
            first, _ = runs(keys)
            return keys[first], np.add.reduceat(sums, first) if len(first) else sums

        for rows in sliced(batches):
            own = np.sort(_batch(rows, one, two).pairs())
            first, n = runs(own)
            parts.append((own[first], n))
            if sum(len(k) for k, _ in parts) > held:
                parts = [merged()]
                if len(parts[0][0]) > held // 2:
                    yield pd.DataFrame({"pair": parts[0][0].astype(np.int64), "n": parts[0][1]})
                    parts = []
        if parts:
            keys, sums = merged()
            yield pd.DataFrame({"pair": keys.astype(np.int64), "n": sums})

    n = tokens.select("a", "b").mapInPandas(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    n = staged(n.withColumn("b", F.col("pair").bitwiseAND((1 << _B) - 1)), "alignment-pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))  # a row for each entry of the vocabulary at most
    return staged(n.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("top")), "alignment-counts")


def head_of(counts: DataFrame, head: int = HEAD) -> tuple[pd.DataFrame, int]:
    """(the pairs with at least so many links, that number): the least number that leaves ``head`` pairs at most."""
    scale = F.length(F.bin("n")) - 1  # powers of two, so the list of numbers is short
    per = sorted(((r["k"], r["c"]) for r in counts.groupBy(scale.alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)
    least, total = 2**62, 0
    for k, c in per:
        total += c
        if total > head:
            break
        least = 1 << k
    return counts.where(F.col("n") >= least).select("pair", "n", "top").orderBy("pair").toPandas(), least


def align(docs: DataFrame, a: str = encoders.BYTE_LEVEL, b: str = encoders.PIECES, head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs(doc_id, text)."""
    spark = docs.sparkSession
    tokens = encoded(docs, a, b)
    counts = pair_counts(tokens, a, b)
    frequent, least = head_of(counts, head)
    shared = spark.sparkContext.broadcast((frequent["pair"].to_numpy(np.int64).astype(np.uint64), frequent["n"].to_numpy(np.int64), frequent["top"].to_numpy(bool)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = encoders.byte_level(a, True, False), encoders.of_pieces(b)
        digits = decimal(max(len(one.table.sizes), len(two.table.sizes)))
        keys, sums, tops = shared.value
        for rows in sliced(batches):
            batch, n_docs = _batch(rows, one, two), len(rows)
            pairs = batch.pairs()
            order = np.argsort(pairs, kind="stable")  # links of a pair side by side
            first, times = runs(pairs[order])
            distinct = pairs[order][first]
            at = np.searchsorted(keys, distinct)
            known = at < len(keys)
            known[known] = keys[at[known]] == distinct[known]
            n, top = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            n[known], top[known] = sums[at[known]], tops[at[known]]
            each = np.empty((3, len(pairs)), np.int64)
            each[:, order] = np.repeat(np.stack((n, top, ~known)), times, axis=1)
            total, best = (np.diff(bounds(x)[batch.at_links]) for x in each[:2])
            of, rare = batch.documents()[each[2] > 0], pairs[each[2] > 0]
            order = np.lexsort((rare, of))
            of, rare = of[order], rare[order]
            first, times = runs(of, rare)
            cut = np.searchsorted(of[first], np.arange(n_docs + 1))
            rare = rare[first].astype(np.int64)
            yield pd.DataFrame({
                "row": rows["row"].array, "doc_id": rows["doc_id"].astype("Int64").array, "n_a": np.diff(batch.at_a), "n_b": np.diff(batch.at_b), "n_groups": np.diff(batch.at_groups), "n_links": np.diff(batch.at_links),
                "n_best": best, "count_sum": total, "groups_sha256": batch.digests(digits), "rare": [rare[i:j] for i, j in zip(cut[:-1], cut[1:])], "times": [times[i:j] for i, j in zip(cut[:-1], cut[1:])],
            })

    schema = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, rare array<bigint>, times array<bigint>"
    found = staged(tokens.mapInPandas(run, schema), "alignment-found")
    # a pair with fewer links than the broadcast ones has its count from the table; it occurs fewer than ``least`` times
    each = found.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
    rest = each.join(counts.where(F.col("n") < least).select("pair", "n", "top"), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    more = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return found.join(rest, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", more("n_best", "more_best"), more("count_sum", "more"), "groups_sha256")
