"""Edit-aware token counts: a segment tree over pre-token segments, re-encoding only what edits touch.

A text is cut at a change of character class (before a blank or line end, between letters, digits and symbols of any
script), at least every LEAF characters where there is such a place; whatever stands around it, the pre-tokeniser ends a
token there, so counts of the pieces add up. A leaf has LEAF characters and one pre-token at most (a run of letters
without any blank or sign is one: it cannot be cut without changing its tokens). The leaves of the tree hold the pieces'
token and character counts, inner nodes their sums. An edit re-encodes the leaves that it touches, and the neighbour
where it comes within two characters of a cut (the boundary context), and deals the new text out over the same leaves, so
leaves stay short however many edits follow; then sums are updated up to the root.

Trees are kept as a table, a row for each document (trees()); a table of edits is applied to them (edited()) and
gives the trees that follow, encoding nothing but what the edits touch, so later edits find them again.

Null text counts as empty: no tokens. Any text is read whole. Repeated rows are counted alike, and edits apply to every
row of their doc_id (null is an id like others); edits of documents that are not there do nothing. Empty tables give no
rows. Texts that look like special tokens are ordinary text. The vocabulary's path is a parameter; its content (under
2 MB) is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 1024
# Fixed value: the pre-token pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Each depends on two characters only. An apostrophe before a letter is no cut: both may be one token.
_CUT = regex.compile(r"\S(?=[ \t\r\n])|\p{L}(?=[^\p{L}\s])|\p{N}(?=[^\p{N}\s])|[^\s\p{L}\p{N}](?=\p{N})|[^\s\p{L}\p{N}'](?=\p{L})")
#: What the query's edits remove: mail addresses, long runs of digits, runs of symbols.
SCRUB = re.compile(r"[\w.+-]{1,64}@[\w-]{1,63}\.[\w.-]{1,63}|\d[\d .()-]{7,30}\d|[#$%&*]{3,}")
_encodings: dict[str, tiktoken.Encoding] = {}


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """The encoding of these very ranks, made once a worker."""
    k = hashlib.sha256(b"".join(b"%d:%d:%b" % (n, len(t), t) for t, n in ranks.items())).hexdigest()
    if k not in _encodings:
        _encodings[k] = tiktoken.Encoding(f"ranks-{k}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[k]


def pieces(text: str, leaf: int = LEAF) -> list[str]:
    out, at = [], 0
    while m := _CUT.search(text, at + leaf):
        out.append(text[at : m.end()])
        at = m.end()
    return out + [text[at:]]


class TokenTree:
    """Token counts of one document under edits."""

    def __init__(self, text: str, count: Callable[[list[str]], list[int]], leaf: int = LEAF):
        self.count, self.leaf = count, leaf
        self.leaves = pieces(text, leaf)
        self._build(count(self.leaves))
        self.encoded = 0  # characters encoded again by edits

    @classmethod
    def kept(cls, leaves: list[str], tokens: list[int], count: Callable[[list[str]], list[int]], leaf: int = LEAF) -> TokenTree:
        """The tree of leaves with known counts; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.count, tree.leaf, tree.leaves, tree.encoded = count, leaf, list(leaves), 0
        tree._build([int(n) for n in tokens])
        return tree

    def leaf_tokens(self) -> list[int]:
        return self.tokens[self.width : self.width + len(self.leaves)]

    def _build(self, tokens: list[int]) -> None:
        """The sums above leaves of so many tokens."""
        n = len(self.leaves)
        self.width = 1 << max(0, n - 1).bit_length()
        rest = [0] * (self.width - n)
        self.tokens, self.chars = [0] * self.width + tokens + rest, [0] * self.width + [len(p) for p in self.leaves] + rest
        for i in range(self.width - 1, 0, -1):
            self.tokens[i], self.chars[i] = self.tokens[2 * i] + self.tokens[2 * i + 1], self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def between(self, start: int, end: int) -> str:
        """Characters [start, end), from the leaves that hold them."""
        if start >= end:
            return ""
        leaf, begin = self._find(start)
        out, at = [], begin
        while at < end and leaf < len(self.leaves):
            out.append(self.leaves[leaf])
            at += len(self.leaves[leaf])
            leaf += 1
        return "".join(out)[start - begin : end - begin]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one for the end), and where it begins."""
        i, begin = 1, 0
        while i < self.width:
            i *= 2
            if at - begin >= self.chars[i] and (self.chars[i + 1] or at - begin > self.chars[i]):
                begin += self.chars[i]
                i += 1
        return i - self.width, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = leaf + self.width
        self.tokens[i], self.chars[i] = tokens, len(text)
        while i > 1:
            i //= 2
            self.tokens[i], self.chars[i] = self.tokens[2 * i] + self.tokens[2 * i + 1], self.chars[2 * i] + self.chars[2 * i + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces characters [start, end) of the present text."""
        low, begin = self._find(max(0, start - 2))
        high, last = self._find(min(self.chars[1], end + 2))
        high = min(high, len(self.leaves) - 1)
        old = "".join(self.leaves[low : high + 1])
        text = old[: start - begin] + new + old[end - begin :]
        slots = high + 1 - low
        parts = pieces(text, self.leaf)
        grown = len(parts) > 4 * slots  # a long text came in: more leaves
        if not grown and len(parts) > slots:
            parts = pieces(text, -(-len(text) // slots))
        tokens = self.count(parts)
        self.encoded += len(text)
        if grown:
            every = self.leaf_tokens()
            self.leaves[low : high + 1] = parts
            self._build(every[:low] + tokens + every[high + 1 :])
            return
        for i in range(slots):
            if i < len(parts):
                self._set(low + i, parts[i], tokens[i])
            elif self.leaves[low + i]:
                self._set(low + i, "", 0)


def scrubbed(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "") for m in SCRUB.finditer(text)]


def together(text: str | Callable[[int, int], str], edits: list[tuple[int, int, str]], span: int = LEAF) -> list[tuple[int, int, str]]:
    """The same change as sorted, disjoint edits of ``text`` (or of what gives its stretches), with neighbours within ``span`` characters made one edit."""
    between = text if callable(text) else lambda a, b: text[a:b]
    out: list[tuple[int, int, list[str]]] = []
    for start, end, new in edits:
        if out and end - out[-1][0] <= span:
            first, last, parts = out[-1]
            out[-1] = (first, end, parts)
            parts += [between(last, start), new]
        else:
            out.append((start, end, [new]))
    return [(start, end, "".join(parts)) for start, end, parts in out]


TREE = "doc_id long, n_tokens long, n_chars long, leaves array<string>, tokens array<int>"
EDIT = "doc_id long, start long, end long, new string"


def _counter(shared) -> Callable[[list[str]], list[int]]:
    enc = encoding(shared.value)
    return lambda parts: [len(enc.encode_ordinary(p)) for p in parts]


def _frame(rows: list[tuple], ids, columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    out.insert(0, "doc_id", ids.astype("Int64").array)
    return out


def trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """TREE rows, staged: the leaves of each document and their counts (sums above them are additions, made when a tree is read)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_ranks(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(shared)
        for b in batches:
            rows = []
            for text in b["text"]:
                tree = TokenTree(text or "", count)
                rows.append((tree.total, tree.chars[1], tree.leaves, tree.leaf_tokens()))
            yield _frame(rows, b["doc_id"], ["n_tokens", "n_chars", "leaves", "tokens"])

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, TREE), "token-trees")


def edited(forest: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """TREE rows after EDIT rows, stretches [start, end) of a document's text before any of them, with ``n_edits``, ``n_rejected`` and ``n_chars_encoded``.

    Edits meet the trees by doc_id. Applied are those that lie within the text and overlap no applied one before them, by (start,
    end, new); edits with a null place, an end before their start, or a place outside the text are rejected, and so are overlapping ones.
    Several insertions at one place are applied in the order of their texts. A null ``new`` is empty.
    """
    spark = forest.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_ranks(vocabulary))
    of = edits.select(F.col("doc_id").cast("long").alias("_d"), F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce("new", F.lit("")).alias("new")).alias("e"))
    of = of.groupBy("_d").agg(F.sort_array(F.collect_list("e")).alias("edits"))
    joined = forest.join(of, F.col("doc_id").eqNullSafe(F.col("_d")), "left").select("doc_id", "leaves", "tokens", "edits")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(shared)
        for b in batches:
            rows = []
            for leaves, tokens, todo in zip(b["leaves"], b["tokens"], b["edits"]):
                tree, given = TokenTree.kept(leaves, tokens, count), [] if todo is None else [(e["start"], e["end"], e["new"]) for e in todo]
                todo = valid(given, tree.chars[1])
                apply(tree, todo)
                rows.append((tree.total, tree.chars[1], tree.leaves, tree.leaf_tokens(), len(todo), len(given) - len(todo), tree.encoded))
            yield _frame(rows, b["doc_id"], ["n_tokens", "n_chars", "leaves", "tokens", "n_edits", "n_rejected", "n_chars_encoded"])

    return joined.mapInPandas(run, TREE + ", n_edits long, n_rejected long, n_chars_encoded long")


def valid(edits: list[tuple[int | None, int | None, str]], size: int) -> list[tuple[int, int, str]]:
    """Those that can be applied to a text of so many characters, sorted and disjoint."""
    out: list[tuple[int, int, str]] = []
    for start, end, new in sorted(e for e in edits if e[0] is not None and e[1] is not None):
        if 0 <= start <= end <= size and (not out or start >= out[-1][1]):
            out.append((int(start), int(end), new))
    return out


def apply(tree: TokenTree, edits: list[tuple[int, int, str]]) -> None:
    """Sorted, disjoint edits, from the back: places before stay where they are, and each leaf is encoded once or twice."""
    for start, end, new in reversed(together(tree.between, edits)) if edits else ():
        tree.edit(start, end, new)


def counts(docs: DataFrame, edits: Callable[[str], list[tuple[int, int, str]]] = scrubbed, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_chars, n_chars_encoded (again, by edits) for each row.

    ``edits`` gives sorted, disjoint (start, end, new text) of a text; they are found in the kept trees and applied to them.
    """
    spark = docs.sparkSession
    forest = trees(docs, vocabulary)
    shared = spark.sparkContext.broadcast(load_ranks(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(shared)
        for b in batches:
            rows = []
            for before, n, leaves, tokens in zip(b["n_tokens"], b["n_chars"], b["leaves"], b["tokens"]):
                tree = TokenTree.kept(leaves, tokens, count)
                todo = edits(tree.text())
                apply(tree, todo)
                rows.append((before, len(todo), tree.total, n, tree.encoded))
            yield _frame(rows, b["doc_id"], ["n_tokens", "n_edits", "n_tokens_edited", "n_chars", "n_chars_encoded"])

    return forest.mapInPandas(run, "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_chars long, n_chars_encoded long")
