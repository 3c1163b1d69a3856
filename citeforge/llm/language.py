"""Language identification by hierarchical discrimination.

First linear support vector machines tell language families apart, then one-versus-one machines separate the
languages within the family chosen. Features are hashed byte 1- to 4-grams of the lower-cased text with
everything but letters as a blank; a text of any length is read whole, in pieces.

Training takes at most ``SAMPLE`` documents of each language, chosen by a hash of doc_id among the labelled
documents it may learn from; where there are many languages fewer of each, so that there are ``ROWS`` in all (``FEWEST`` of
each at least). Only their feature counts reach the driver, 50 KB each at most. Languages are all labels found there. Known
codes are dealt to families by a fixed table; unknown ones join the family whose mean is nearest and that has room (``ROOM``
languages), else they found one, so machines grow with the languages and not with their square. Training is deterministic.

Null text, or a text without a letter (Unicode category L): ``und``, score 0. No labelled documents at all: ``und`` everywhere. One
language: it gets every text with a letter, score 1. Null doc_id: never learned from, held_out is false.
Repeated rows are predicted alike; an empty table gives no rows. The score multiplies the chances that the
machines' margins give the family and the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

SAMPLE, ROWS, FEWEST, ROOM, BINS, EPOCHS, COST, PIECE = 400, 4000, 8, 12, 1 << 13, 12, 4.0, 1 << 18
UNKNOWN = "und"
# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl sv da no is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru pl cs sk uk bg sr hr sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
}
_LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def features(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts, of length 1."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)
    counts = np.zeros(BINS, np.float64)
    for at in range(0, len(raw), PIECE):
        c = np.frombuffer(b" " * (at == 0) + raw[max(0, at - 3) : at + PIECE] + b" " * (at + PIECE >= len(raw)), np.uint8).astype(np.uint32)
        new = 0 if at == 0 else 3  # bytes that the piece before has counted
        gram = c
        for n in range(1, 5):
            if n > 1:
                gram = (gram[: len(c) - n + 1] << np.uint32(8)) | c[n - 1 :]
            if len(gram):
                own = gram[max(0, new - n + 1) :]
                hashed = (own * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - 13)
                counts += np.bincount(hashed, minlength=BINS)
    out = np.sqrt(counts)
    size = np.sqrt(np.square(out).sum())
    return (out / size if size else out).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a linear SVM with hinge loss, by coordinate descent on the dual."""
    w, alpha = np.zeros(x.shape[1] + 1, np.float64), np.zeros(len(y))
    norms = np.square(x).sum(axis=1) + 1.0
    cost = COST * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))  # either side weighs the same
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(y)):
            gain = y[i] * (x[i] @ w[:-1] + w[-1]) - 1.0
            new = min(max(alpha[i] - gain / norms[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                w[:-1] += step * x[i]
                w[-1] += step
                alpha[i] = new
    return w


@dataclass
class Machines:
    """One machine for each pair of names; names[a] is on the positive side of pair (a, b)."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Machines:
        pairs = [(a, b) for a in range(len(names)) for b in range(a + 1, len(names))]
        ws = []
        for a, b in pairs:
            of = (y == a) | (y == b)
            ws.append(train_svm(x[of], np.where(y[of] == a, 1.0, -1.0)))
        return Machines(names, pairs, np.array(ws, np.float32).T if ws else None)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of most pairs (ties: the larger margins), and its mean chance."""
        n = len(x)
        if not self.pairs:
            return np.zeros(n, int), np.ones(n)
        margins = x @ self.weights[:-1] + self.weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(4.0 * margins, -50, 50)))
        votes, sums = np.zeros((n, len(self.names))), np.zeros((n, len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += margins[:, k] >= 0
            votes[:, b] += margins[:, k] < 0
            sums[:, a] += chance[:, k]
            sums[:, b] += 1 - chance[:, k]
        best = np.argmax(votes + sums / (2 * len(self.names)), axis=1)
        return best, sums[np.arange(n), best] / (len(self.names) - 1)


@dataclass
class Model:
    families: Machines
    within: list[Machines]

    def predict(self, texts: list[str | None]) -> list[tuple[str, str | None, float]]:
        """(language, family, score) of each text."""
        out: list[tuple[str, str | None, float]] = [(UNKNOWN, None, 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.within else []
        for k in range(0, len(at), 256):
            some = at[k : k + 256]
            x = np.stack([features(texts[i]) for i in some])
            family, p = self.families.decide(x)
            for f in np.unique(family):
                own = np.flatnonzero(family == f)
                lang, q = self.within[f].decide(x[own])
                for j, row in enumerate(own):
                    out[some[row]] = (self.within[f].names[lang[j]], self.families.names[f], float(p[row] * q[j]))
        return out


def group_families(langs: list[str], means: dict[str, np.ndarray]) -> dict[str, list[str]]:
    table = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
    out: dict[str, list[str]] = {}
    for x in langs:
        if x in table:
            out.setdefault(table[x], []).append(x)
    for x in langs:
        if x not in table:
            open_ = [f for f in out if len(out[f]) < ROOM]
            near = max(open_, key=lambda f: max(float(means[x] @ means[o]) for o in out[f]), default=None)
            out.setdefault(near or x, []).append(x)
    return dict(sorted(out.items()))


def learnable() -> Column:
    """Labelled documents outside the held-out fifth."""
    return (F.crc32(F.col("doc_id").cast("string")) % 5 != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def fit(docs: DataFrame, may_learn: Column | None = None, sample: int = SAMPLE, most: int = ROWS) -> Model:
    """Learns from docs(doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    usable = docs.where(learnable() if may_learn is None else may_learn)
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).collect()  # a row for each language
    sample = min(sample, max(FEWEST, most // max(1, len(counts))))
    counts = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, 2 * sample / r["_n"]) * (1 << 30))) for r in counts], "lang string, least long")
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = usable.select("doc_id", "text", "lang", h.alias("h")).join(F.broadcast(counts), "lang").where(F.col("h") <= F.col("least"))  # a row for each language

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for lang, hashed, doc, text in zip(b["lang"], b["h"], b["doc_id"], b["text"]):
                if has_letter(text):
                    v = features(text)
                    at = np.flatnonzero(v).astype(np.uint16)
                    rows.append((lang, hashed, doc, at.tobytes() + v[at].tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "h", "doc_id", "v"])

    some = drawn.mapInPandas(read, "lang string, h long, doc_id long, v binary")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "v"))
    rows = some.withColumn("nth", nth).where(F.col("nth") <= sample).orderBy("lang", "nth").collect()  # sample rows a language at most
    x = np.zeros((len(rows), BINS), np.float32)
    for i, r in enumerate(rows):
        n = len(r["v"]) // 6
        x[i, np.frombuffer(r["v"], np.uint16, n)] = np.frombuffer(r["v"], np.float32, n, 2 * n)
    label = np.array([r["lang"] for r in rows], object)
    langs = sorted(set(label))
    if not langs:
        return Model(Machines([]), [])
    means = {}
    for lang in langs:
        m = x[label == lang].mean(axis=0)
        means[lang] = m / max(1e-12, float(np.sqrt(m @ m)))
    families = group_families(langs, means)
    names = list(families)
    of = {lang: i for i, f in enumerate(names) for lang in families[f]}
    top = Machines.fit(x, np.array([of[v] for v in label]), names)
    within = []
    for f in names:
        own = np.isin(label, families[f])
        within.append(Machines.fit(x[own], np.array([families[f].index(v) for v in label[own]]), families[f]))
    return Model(top, within)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, family for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # BINS floats for each pair of languages of a family

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = shared.value.predict(list(b["text"]))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"], "lang_pred": [g[0] for g in got], "score": [g[2] for g in got], "family": [g[1] for g in got]})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, family string")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """Rows of docs in which a language is recognised with a score of ``least`` or more, all columns as they were."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([-1.0 if g[0] == UNKNOWN else g[2] for g in shared.value.predict(list(texts))], dtype=float)

    return docs.where(score("text") >= least)
