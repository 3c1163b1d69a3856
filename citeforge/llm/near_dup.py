"""Near-duplicate documents: SetSketch registers, banded, estimated jointly by likelihood, verified on full sets.

A document's set holds the hashes of its distinct ``SHINGLE``-word shingles (words: runs without ASCII white
space, A-Z lowered; fewer words: the whole sequence as one). Its sketch has M registers floor(1 - log_B x), x the
least of Exp(A) values that the elements draw for that register (A value of each element's own Poisson stream
is skipped once it exceeds all registers): mergeable by maxima, and equal with a chance just above the similarity.

1. Documents with equal sets form one node, reduced before anything is dealt by it; copies never multiply what follows.
2. BANDS bands of ROWS registers deal nodes into buckets. At the threshold of 0.75 a pair shares no bucket with a
   chance of (1 - 0.75**5)**51 = 1e-6. A node is first paired with
   the least of all nodes that it meets, then, where that left the two in different components, with each bucket's least.
3. Pairs whose registers make a similarity of the threshold a factor of e**18 less likely than the likeliest one are
   let go (some six standard errors); the rest are verified on the full sets; verified links give components.
4. In buckets that still hold more than one component, the least node aside, all nodes meet those outside the bucket's
   largest component, in blocks: first by registers alone (2 * WIDE nodes at most), which leaves the nodes that may have
   a partner in another component, then those with their texts (2 * BLOCK). A pair is looked at only in the first band that it
   shares, and a block emits no more links than join its components, so no link hides behind a bucket's least node.

No bucket is capped. Hot buckets, copies and components meet only in partial aggregates or in joins of staged tables, which AQE splits.
Sketches of parts of a set merge by merged(), as registers are maxima.

Null text, or one without words: the empty set, linked with nothing, its own component. Null doc_id: may link, is
never a component's id unless it is alone. Rows that share a doc_id are told apart by their sets; equal rows are kept
both. An empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, discard, lanes, mix64, small_batches, staged, text_id, word_hashes
from .components import components

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 51, 5
M, A, B, TOP = BANDS * ROWS, 20.0, 1.001, 65535
GIVE_UP = 18.0
BLOCK, WIDE = 1024, 2048
SKETCH = "doc_id long, text_id binary, n_shingles long, node long, regs binary"


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    each = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())  # bytes: ASCII only
    if not len(each):
        return each
    k = min(SHINGLE, len(each))
    out = np.full(len(each) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * U64(0x9FB21C651E98DF25) + each[j : len(each) - k + 1 + j]
    return np.unique(mix64(out))


def node_of(hashes: np.ndarray) -> int:
    """64 bits that name a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of several sets, a row of M registers each."""
    n = len(sets)
    least = np.full(n * M, np.inf)
    h = np.concatenate(sets) if n else np.empty(0, np.uint64)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    at = np.zeros(len(h))
    draw = 0
    while len(h):
        draw += 1
        u = mix64(h + U64(draw * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log1p(-(u >> U64(11)).astype(np.float64) * 2.0**-53) / (A * M)
        np.minimum.at(least, of * M + (u & U64(0x7FF)).astype(np.int64) % M, at)
        if draw < 4 or draw % 4 == 0:
            alive = at < least.reshape(n, M).max(axis=1)[of]
            if not alive.all():
                h, of, at = h[alive], of[alive], at[alive]
    k = np.zeros(n * M)
    drawn = np.isfinite(least)
    k[drawn] = np.floor(1 - np.log(np.maximum(least[drawn], 1e-300)) / np.log(B))
    return np.clip(k, 0, TOP).astype(">u2").reshape(n, M)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketches of the unions of sets, from those of their parts."""
    return np.maximum(a, b)


def log_likelihood(j: np.ndarray, nu: np.ndarray, nv: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Of similarity j, given how many of the M registers of u are above and below those of v, and both set sizes."""
    u, v = nu / (nu + nv), nv / (nu + nv)
    p = lambda x: -np.log1p(-np.clip(x, 0.0, 1.0) * (B - 1) / B) / np.log(B)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    return above * log(up) + below * log(down) + (M - above - below) * log(1 - up - down)


def plausible(ru: np.ndarray, rv: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Which pairs (rows) may be as similar as the threshold."""
    above, below = (ru > rv).sum(axis=1), (ru < rv).sum(axis=1)
    top = np.minimum(nu, nv) / np.maximum(nu, nv)  # no similarity exceeds the ratio of sizes
    grid = np.linspace(0, 1, 17)[:, None]
    ll = log_likelihood(grid * top, nu, nv, above, below)
    t = PERCENT / 100
    at = log_likelihood(np.minimum(top, t + np.linspace(0, 1, 5)[:, None] * np.maximum(top - t, 0)), nu, nv, above, below)
    return (100 * np.minimum(nu, nv) >= PERCENT * np.maximum(nu, nv)) & (ll.max(axis=0) - at.max(axis=0) <= GIVE_UP)


def sketch(docs: DataFrame) -> DataFrame:
    """SKETCH rows, one for each of docs(doc_id, text)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            for at in range(0, len(t), 512):  # 255 registers of 8 bytes a set while they are drawn
                b = t.iloc[at : at + 512]
                sets = [shingles(x) for x in b["text"]]
                regs = registers(sets)
                yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").array, "text_id": b["text_id"].array, "n_shingles": [len(s) for s in sets], "node": [node_of(s) for s in sets], "regs": [r.tobytes() for r in regs]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_id(F.col("text")).alias("text_id")).mapInPandas(run, SKETCH)


def _decode(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), ">u2").astype(np.uint16).reshape(len(column), M)


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that the likelihood of their registers lets through."""
    own = lambda s: nodes.select(F.col("node").alias(s), F.col("regs").alias(f"r{s}"), F.col("n_shingles").alias(f"n{s}"))
    small_batches(pairs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            if len(t):
                t = t[plausible(_decode(t["ra"]), _decode(t["rb"]), t["na"].to_numpy(float), t["nb"].to_numpy(float))]
            yield t[["a", "b"]]

    return pairs.join(own("a"), "a").join(own("b"), "b").mapInPandas(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold. texts: (node, text), a row for each node."""
    small_batches(pairs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            ok, cache = [], {}
            for a, ta, b, tb in zip(t["a"], t["ta"], t["b"], t["tb"]):
                if b not in cache:
                    cache = {b: shingles(tb)}
                x, y = shingles(ta), cache[b]
                if node_of(x) != a or node_of(y) != b:
                    raise ValueError(f"the texts of nodes {a}, {b} do not have their sets")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield t.loc[np.array(ok, bool), ["a", "b"]]

    own = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"t{s}"))
    return pairs.join(own("a"), "a").join(own("b"), "b").mapInPandas(run, "a long, b long")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text), a row for each of nodes(node, text_id, ..); the corpus is shuffled once, copies reduced before that, by one plan at any size."""
    named = docs.select(text_id(F.col("text")).alias("text_id"), "text").groupBy("text_id").agg(F.any_value("text").alias("text"))
    return staged(named.join(nodes.select("node", "text_id").hint("merge"), "text_id").select("node", "text"), "near-texts")


class _Block:
    """Nodes that meet in a block: all ``home`` ones with all others in another component, each pair in the first band that it shares."""

    def __init__(self, rows: list[tuple]):
        """rows: (home, node, comp, n_shingles, regs)."""
        self.rows, self.regs, self.n = {}, {}, {}
        home, rest = {}, {}
        for h, node, comp, n, regs in rows:
            (home if h else rest)[node] = comp
            self.rows[node] = (n, regs)
        self.home, self.rest = list(home), list(rest)
        number = {c: i for i, c in enumerate({*home.values(), *rest.values()})}
        self.home_comp, self.rest_comp = (np.array([number[c] for c in x.values()], np.int64) for x in (home, rest))
        read = lambda ks: np.frombuffer(b"".join(self.rows[k][1] for k in ks), ">u2").astype(np.uint16).reshape(len(ks), M)
        self.home_regs, self.rest_regs = read(self.home), read(self.rest)
        self.home_n, self.rest_n = (np.array([self.rows[k][0] for k in ks], float) for ks in (self.home, self.rest))
        every = np.concatenate((self.home_regs, self.rest_regs))
        self.band = int((every == every[0]).reshape(len(every), BANDS, ROWS).all(axis=(0, 2)).argmax())

    def partners(self, home_comp: np.ndarray, rest_comp: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each home node (its place), the places in ``rest`` of its plausible partners in another component, as they are by then."""
        for i in range(len(self.home)):
            y = np.flatnonzero((rest_comp != home_comp[i]) & (100 * np.minimum(self.rest_n, self.home_n[i]) >= PERCENT * np.maximum(self.rest_n, self.home_n[i])))
            if len(y):
                earlier = (self.rest_regs[y, : self.band * ROWS] == self.home_regs[i, : self.band * ROWS]).reshape(len(y), self.band, ROWS).all(axis=2).any(axis=1)
                y = y[~earlier]
            if len(y):
                y = y[plausible(np.broadcast_to(self.home_regs[i], (len(y), M)), self.rest_regs[y], np.full(len(y), self.home_n[i]), self.rest_n[y])]
            if len(y):
                yield i, y

    def open(self) -> set[int]:
        """Nodes that may have a partner in another component."""
        out: set[int] = set()
        for i, y in self.partners(self.home_comp, self.rest_comp):
            out.add(self.home[i])
            out.update(self.rest[k] for k in y.tolist())
        return out

    def links(self, sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        """Verified links that join the components; a pair is compared only while it is apart."""
        home_comp, rest_comp, out = self.home_comp.copy(), self.rest_comp.copy(), []
        for i, y in self.partners(home_comp, rest_comp):
            x = self.home[i]
            mine, others = sets[x], [sets[self.rest[k]] for k in y]
            every = np.concatenate(others)
            at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
            both = np.add.reduceat((mine[at] == every).astype(np.int64), np.concatenate(([0], np.cumsum([len(o) for o in others])[:-1])))
            for k, n in zip(y.tolist(), both.tolist()):
                z, gone = self.rest[k], rest_comp[k]
                if gone != home_comp[i] and 100 * n >= PERCENT * (len(mine) + len(sets[z]) - n):
                    out.append((max(x, z), min(x, z)))
                    for c in (home_comp, rest_comp):
                        c[c == gone] = home_comp[i]
        return out


def _blocked(placed: DataFrame, nodes: DataFrame, block: int) -> DataFrame | None:
    """Rows (key, i, j, home, node, comp, n_shingles, regs) of the blocks of buckets with several components, from (key, node, comp).

    All nodes of a bucket are dealt over chunks i, and those outside its largest component over chunks j; None: no such bucket.
    """
    size = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
    mixed = staged(size.where("n > top.n").select("key", F.col("top.comp").alias("major"), F.ceil(F.col("n") / block).alias("wide"), F.ceil((F.col("n") - F.col("top.n")) / block).alias("deep")), "near-mixed")
    if mixed.isEmpty():
        discard(mixed)
        return None
    every = staged(placed.join(mixed, "key"), "near-open")
    discard(mixed)
    chunk = lambda of: F.pmod(F.xxhash64("node"), F.col(of))
    up_to = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    own = ["node", "comp"]
    home = every.select("key", chunk("wide").alias("i"), up_to("deep").alias("j"), F.lit(True).alias("home"), *own)
    rest = every.where("comp <> major").select("key", up_to("wide").alias("i"), chunk("deep").alias("j"), F.lit(False).alias("home"), *own)
    return home.unionByName(rest).join(nodes.select("node", "n_shingles", "regs"), "node")


def _per_block(rows: DataFrame, judge, schema: str, *more: str) -> DataFrame:
    """judge((key, home, node, comp, n_shingles, regs, *more) rows of a block) for each block, one at a time."""
    small_batches(rows.sparkSession)
    keys = ["key", "i", "j"]
    columns = ["home", "node", "comp", "n_shingles", "regs", *more]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        done = lambda: pd.DataFrame(judge(at[0], held) if len(held) > 1 else [], columns=names, dtype="int64")
        for t in batches:
            for key, i, j, *row in zip(*(t[c] for c in (*keys, *columns))):
                if (key, i, j) != at:
                    yield done()
                    at, held = (key, i, j), []
                held.append(tuple(row))
        yield done()

    return rows.repartition(lanes(rows.sparkSession), *keys).sortWithinPartitions(*keys).select(*keys, *columns).mapInPandas(run, schema)


def _across(placed: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links (a, b) between components that share a bucket, from (key, node, comp); None: there is nothing to compare."""
    if (rows := _blocked(placed, nodes, WIDE)) is None:
        return None
    may = staged(_per_block(rows, lambda key, held: [(key, k) for k in _Block(held).open()], "key long, node long").distinct(), "near-may")
    rows = _blocked(placed.join(may, ["key", "node"]), nodes, BLOCK)
    discard(may)

    def linked(key: int, held: list[tuple]) -> list[tuple[int, int]]:
        sets = {}
        for _, node, _, _, _, text in held:
            if node not in sets:
                sets[node] = shingles(text)
        return _Block([r[:5] for r in held]).links(sets)

    return None if rows is None else _per_block(rows.join(texts, "node"), linked, "a long, b long", "text").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs(doc_id, text)."""
    docs = docs.select("doc_id", "text")
    every = staged(sketch(docs), "near-sketches")
    full = every.where("n_shingles > 0")
    # a row for each set, before anything is dealt by what the copies have in common
    alone = staged(full.groupBy("node").agg(F.min(F.struct("n_shingles", "text_id", "regs")).alias("row")).select("node", "row.*"), "near-alone")
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("regs"), i * (2 * ROWS) + 1, 2 * ROWS)))
    bands = alone.select("node", F.explode(keys).alias("key"))
    buckets = staged(bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key", "low"), "near-buckets")
    members = staged(bands.join(buckets, "key").where("node <> low"), "near-members")
    met = members.select("node").unionByName(members.select(F.col("low").alias("node"))).distinct()
    nodes = staged(alone.join(met, "node"), "near-nodes")
    texts = _texts(docs, nodes)
    comps = staged(nodes.select("node", F.col("node").alias("comp")), "near-comps")

    def join_up(new: DataFrame) -> None:
        """Joins components by verified links: only the links between components count."""
        nonlocal comps
        of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
        found = staged(new, "near-links")
        if not found.isEmpty():
            joined = components(found.join(of("a"), "a").join(of("b"), "b").where("comp_a <> comp_b"), "comp_a", "comp_b")
            up = joined.select(F.col("node").alias("comp"), F.col("comp").alias("least"))
            old, comps = comps, staged(comps.join(up, "comp", "left").select("node", F.coalesce("least", "comp").alias("comp")), "near-comps")
            discard(old)
        discard(found)

    def confirm(pairs: DataFrame) -> None:
        likely = staged(_estimated(pairs, nodes), "near-likely")
        join_up(_verified(likely, texts))
        discard(likely)

    # first the least of all the nodes that it meets; then, where that left them apart, the least one of each bucket
    confirm(members.groupBy(F.col("node").alias("a")).agg(F.min("low").alias("b")))
    lows = comps.select(F.col("node").alias("low"), F.col("comp").alias("low_comp"))
    apart = members.join(comps, "node").join(lows, "low").where("comp <> low_comp")
    confirm(apart.select(F.col("node").alias("a"), F.col("low").alias("b")).distinct())

    # buckets that hold more than one component beside their least node, which all others have met
    placed = staged(members.join(comps, "node").select("key", "node", "comp"), "near-placed")
    if (more := _across(placed, nodes, texts)) is not None:
        join_up(more)

    thin = full.select("doc_id", "n_shingles", "node")
    grouped = staged(thin.join(comps, "node", "left").select("doc_id", "n_shingles", F.coalesce("comp", "node").alias("comp")), "near-grouped")
    first = staged(grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "near-first")
    out = grouped.join(first, "comp").select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(every.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    discard(alone, buckets, members, nodes, texts, placed)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without those that are near-duplicates of one with a smaller doc_id; all columns as they were.

    A row goes with its doc_id: rows that repeat go or stay together, rows without a doc_id stay.
    """
    dropped = staged(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "near-dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
