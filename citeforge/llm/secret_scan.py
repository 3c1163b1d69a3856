"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams: an alternative (a set of trigrams that must all
occur) for each way to match. The index posts every trigram that some query asks for to the documents which
contain it; a document is a candidate for a rule if it occurs in all posting lists of one alternative. Candidates
are then verified by the regex itself. Rules without mandatory trigrams scan every text fully.

Spans are [start, end) in code points. Per kind, matches are leftmost and do not overlap; those that fail the
rule's least length are dropped (and still consume what they matched). The three base kinds are ``assign``,
``access`` and ``hex``; further kinds add private key blocks, tokens by their prefix, and passwords in URLs.

Null text counts as empty (and stays null in what is handed on). Rows are told apart by doc_id and a hash of the text,
so rows that repeat get equal results; null ids are kept. Empty tables give empty results. Other columns pass through,
whatever their names: ``scan`` takes the name of the column that it adds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name


@dataclass(frozen=True)
class Rule:
    """``group``: what must have ``least`` characters. The regex must read alike in Java, RE2 and Python.

    ``java``: the same regex with possessive groups, which Java runs through without a stack frame for each round; only
    where a round that is given back could not lead to a match.
    """

    kind: str
    regex: str
    least: int = 0
    group: int = 0
    java: str = ""


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: From BEGIN to the next END if no other line of five hyphens comes between (headers may have single ones); without
#: END, header lines and a body that begins with 16 characters of base64, up to the first that is none and no white space.
_NAME = r"[A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
#: No run of 16 letters, so a header line is never the beginning of a body.
_HEADER = r"[\x20\t\r\n]*[A-Z][A-Za-z]{0,14}(?:-[A-Za-z]{1,15})*:[^\n]*\n"
KEY = rf"-----BEGIN {_NAME}(?:[^-]*(?:-{{1,4}}[^-]+)*-----END {_NAME}|(?:{_HEADER})*[\x20\t\r\n\\nr]*[A-Za-z0-9+/=]{{16}}[A-Za-z0-9+/=\x20\t\r\n\\]*|)"
MORE = (
    Rule("key", KEY, java=KEY.replace(")*", ")*+")),
    Rule("prefix", r"(?:ghp_|gho_|github_pat_|glpat-|xoxb-|xoxp-|sk_live_|rk_live_)[A-Za-z0-9_-]+", 20),
    Rule("url", r"[a-z][a-z0-9]{1,11}://[^\x00-\x20/:@\x22<>]*:[^\x00-\x20/:@\x22<>]+@"),
)
RULES = BASE + MORE
MOST_WAYS = 64


# --- regex to Boolean trigram query ---


def _cross(a: set[str] | None, b: set[str] | None) -> set[str] | None:
    if a is None or b is None or len(a) * len(b) > MOST_WAYS:
        return None
    return {x + y for x, y in product(a, b)}


def _ways(nodes) -> list[tuple[set[str] | None, list[list[set[str]]]]]:
    """One (exact strings or None, pieces) for each node of a sequence."""
    out: list[set[str] | None] = []
    for kind, arg in nodes:
        if kind is op.LITERAL:
            out.append({chr(arg).lower()})
        elif kind is op.IN and all(k is op.LITERAL for k, _ in arg) and len(arg) <= 4:
            out.append({chr(v).lower() for _, v in arg})
        elif kind is op.SUBPATTERN:
            out += _ways(arg[3])
        elif kind is op.BRANCH:
            # alternatives: exact if each is a plain string, else the strings that each must contain
            both = [_exact_runs(b) for b in arg[1]]
            if all(len(runs) == 1 and whole for runs, whole in both):
                out.append(set().union(*(runs[0] for runs, _ in both)))
            else:
                out.append(None)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, sub = arg
            runs, whole = _exact_runs(sub)
            if whole and len(runs) == 1 and high <= 1:
                out.append(runs[0] | ({""} if low == 0 else set()))
            elif low >= 1 and whole and len(runs) == 1 and low == high <= 8:
                out += [runs[0]] * low
            else:
                out.append(None)
        elif kind is op.AT:
            continue
        else:
            out.append(None)
    return out


def _exact_runs(nodes) -> tuple[list[set[str]], bool]:
    """Runs of strings that every match contains, one of each set; and whether the single run is all of it."""
    runs, cur, whole = [], {""}, True
    for way in _ways(nodes):
        longer = None if way is None else _cross(cur, way)
        if longer is None:
            if cur != {""}:
                runs.append(cur)
            cur, whole = (way if way is not None and len(way) <= MOST_WAYS else {""}), False
        else:
            cur = longer
    if cur != {""} or not runs:
        runs.append(cur)
    return runs, whole


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of trigrams that must all occur in a matching text (letters folded); [] if there are none."""
    runs, _ = _exact_runs(parser.parse(regex))
    best: list[frozenset[str]] = []
    for run in runs:  # every run is mandatory; the most telling one that has trigrams in each of its strings is asked for
        grams = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run]
        if all(grams) and all(ord(c) < 128 for s in run for c in s) and (not best or min(map(len, grams)) > min(map(len, best))):
            best = grams
    return sorted({g for g in best if not any(o < g for o in best)}, key=sorted)


# --- index and candidates ---


def _whole() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def postings(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """key, text_hash, gram: which of the wanted trigrams each text contains."""
    folded = docs.select("doc_id", F.xxhash64(_whole()).alias("text_hash"), F.lower(_whole()).alias("folded"))
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in sorted(wanted)]))
    return folded.select("doc_id", "text_hash", F.explode(found).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame | None, set[str]]:
    """(doc_id, text_hash, kinds) of documents to verify by the index, and the kinds that it covers."""
    spark = docs.sparkSession
    terms = [(r.kind, i, g, len(alt)) for r in rules for i, alt in enumerate(trigram_query(r.regex)) for g in sorted(alt)]
    if not terms:
        return None, set()
    literals = [F.struct(*[F.lit(v).alias(c) for v, c in zip(t, ("kind", "way", "gram", "need"))]) for t in terms]
    query = spark.range(1).select(F.inline(F.array(*literals)))  # some dozens of rows
    hits = postings(docs, sorted({t[2] for t in terms})).join(F.broadcast(query), "gram")
    # the intersection of posting lists: a document that all trigrams of an alternative post to
    whole = hits.groupBy("doc_id", "text_hash", "kind", "way").agg(F.count_distinct("gram").alias("n"), F.max("need").alias("need")).where("n = need")
    return whole.groupBy("doc_id", "text_hash").agg(F.collect_set("kind").alias("kinds")), {t[0] for t in terms}


# --- verification ---


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, also within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)


def _before(xs: Column, start: Column) -> Column:
    """start plus the sum of all values before each one."""
    zero = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(xs, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])


def _running(lengths: Column, block: int = 256) -> Column:
    """Sums of all values before each one; in two levels, so that long arrays take no quadratic time."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")), lambda b: F.slice(lengths, b * block + 1, F.lit(block)))

    def placed(p: Column) -> Column:
        starts = _before(F.transform(p, _total), F.lit(0).cast("long"))
        return F.flatten(F.zip_with(p, starts, _before))

    return _let(parts, placed)


def matches(text: Column, rule: Rule) -> Column:
    """Sorted array of structs (start, end) of a rule's matches."""
    own = rule.java or rule.regex
    found = F.regexp_extract_all(text, F.lit(own), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(own), F.lit(rule.group)) if rule.group else found
    read = F.struct(F.split(text, own).alias("gaps"), found.alias("found"), measured.alias("measured"))

    def sizes(r: Column) -> Column:
        triples = F.zip_with(F.zip_with(F.slice(r["gaps"], 1, F.size(r["found"])), r["found"], lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("size"))), r["measured"], lambda x, m: F.struct(x["gap"], x["size"], (F.length(m) >= rule.least).alias("ok")))
        return _let(triples, spans)

    def spans(t: Column) -> Column:
        starts = _running(F.transform(t, lambda x: x["gap"] + x["size"]))
        placed = F.zip_with(t, starts, lambda x, at: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), x["ok"].alias("ok")))
        return F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["end"]))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.when(text.rlike(own), _let(read, sizes)).otherwise(none)


def _quick(rule: Rule) -> str:
    """The rule with its least length in the regex where that cannot change which matches there are."""
    if rule.group == 0 and rule.least and rule.regex.endswith("]+"):
        head = rule.regex[: rule.regex.rindex("[")]
        return f"{rule.regex[:-1]}{{{max(1, rule.least - len(head))},}}" if re.fullmatch(r"\w*", head) else rule.regex
    return rule.regex


def _labelled(spans: Column, nth: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], F.lit(nth).alias("nth"), s["end"], F.lit(kind).alias("kind")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, column: str = "found") -> DataFrame:
    """docs with an array of structs (start, end, nth, kind) ``column``, sorted by start and then by the order of rules."""
    if column in docs.columns:
        raise ValueError(f"docs have a column {column!r}; name another one")
    index, covered = candidates(docs, rules)
    h, k, marked = (free_name([*docs.columns, column], n) for n in ("_h", "_k", "_kinds"))
    kinds = F.lit(None).cast("array<string>")
    named = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    scanned = docs
    if index is not None:
        keyed = docs.withColumns({h: F.xxhash64(_whole()), k: named(F.col("doc_id"))})
        index = index.select(named(F.col("doc_id")).alias(k), F.col("text_hash").alias(h), F.col("kinds").alias(marked))
        scanned, kinds = keyed.join(index, [k, h], "left"), F.col(marked)
    every = []
    for nth, rule in enumerate(rules):
        quick = Rule(rule.kind, _quick(rule), rule.least, rule.group, rule.java)
        spans = _labelled(matches(_whole(), quick), nth, rule.kind)
        if rule.kind in covered:
            spans = F.when(F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)), spans).otherwise(F.array().cast("array<struct<start:bigint,nth:int,end:bigint,kind:string>>"))
        every.append(spans)
    return scanned.select(*[scanned[c] for c in docs.columns], F.array_sort(F.concat(*every)).alias(column))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame, column: str = "found") -> DataFrame:
    """The digest columns of scan()."""
    of = lambda kind: F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(column, lambda s: s["nth"] < len(BASE))
    return found.select(
        F.col("doc_id"), *[of(r.kind).alias(f"n_{r.kind}") for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col(column)).alias("spans")
    )


def redact(found: DataFrame, mark: str = "[SECRET]", column: str = "found") -> DataFrame:
    """Result of scan() with every span in ``text`` replaced by ``mark`` (overlapping spans by one); drops ``column``."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark))).alias("out")),
    ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    text = F.aggregate(column, zero, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    return found.withColumn("text", F.when(F.size(column) > 0, text).otherwise(F.col("text"))).drop(column)
