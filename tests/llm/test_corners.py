"""Nulls in any column, empty and very long texts, repeated rows, empty tables, and further columns with clashing names."""

import hashlib
import random

import pytest

import corpus_pipeline
from citeforge.llm import decontaminate, language, mixing, near_dup, pii, secret_scan, suffix_dedup, token_count, topk, warc

CLASH = "found had _had _h _k _kinds kinds key node regs h low comp component_id kept size target taken shard begin end score held_out lang_pred family spans items n_hit n_words a b i j n hash place marks hot digest refers_to rank query_id vec part x gram text_id copied lost".split()
BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    schema = BASE + "".join(f", {c} string" for c in CLASH)
    return spark.createDataFrame([(*r, *(c + "!" for c in CLASH)) for r in rows], schema)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 8))) for _ in range(500)]
    say = lambda n: " ".join(rnd.choices(words, k=n))
    long, some = say(60_000), say(300)
    out = [(1, None, None, None, None), (None, None, "en", "s", 0), (2, "", "en", "s", 0), (None, some, "en", None, 9), (3, some, None, "s", None), (4, some, "de", "t", 9), (4, some, "de", "t", 9)]
    out += [(5, long, "en", "s", 1), (6, long + " token = abcdef99", "en", "s", 1), (7, "a", "en", "s", 1), (8, "\U0001f600 token=abcdef1", "en", "s", 16), (9, "x" * 50_000, "en", "s", 1)]
    return out + [(10 + i, say(40), ("en", "de")[i % 2], ("s", "t")[i % 2], 1) for i in range(20)]


KEY = b"a key for the tests"
BENCH = "item_id bigint, text string"


def count(df):
    return len(df.collect())


def test_operators_keep_rows(spark, rows):
    d = table(spark, rows)
    bench = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "not there at all but here it is as words")], BENCH)
    every = [
        lambda x: language.predict(x, language.fit(x)),
        lambda x: secret_scan.report(secret_scan.scan(x, column="spots"), "spots"),
        lambda x: pii.pseudonyms(x, KEY),
        suffix_dedup.dedup,
        mixing.mix,
        lambda x: decontaminate.report(decontaminate.scan(x, bench)),
        lambda x: decontaminate.report(decontaminate.scan(x, bench.limit(0))),
        near_dup.near_duplicates,
        suffix_dedup.remove,
        token_count.counts,
    ]
    for f in every:
        assert count(f(d)) == len(rows)
        assert count(f(d.limit(0))) == 0


def test_repeated_and_null_rows(spark, rows):
    d = table(spark, rows)
    near = near_dup.near_duplicates(d).collect()
    assert sorted(r["kept"] for r in near if r["doc_id"] == 4) == [False, False] and [r["component_id"] for r in near if r["doc_id"] == 6] == [5]
    assert all(r["kept"] and r["n_shingles"] == 0 for r in near if r["doc_id"] in (1, 2))
    cut = [r for r in suffix_dedup.dedup(d).collect() if r["doc_id"] == 4]
    assert len(cut) == 2 and all(r["n_removed"] == r["n_bytes"] and r["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in cut)
    spots = {r["doc_id"]: r["spans"] for r in secret_scan.report(secret_scan.scan(d, column="spots"), "spots").collect() if r["doc_id"] is not None}
    assert spots[8] == "assign:2:15" and spots[1] == "" and spots[6].startswith("assign:")
    tokens = {r["doc_id"]: r["n_tokens"] for r in token_count.counts(d).collect()}
    assert tokens[1] == tokens[2] == 0 and tokens[5] > 60_000
    assert {r["lang_pred"] for r in language.predict(d, language.fit(d)).collect() if r["doc_id"] in (1, 2)} == {"und"}


def test_stages_return_the_columns_of_documents(spark, rows):
    d = table(spark, rows)
    sf = "/root/testdata/sf0.001"
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, sf)
        left[name] = out.collect()
        if name != "mixing":
            assert out.columns == d.columns and out.dtypes == d.dtypes, name
        assert count(stage(spark, d.limit(0), sf)) == 0, name
    ids = lambda n: [r["doc_id"] for r in left[n]]
    assert not {1, 2} & set(ids("language_id")) and {5, 10, 29} <= set(ids("language_id"))
    assert {3, 5, 1, 2} <= set(ids("near_dup")) and not {4, 6} & set(ids("near_dup"))
    assert len(left["decontaminate"]) == len(left["secret_scan"]) == len(left["mixing"]) == len(rows)
    clean = {r["doc_id"]: r for r in left["secret_scan"]}
    assert clean[8]["text"] == "\U0001f600 [SECRET]" and clean[8]["n_chars"] == 10 and clean[1]["text"] is None and clean[8]["found"] == "found!" and clean[5]["n_chars"] == 1


def test_vectors(spark):
    v = [(0, [1.0, 2.0], "a"), (50, [1.0, 2.0], "a"), (50, [1.0, 2.0], "a"), (1, None, "a"), (2, [None, 1.0], None), (None, [1.0, 1.0], "a"), (3, [], "a"), (4, [1.0, 2.0], None), (5, [float("inf"), 0.0], "a"), (6, [0.5, 0.5], "a")]
    df = spark.createDataFrame([(*r[:2], *([r[2]] * 3)) for r in v], "vec_id bigint, embedding array<double>, score string, rank string, x string")
    got = [tuple(r) for r in topk.search(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    best = 256 * 256 * 5
    assert got == [(0, 1, 4, best), (0, 2, 50, best), (0, 3, 50, best), (0, 4, 6, 256 * 128 * 3)]
    again = [tuple(r) for r in topk.search(df, df.where("vec_id = 50")).orderBy("rank").collect()]  # two rows, one query
    assert again == [(50, 1, 0, best), (50, 2, 4, best), (50, 3, 6, 256 * 128 * 3)]
    clash = df.withColumnRenamed("rank", "query_id").withColumn("part", df.vec_id)
    assert count(topk.search(clash, clash.where("vec_id = 0"))) == 4
    assert count(topk.search(df.limit(0), df.limit(0))) == 0 and count(topk.search(df, df.limit(0))) == 0


def test_pages(spark):
    p = [(1, "u", "q" * 200, "d"), (1, "u", "q" * 200, "d"), (7, None, "q" * 200, None), (None, "u", "q" * 200, "d"), (8, "", None, "d"), (9, "u v\r\n", "\r\n\r\nWARC/1.1", "d"), (10, "u", "z" * 3_000_000, "d")]
    df = spark.createDataFrame([(*r[:3], r[3], r[3]) for r in p], "page_id bigint, url string, html string, digest string, refers_to string")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["url"]) for r in warc.read(warc.write(df)).collect()), key=str)
    want = [(1, "response", None, 200, "u")] * 2 + [(7, "revisit", 1, 200, None), (None, "response", None, 200, "u"), (8, "response", None, 0, ""), (9, "response", None, 12, "u v\r\n"), (10, "response", None, 3_000_000, "u")]
    assert got == sorted(want, key=str)


def test_near_duplicates_of_null_and_shared_ids(spark):
    rnd = random.Random(11)
    rows = []
    for k in range(12):  # 60 + k words: the number of shingles tells the groups apart
        ws = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(60 + k)]
        near = [[*ws[:-1], w] for w in ("x", "y", "z")]
        rows += [(100 + k, " ".join(ws)), (None, " ".join(near[0])), (None, " ".join(near[1])), (999, " ".join(near[2])), (None, " ".join(near[0]))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows) and {(r["n_shingles"], r["component_id"]) for r in got} == {(56 + k, 100 + k) for k in range(12)}


def test_many_rows_without_ids_and_with_one_id(spark):
    for doc in (None, 7):
        rows = [(doc, f"only {i} of many words here {i}") for i in range(1000)] + [(doc, "these are copies of each other") for _ in range(1000)]
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert len(got) == 2000 and {r["component_id"] for r in got} == {doc} and {r["kept"] for r in got} == {True}
