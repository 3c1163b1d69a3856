"""Results that must not depend on sizes or shared ids: pieces of a benchmark, many languages, many null ids, edits that cannot be applied."""

import random
from collections import Counter

import pytest

from citeforge.llm import decontaminate, language, mixing, token_count


def test_spans_are_cut_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7), (2, None, 7), (3, "x y", 7), (4, "", 7)], "doc_id bigint, text string, hits int")
    bench = spark.createDataFrame([(1, "b c"), (2, "c d"), (3, "a d")], "item_id bigint, text string")
    got = [decontaminate.remove_spans(docs, bench, 2, most).orderBy("doc_id").collect() for most in (100, 4, 2)]
    assert [r["text"].split() if r["text"] else r["text"] for r in got[0]] == [["a", "e", "f"], None, ["x", "y"], ""]
    assert got[0] == got[1] == got[2] and got[0][0]["hits"] == 7


def test_two_hundred_languages(spark):
    rnd = random.Random(8)
    rows = []
    for k in range(200):
        words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(3, 7))) for _ in range(12)]
        rows += [(40 * k + i, " ".join(rnd.choices(words, k=60)), f"l{k:03d}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    model = language.fit(df)
    names = [n for m in model.within for n in m.names]
    assert len(names) == len(set(names)) == 200 and max(len(m.names) for m in model.within) <= language.ROOM
    assert sum(m.weights.nbytes for m in [model.families, *model.within] if m.weights is not None) < 60 << 20
    held = language.predict(df, model).where("held_out").join(df, "doc_id").collect()
    assert len(held) > 1000 and sum(r["lang"] == r["lang_pred"] for r in held) > 0.85 * len(held)


def test_rows_without_an_id_are_dealt_over_shards(spark):
    rows = [(None if i % 2 else 5, f"word{i} and others", "s") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df, shard_docs=64).collect()
    shards = -(-4000 // 64)  # each lacks what its last block does
    assert len(got) == 4000 and abs(sum(r["taken"] for r in got) - 12000) <= shards * mixing.BLOCK
    assert df.select((mixing.seeded(*[df[c].cast("string") for c in ("doc_id", "text")]) % 63).alias("s")).distinct().count() == 63


EDITS = [
    (0, None, 4, "x"), (0, 1, None, "x"), (0, 5, 3, "x"), (0, -1, 2, "x"), (0, 9, 99, "x"),  # none of them can be applied
    (1, 0, 5, "x"), (1, 3, 8, "y"), (1, 5, 6, None), (1, 11, 11, "!"), (1, 11, 11, "?"),
]


def test_edits_that_cannot_be_applied(spark):
    docs = spark.createDataFrame([(0, "a b c d e f"), (1, "a b c d e f"), (None, "z")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in token_count.edited(token_count.trees(docs), spark.createDataFrame([*EDITS, (None, 0, 1, "null")], token_count.EDIT)).collect()}
    text = {k: "".join(r["leaves"]) for k, r in got.items()}
    assert text == {0: "a b c d e f", 1: "xd e f!?", None: "null"}
    assert [(got[k]["n_edits"], got[k]["n_rejected"]) for k in (0, 1, None)] == [(0, 5), (4, 1), (1, 0)]
    enc = token_count.encoding(token_count.load_ranks())
    assert all(got[k]["n_tokens"] == len(enc.encode_ordinary(t)) for k, t in text.items())


def test_vocabularies_of_one_size_are_told_apart():
    ranks = token_count.load_ranks()
    (a, x), (b, y) = list(ranks.items())[300:302]
    other = dict(ranks, **{}) | {a: y, b: x}
    assert token_count.encoding(ranks) is token_count.encoding(dict(ranks)) and token_count.encoding(other) is not token_count.encoding(ranks)
    assert token_count.encoding(ranks).encode_ordinary(a.decode()) == [x] and token_count.encoding(other).encode_ordinary(a.decode()) == [y]


@pytest.mark.parametrize("seed", range(3))
def test_stretches_of_a_tree(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choices("ab 1.é\n", k=3000))
    tree = token_count.TokenTree(text, lambda ps: [len(p) for p in ps], 64)
    for _ in range(50):
        a, b = sorted(rnd.choices(range(3001), k=2))
        assert tree.between(a, b) == text[a:b]
    assert Counter(tree.leaves)[""] == 0
