"""Operators 11 to 13 against brute force: whole-text encodings, pairs of overlapping tokens, counted phrases, exact round trips."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from citeforge.llm import alignment, collocation, encoders, token_files

ODD = [" ", "  ", "\n", "\n ", "\t", "\t  ", "\r\n", "'s", "a", "Word", "é", "12", ".", ",", "…", " ", "　", "▁", "\x1c", "\x00", "<|endoftext|>", "<s>", "😀", "日本", "’t", "ﬁ", "the end", " of the day"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    out = ["".join(rnd.choices(ODD, k=rnd.randrange(0, 14))) for _ in range(150)]
    return [None, "", *out, "x" * 3000, " ".join(rnd.choices(["alpha", "beta,", "gamma.", "delta"], k=4000)), *["The same text twice."] * 3]


def frame(spark, texts, ids=None, extra=False):
    rows = [((ids[i] if ids else i), t, "en" if i % 3 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return df.selectExpr("*", "doc_id AS row", "text AS a", "1 AS n", "lang AS word", "2 AS h") if extra else df


def whole(e, text):
    given = " " + text if e.lead else text
    return e.vocabulary.encode([given])[0].tolist() if given else []


def test_encoders(texts):
    for e in (encoders.Encoder(encoders.ByteLevel(), True), encoders.Encoder(encoders.Pieces(), True), encoders.Encoder(encoders.ByteLevel(special=True), False, kept=5, short=2)):
        for part in (texts[2:80], texts[80:]):
            ids, counts, sound = e.encode(part)
            for t, own, ok in zip(part, np.split(ids, np.cumsum(counts)[:-1]), sound):
                assert own.tolist() == whole(e, t), repr(t)
                assert ok == (b"".join(e.vocabulary.bytes[i] for i in own) == ((" " if e.lead else "") + t).encode())
    assert sum("<|endoftext|>" in (t or "") and 50256 in whole(e, t) for t in texts) > 3  # the library's default
    assert e.encode([])[0].tolist() == []


def aligned(texts):
    one, two = encoders.Encoder(encoders.ByteLevel(), True), encoders.Encoder(encoders.Pieces(), True)
    docs, count = [], Counter()
    for t in texts:
        a, b = (whole(e, t) if t else [] for e in (one, two))
        ba, bb = ([e.vocabulary.bytes[i] for i in ids] for e, ids in ((one, a), (two, b)))
        if not t or b"".join(ba) != b"".join(bb) or b"".join(ba) != (" " + t).encode():
            docs.append(None)
            continue
        ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
        ea, eb = ends(ba), ends(bb)
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if max(ea[i] - len(ba[i]), eb[j] - len(bb[j])) < min(ea[i], eb[j])] if len(a) < 700 else None
        if links is None:  # long texts: neighbours only
            links, i, j = [], 0, 0
            while i < len(a) and j < len(b):
                links.append((a[i], b[j]))
                x, y = ea[i], eb[j]
                i, j = i + (x <= y), j + (y <= x)
        cuts = sorted(set(ea) & set(eb))
        groups = [([x for x, e in zip(a, ea) if p < e <= q], [x for x, e in zip(b, eb) if p < e <= q]) for p, q in zip([0, *cuts], cuts)]
        count.update(links)
        docs.append((len(a), len(b), groups, links))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((na, nb, len(groups), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_alignment(spark, texts):
    expected = aligned(texts)
    for head in (alignment.HEAD, 60, 0):  # all pairs are broadcast, some, none
        got = sorted(map(tuple, alignment.align(frame(spark, texts, extra=True), head=head).collect()))
        assert [g[1:] for g in got] == expected
    same = alignment.align(frame(spark, texts, ids=[None if i % 2 else 7 for i in range(len(texts))]))
    assert sorted(tuple(r)[1:] for r in same.collect()) == sorted(expected)
    assert alignment.align(frame(spark, [])).count() == 0


def mined(rows, least, keep):
    count, total = {}, Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = lang or "und"
        for c in ".,;:!?\x0a\x0b\x0c\x0d":
            text = (text or "").replace(c, "\n")
        for piece in text.translate(lower).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    k = (lang, *words[i : i + n])
                    count[k] = count.get(k, 0) + 1
    often = {k: n for k, n in count.items() if len(k) > 2 and n >= least}
    out = []
    for k, a in often.items():
        lang, words = k[0], k[1:]
        inside = lambda o: any(o[1 + i : 1 + i + len(words)] == words for i in range(len(o) - len(words)))
        if any(o[0] == lang and len(o) > len(k) and 100 * f >= 80 * a and inside(o) for o, f in often.items()):
            continue
        cuts = [(2_000_000 * a // (count[(lang, *words[:i])] + count[(lang, *words[i:])]), i) for i in range(1, len(words))]
        score, i = min(cuts)
        out.append((lang, " ".join(words), a, count[(lang, *words[:i])], count[(lang, *words[i:])], total[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked = [(r[0], sum(o[0] == r[0] for o in out[: i + 1]), *r[1:]) for i, r in enumerate(out)]
    return [r for r in ranked if r[1] <= keep]


def test_collocations(spark):
    rnd = random.Random(9)
    words = ["New", "york", "CITY", "é", "ü x", "the", "of", "in", "\x00", "Ärger", "state"]
    texts = []
    for _ in range(60):
        parts = [" ".join(rnd.choices(words, weights=[5, 5, 3, 1, 1, 9, 6, 4, 1, 1, 1], k=rnd.randrange(0, 30))) for _ in range(6)]
        texts.append("".join(p + rnd.choice([". ", "\t", "\n", "! ", "  ", "\x0b", "; new york city of the "]) for p in parts) + f" w{rnd.randrange(9)}")
    texts += [None, "", " .,;", "the of " * 2000, *texts[:5]]
    rows = [(t, "en" if i % 3 else None) for i, t in enumerate(texts)]
    expected = mined(rows, 8, 40)
    assert len(expected) > 40 and len({r[0] for r in expected}) == 2
    df = frame(spark, texts, extra=True)
    for head, held in ((collocation.HEAD, 10**6), (4, 50), (0, 10**6)):  # every word is broadcast, a few, none
        got = sorted(tuple(r) for r in collocation.collocations(df, least=8, keep=40, head=head, held=held).collect())
        assert got == sorted(expected), (head, held)
    assert collocation.collocations(frame(spark, [])).count() == 0 and collocation.collocations(frame(spark, [None, "", "one"])).count() == 0


def test_radix_order():
    rnd = np.random.default_rng(3)
    hi, lo = rnd.integers(0, 2**64, 500, np.uint64) >> np.uint64(37), rnd.integers(0, 50, 500).astype(np.uint64)
    assert np.array_equal(collocation.radix_order(hi, lo), np.lexsort((lo, hi)))
    assert collocation.counted(hi[:0], lo[:0], lo[:0].astype(np.int64))[0].tolist() == []


@pytest.mark.parametrize("ids", [[], [0], [5, 0, 50256, 70000, 2**32 - 1, 1], [0] * 2000, list(range(0, 70000, 7)) + [1] * 600])
def test_codes(ids):
    docs = [(None, np.array(ids, np.uint32)), (-3, np.array([9], np.uint32)), (8, np.array([], np.uint32))]
    reader = token_files.load(token_files.dump(docs))
    names, starts, tokens = reader.all()
    assert names == [None, -3, 8] and starts.tolist() == [0, len(ids), len(ids) + 1, len(ids) + 1] and tokens.tolist() == [*ids, 9]
    rnd = random.Random(1)
    for i in {0, len(ids), *rnd.sample(range(len(ids) + 1), min(300, len(ids)))}:
        assert reader.token(i) == tokens[i]
    assert reader.document(0) == (None, 0, len(ids)) and reader.document(1) == (-3, len(ids), len(ids) + 1)
    for i in (-1, len(ids) + 1):
        with pytest.raises(IndexError):
            reader.token(i)


def test_token_files_reject_damage():
    raw = bytearray(token_files.dump([(1, np.arange(3000, dtype=np.uint32))]))
    for place in (3, 20, 60, len(raw) - 5, len(raw) // 2):
        bad = raw.copy()
        bad[place] ^= 4
        with pytest.raises(token_files.BadFile):
            token_files.load(bytes(bad)).all()
    with pytest.raises(token_files.BadFile):
        token_files.load(bytes(raw[:-9])).all()
    assert token_files.dump([]) and token_files.load(token_files.dump([])).all()[2].tolist() == []


def test_token_files(spark, texts):
    e = encoders.Encoder(encoders.ByteLevel(special=True), False)
    ids = [None if i % 3 == 0 else 1000 - i // 2 for i in range(len(texts))]  # many null, the others twice
    docs = frame(spark, texts, ids, extra=True)
    for most in (token_files.FILE_TOKENS, 64):
        files = token_files.write(docs, file_tokens=most)
        got = token_files.read(files).orderBy("start").collect()
        assert files.count() > (20 if most == 64 else 0)
        sums = {}
        for i, t in zip(ids, texts):
            sums.setdefault(i, []).append((zlib.crc32(np.array([*whole(e, t or ""), 0], "<u4").tobytes()), len(whole(e, t or "")) + 1))
        assert [r["doc_id"] for r in got] == sorted(ids, key=lambda i: (i is not None, i or 0))
        assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
        for i, own in sums.items():
            assert sorted(own) == sorted((r["ids_crc32"], r["n_tokens"]) for r in got if r["doc_id"] == i)
    assert token_files.read(token_files.write(frame(spark, []))).count() == 0


def test_texts_are_cut_into_words_by_slices():
    """A batch of texts is not held as words all at once; no text is lost or cut, and windows are made slice by slice."""
    texts = [c * n for c, n in zip("abcdefgh", (300_000, 300_000, 900_000, 1, 2, 0, 524_288, 5))]
    rows = pd.DataFrame({"lang": ["x", "y"] * 4, "text": texts})
    slices = list(collocation.by_language(rows))
    assert [t for lang, part in slices if lang == "x" for t in part] == [t for t in texts[::2] if t]
    assert [t for lang, part in slices if lang == "y" for t in part] == [t for t in texts[1::2] if t]
    assert all(len(part) == 1 or sum(map(len, part)) <= collocation.SLICE for _, part in slices)
    seen = []
    windows = lambda r: (seen.append(len(r)), (np.full(3, 7, np.uint64), np.zeros(3, np.uint64), np.ones(3, np.int64)))[1]
    got = pd.concat(collocation._summed(windows, 100, 1)(iter([pd.DataFrame({"ids": [b""] * 4}), pd.DataFrame({"ids": []})])))
    assert seen == [1, 1, 1, 1] and got.values.tolist() == [[7, 0, 12]]


@pytest.mark.parametrize("held", [1000, 6])
def test_rare_keys_stay_in_the_task_that_has_all_their_rows(held):
    """A range whose keys a task can hold hands on its frequent ones only, once; one that is larger loses no count."""
    keys = [7] * 40 + [9] * 3 + list(range(100, 120)) + [7] * 2 + [9] * 27
    batches = [pd.DataFrame({"hi": keys[i : i + 5], "lo": 0, "n": 1}) for i in range(0, len(keys), 5)]
    own = lambda r: (r["hi"].to_numpy(np.uint64), r["lo"].to_numpy(np.uint64), r["n"].to_numpy(np.int64))
    got = pd.concat(collocation._summed(own, held, least=30)(iter(batches)))
    sums = got.groupby("hi")["n"].sum()
    assert {int(k): int(n) for k, n in sums.items() if n >= 30} == {7: 42, 9: 30}
    assert held < 1000 or got["hi"].tolist() == [7, 9]


def test_what_a_task_hands_on_at_once_is_small():
    """Keys and words leave a task in pieces of HANDED rows, and words are cut from at most SLICE characters of short texts."""
    own = lambda r: (r["hi"].to_numpy(np.uint64), np.zeros(len(r), np.uint64), np.ones(len(r), np.int64))
    got = list(collocation._summed(own, 10**6)(iter([pd.DataFrame({"hi": range(150_000)})])))
    assert sum(map(len, got)) == 150_000 and max(map(len, got)) <= 50_000
    slices = list(collocation.by_language(pd.DataFrame({"lang": "x", "text": ["a b " * 250] * 1000})))
    assert sum(len(part) for _, part in slices) == 1000 and max(sum(map(len, part)) for _, part in slices) <= 1 << 17
