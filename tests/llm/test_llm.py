import hashlib
import io
import random
import re
from collections import Counter

import numpy as np
import pytest

from citeforge.llm import common, decontaminate, deep_shallow, language, mixing, near_dup, pii, secret_scan, suffix_dedup, token_count, topk, warc

PII_KEY = b"a key for the tests"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string"


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], 0 if t is None else len(t), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 8))) for _ in range(400)]
    long = " ".join(rnd.choices(words, k=3000))
    near = long.split()
    near[7] = "changed"
    return [None, "", "   ", "a", long, long, " ".join(near), "é ü " * 50, "token = 'abcdef123' x", "x" * 1200, long[500:1500] + " tail", "1 2 3 4"]


def test_secrets_against_re(spark, odd):
    rules = {"assign": (r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}
    texts = odd + ["é token=token\":abcdef AKIA" + "Q" * 16 + " " + "0f" * 12, "Api_Key: 'Zz19==' passwd=ab secret= \"longer.one\"" * 300, "AKIAQ password:12345"]
    got = secret_scan.report(secret_scan.scan(docs(spark, texts))).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for r, t in zip(got, texts):
        spans = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, g, n)) in enumerate(rules.items()) for m in re.finditer(p, t or "") if len(m.group(g)) >= n)
        assert r["base_sha256"] == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest(), t
        assert r["n_assign"] == sum(s[1] == 0 for s in spans)
    clean = secret_scan.redact(secret_scan.scan(docs(spark, ["a token = abcdefgh b", None]))).orderBy("doc_id").collect()
    assert clean[0]["text"] == "a [SECRET] b" and secret_scan.trigram_query("[0-9a-f]+") == []


def test_decontaminate(spark, odd):
    bench = spark.createDataFrame([(1, "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 q10"), (2, "Zeta beta"), (3, ""), (4, None)], "item_id bigint, text string")
    d = docs(spark, odd + ["x Q0, q1 q2 q3 q4 q5 q6 q7 q8 q9 end", "zeta-BETA ok zeta"])
    for cut in (10**6, 5, 1):  # the first item is longer than a piece
        got = {r["doc_id"]: r for r in decontaminate.report(decontaminate.scan(d, bench, max_words=cut)).collect()}
        a, b = got[len(odd)], got[len(odd) + 1]
        assert (a["n_hit"], a["n_items"], b["n_hit"], b["n_words"]) == (10, 1, 2, 4) and a["items_sha256"] == hashlib.sha256(b"1").hexdigest()
        assert sum(r["contaminated"] for r in got.values()) == 2 and len(got) == len(odd) + 2
    assert decontaminate.remove_documents(d, bench).count() == decontaminate.remove_documents(d, bench, max_words=3).count() == len(odd)
    nameless = spark.createDataFrame([(None, "zeta beta"), (3, "no such words")], "item_id bigint, text string")
    got = decontaminate.report(decontaminate.scan(d, nameless)).where("contaminated").collect()
    assert [(r["doc_id"], r["n_hit"], r["n_items"]) for r in got] == [(len(odd) + 1, 2, 0)] and decontaminate.remove_documents(d, nameless).count() == len(odd) + 1
    assert decontaminate.remove_spans(d, bench).where(f"doc_id = {len(odd) + 1}").first()["text"] == "- ok zeta"


def test_near_duplicates(spark, odd):
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs(spark, odd)).collect()}
    assert len(got) == len(odd) and got[5]["component_id"] == got[6]["component_id"] == 4 and not got[6]["kept"]
    assert got[0]["n_shingles"] == 0 and got[0]["kept"] and got[3]["n_shingles"] == 1
    assert [r["doc_id"] for r in near_dup.keep_first(docs(spark, ["a b c", "A b  c", "d"])).orderBy("doc_id").collect()] == [0, 2]


def near_by_brute_force(texts):
    """(shingles, least index reachable) of each text."""
    sets = []
    for t in texts:
        ws = (t or "").encode().lower().split()
        sets.append({tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return [(len(s), r) for s, r in zip(sets, root)]


@pytest.mark.parametrize("block", [2, 1024])
def test_near_duplicates_in_blocks(spark, odd, monkeypatch, block):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choices("abcdefgh", k=6))
    texts = list(odd)
    for _ in range(3):
        base = [word() for _ in range(120)]
        texts.append(" ".join(base))
        for k in range(14):  # each a few edits away from the one before: some link only in chains, some not at all
            for _ in range(1 + k % 3):
                base[rnd.randrange(120)] = word()
            texts.append(" ".join(base))
    monkeypatch.setattr(near_dup, "BLOCK", block)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == near_by_brute_force(texts)


def test_blocks_find_what_the_least_node_hides():
    rnd = random.Random(13)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    far = [*base[:140], *(f"v{i}" for i in range(60))]
    texts = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(far), " ".join([*far[:-1], "y"])]
    sets = [near_dup.shingles(t) for t in texts]
    nodes = [near_dup.node_of(x) for x in sets]
    regs = near_dup.registers(sets)
    regs[:, :5] = regs[0, :5]  # a bucket that all share
    rows = [(h, n, n, len(x), r.tobytes()) for h in (True, False) for n, x, r in zip(nodes, sets, regs)]
    block = near_dup._Block(rows)
    assert block.open() == set(nodes) and {frozenset(x) for x in block.links(dict(zip(nodes, sets)))} == {frozenset(nodes[:2]), frozenset(nodes[2:])}


def test_sketches_merge():
    rnd = np.random.default_rng(6)
    x, y = (np.unique(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in (700, 300))
    a, b, both = near_dup.registers([x, y, np.union1d(x, y)])
    assert (near_dup.merged(a, b) == both).all()


def test_suffix_dedup(spark, odd):
    raws = [(t or "").encode() for t in odd]
    seen = Counter(x[i : i + 400] for x in raws for i in range(len(x) - 399))
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs(spark, odd)).collect()}
    for i, x in enumerate(raws):
        spans = [(j, j + 400) for j in range(len(x) - 399) if seen[x[j : j + 400]] > 1]
        kept, n, removed = suffix_dedup.kept_bytes(x, spans)
        assert (got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (removed, n, hashlib.sha256(kept).hexdigest()), i


def shared_words(texts, n=suffix_dedup.WORDS):
    """For each text, the words inside strings of n words that another row has too, by brute force."""
    rows = [(t or "").encode().split() for t in texts]
    holders = {}
    for i, ws in enumerate(rows):
        for j in range(len(ws) - n + 1):
            holders.setdefault(tuple(ws[j : j + n]), set()).add(i)
    out = []
    for i, ws in enumerate(rows):
        inside = set()
        for j in range(len(ws) - n + 1):
            if len(holders[tuple(ws[j : j + n])]) > 1:
                inside.update(range(j, j + n))
        out.append(len(inside))
    return out


def test_split_groups_give_the_same(spark, odd, monkeypatch):
    texts = odd + [f"{i} " * 30 + odd[4][2000:2900] + f" {i}" * 30 for i in range(12)]
    want = sorted(map(tuple, suffix_dedup.dedup(docs(spark, texts)).collect()))
    assert [r[-1] for r in want] == shared_words(texts)
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    assert sorted(map(tuple, suffix_dedup.dedup(docs(spark, texts)).collect())) == want


def test_suffix_remove(spark, odd):
    texts = odd + ["\u00e9" * 300 + "!", "x" + "\u00e9" * 300]  # whole characters repeat
    d = docs(spark, texts)
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.remove(d).collect()}
    want = {r["doc_id"]: r["kept_sha256"] for r in suffix_dedup.dedup(d).collect()}
    assert suffix_dedup.remove(d).columns == d.columns and got[0] is None
    assert all(hashlib.sha256((t or "").encode()).hexdigest() == want[i] for i, t in got.items())


def test_suffix_dedup_of_many_rows_without_ids(spark, odd):
    many = spark.createDataFrame([(None if i % 2 else 7, t) for i in range(1000) for t in (odd[4] if i % 3 == 0 else f"{i} {odd[4][i : i + 500]}",)], "doc_id bigint, text string")
    got = suffix_dedup.dedup(many).collect()
    assert len(got) == 1000 and sum(r["n_removed"] == r["n_bytes"] == len(odd[4]) for r in got) == 334 and all(r["n_removed"] >= 490 for r in got)


def test_words_in_parts(monkeypatch):
    rnd = random.Random(3)
    text = "".join(rnd.choices("ab \t\n\x0b\x0cé", k=4000)).encode()
    whole = common.word_hashes(text)
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.split())) and len(common.word_hashes(b" \n")) == len(common.word_hashes(b"")) == 0
    for part in (1, 7, 100):
        monkeypatch.setattr(common, "_PART", part)
        assert (common.word_hashes(text) == whole).all()


def test_deep_shallow():
    rnd = random.Random(1)
    xs = [bytes(rnd.choices(b"ab", k=rnd.randrange(50))) for _ in range(200)] + [b"q" * 60, b"q" * 61, b"q" * 60]
    order, lcp = deep_shallow.sort_with_lcp(xs, 8)
    assert [xs[i] for i in order] == sorted(xs) and all(lcp[i] == deep_shallow.common(xs[order[i - 1]], xs[order[i]]) for i in range(1, len(xs)))


def test_topk(spark):
    rnd = np.random.default_rng(3)
    vs = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(300, 20)))] + [(300, None), (301, [float("nan")] * 20), (302, [1.0])]
    vs += [(400 + i, vs[7][1]) for i in range(9)]
    vs += [(50, vs[50][1]), (100, vs[3][1])]  # asked once each
    df = spark.createDataFrame(vs, "vec_id bigint, embedding array<double>")
    got = topk.search(df, df.where("vec_id % 50 = 0"), query_block=3, block=64).collect()
    ok = {i: np.floor(256 * np.array(v)) for i, v in vs if v is not None and len(v) == 20 and np.isfinite(v).all()}
    rows = [(i, np.floor(256 * np.array(v))) for i, v in vs if i in ok]
    asked = {q: min(tuple(x) for i, x in rows if i == q) for q in ok if q % 50 == 0}
    want = [(q, r + 1, i, -s) for q, x in asked.items() for r, (s, i) in enumerate(sorted((-int(np.array(x) @ y), i) for i, y in rows if i != q)[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_warc(spark):
    pages = spark.createDataFrame([(1, "u", "p" * 100), (2, "u\n", "p" * 100), (3, None, None), (4, "v", "short"), (5, "v", "short"), (6, "v", "é" * 5000)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in warc.read(warc.write(pages), payloads=True).collect()}
    assert got[2]["refers_to"] == 1 and got[2]["url"] == "u\n" and got[5]["record_type"] == "response" and got[3]["payload_bytes"] == 0 and got[6]["payload"].decode() == "é" * 5000
    buf = io.BytesIO()
    w = warc.Writer(buf, b"")
    w.add(warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), "response", None))
    assert [warc.parse(r)["payload"] for r in warc.read_archive(io.BytesIO(buf.getvalue()))] == [b"abc"]
    with pytest.raises(warc.BadArchive):
        list(warc.read_archive(io.BytesIO(buf.getvalue()[:-3])))
    sound = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), "response", None)
    for bad in (warc.record(1, "u", b"abc", "00", "response", None), sound.replace(b"WARC-Date: 1970", b"WARC-Date: x970"), re.sub(rb"WARC-Record-ID.*\r\n", b"", sound), sound + b"x"):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    ids = [re.search(r"WARC-Record-ID: (\S+)", warc.record(None, None, b"", "", "response", None).decode()).group(1) for _ in range(3)]
    assert len(set(ids)) == 3 and b"WARC-Target-URI: http://a/b\r\n" in warc.record(1, "http://a/b", b"", "", "response", None)
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_language(spark):
    rnd = random.Random(2)
    word = {"en": ["the", "and", "thing", "which"], "de": ["der", "und", "nicht", "schön"], "fr": ["les", "été", "que", "voix"]}
    rows = [(i, " ".join(rnd.choices(word[lang], k=20)), lang) for i in range(300) for lang in [("en", "de", "fr")[i % 3]]] + [(300, None, "en"), (301, "123 !!", "en"), (302, "the", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in language.predict(df, language.fit(df)).collect()}
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in range(300)) >= 297 and got[300]["lang_pred"] == got[301]["lang_pred"] == "und"
    assert not any(map(language.has_letter, ("½", "²", "Ⅷ", "①", "1_0", "", None))) and all(map(language.has_letter, ("a", "é", "字", "ʰ")))
    few = language.fit(df, most=6)  # fewer documents of each, and still all languages
    assert sorted(n for m in few.within for n in m.names) == ["de", "en", "fr"]
    none = df.limit(0)
    assert language.predict(none, language.fit(none)).count() == 0 and language.predict(df, language.fit(none)).where("lang_pred <> 'und'").count() == 0


def test_language_by_brute_force(spark):
    """Held-out accuracy on all documents, and each prediction by votes counted pair by pair."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(d)
    rows = d.join(language.predict(d, model), "doc_id").collect()
    held = [r for r in rows if r["held_out"] and language.has_letter(r["text"])]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)

    def winner(machines, x):
        votes, sums = Counter(), Counter()
        for k, (a, b) in enumerate(machines.pairs):
            margin = float(x @ machines.weights[:-1, k] + machines.weights[-1, k])
            p = 1 / (1 + np.exp(-4 * margin))
            votes[a if margin >= 0 else b] += 1
            sums[a] += p
            sums[b] += 1 - p
        if not machines.pairs:
            return 0, 1.0
        best = max(range(len(machines.names)), key=lambda i: (votes[i], sums[i], -i))
        return best, sums[best] / (len(machines.names) - 1)

    for r in rows[:300]:
        if not language.has_letter(r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        x = language.features(r["text"])
        f, p = winner(model.families, x)
        i, q = winner(model.within[f], x)
        assert r["lang_pred"] == model.within[f].names[i] and abs(r["score"] - p * q) < 1e-3


def test_pii(spark):
    f = lambda t: pii.pseudonymise(t, b"k")[0]
    a, b = f("card 4785 3805 9239 1139"), f("4785380592391139")
    assert re.sub(r"\D", "", a) == b and pii.luhn(b) == 0 and "4785380592391139" not in b
    assert f("4785380592391138") == "4785380592391138" and f("2023-02-30") == "2023-02-30" and f("2023-02-28") != "2023-02-28"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", f("+1 (743) 555-3824")) and re.fullmatch(r"[a-z]\.[a-z]\d@m\.example\.com", f("a.b9@m.example.com"))
    assert len({pii.permute(v, 1000, "t", b"k") for v in range(1000)}) == 1000
    assert pii.pseudonyms(docs(spark, [None, "", "x 152.143.123.131"]), PII_KEY).where("n_ip = 1").count() == 1


def test_pii_is_a_bijection_that_links_documents(spark):
    cards = [f"{v:04d}" for v in range(1000)]
    whole = [c + str(-pii.luhn(c + "0") % 10) for c in (f"41111111111{c}" for c in cards)]
    dates = [f"{y}-{m:02d}-{d:02d}" for y in (1999, 2024) for m in range(1, 13) for d in range(1, 29)]
    for values, sound in ((whole, lambda v: pii.luhn(v) == 0 and len(v) == 16), (dates, lambda v: re.fullmatch(r"\d{4}-\d\d-\d\d", v))):
        rows = [(i, f"first {v} then") for i, v in enumerate(values)] + [(len(values) + i, f"{v} " * 200 + "x" * 10_000) for i, v in enumerate(values[:50])]
        got = {r["doc_id"]: r["text"] for r in pii.pseudonyms(spark.createDataFrame(rows, "doc_id bigint, text string"), PII_KEY).collect()}
        new = [got[i].split()[1] for i in range(len(values))]
        assert len(set(new)) == len(values) and all(map(sound, new)) and sum(a != b for a, b in zip(new, values)) >= len(values) - 2
        assert all(got[len(values) + i] == f"{new[i]} " * 200 + "x" * 10_000 for i in range(50))
        other = pii.pseudonymise(rows[0][1], b"another key of the tests")[0]
        assert other != got[0]
    with pytest.raises(ValueError):
        pii.pseudonyms(docs(spark, ["x"]), b"short")


def test_kept_trees(spark, odd):
    enc = token_count.encoding(token_count.load_ranks())
    rnd = random.Random(15)
    han = "".join(rnd.choices("的一是不了人我在有他这中大来上国，。！１２", k=30_000))
    mixed = "".join(rnd.choices("aé9!'  \n漢字かな，ß٣#\u0301\u00a0\u3000", k=20_000))
    texts = [*odd, han, mixed, "x" * 5000, "don't we'll 'rest '' 's"]
    d = docs(spark, texts)
    forest = token_count.trees(d)
    kept = {r["doc_id"]: r for r in forest.collect()}
    size = lambda t: len(enc.encode_ordinary(t))
    assert [kept[i]["n_tokens"] for i in range(len(texts))] == [size(t or "") for t in texts]
    assert max(map(len, kept[len(odd)]["leaves"])) < 1200 and len(kept[len(odd) + 1]["leaves"]) > 15
    now = [t or "" for t in texts]
    for _ in range(2):  # the second round edits what the first has left
        todo = []
        for i, t in enumerate(now):
            places = sorted(rnd.sample(range(len(t) + 1), min(len(t) + 1, 6)))
            new = [(a, b, rnd.choice(["", " ", "字", "q 7", "'s"])) for a, b in zip(places[::2], places[1::2])]
            todo += [(i, *e) for e in new]
            for a, b, x in reversed(new):
                now[i] = now[i][:a] + x + now[i][b:]
        todo.append((999, 0, 0, "no such document"))
        forest = token_count.staged(token_count.edited(forest, spark.createDataFrame(todo, token_count.EDIT)), "test-trees")
        got = {r["doc_id"]: r for r in forest.collect()}
        assert all("".join(got[i]["leaves"]) == t and got[i]["n_tokens"] == size(t) and got[i]["n_chars"] == len(t) for i, t in enumerate(now)) and len(got) == len(texts)
    short = [(0, "one"), (1, "a" * 40 + " b" * 3000)]
    few = token_count.edited(token_count.trees(spark.createDataFrame(short, "doc_id bigint, text string")), spark.createDataFrame([(1, 5000, 5001, "")], token_count.EDIT))
    assert 0 < {r["doc_id"]: r["n_chars_encoded"] for r in few.collect()}[1] < 3000
    for r in token_count.counts(d).collect():
        t = texts[r["doc_id"]] or ""
        assert (r["n_tokens"], r["n_tokens_edited"], r["n_edits"], r["n_chars"]) == (size(t), size(token_count.SCRUB.sub("", t)), len(token_count.scrubbed(t)), len(t))


def test_token_counts(spark, odd):
    enc = token_count.encoding(token_count.load_ranks())
    count = lambda ps: [len(enc.encode_ordinary(p)) for p in ps]
    rnd = random.Random(5)
    for t in filter(None, odd):
        tree, cur = token_count.TokenTree(t, count, 64), t
        for _ in range(6):
            x = rnd.randrange(len(cur) + 1)
            y, new = min(len(cur), x + rnd.choice([0, 1, 40])), rnd.choice(["", " ", "q", " 12 "])
            tree.edit(x, y, new)
            cur = cur[:x] + new + cur[y:]
            assert tree.total == len(enc.encode_ordinary(cur)) and tree.text() == cur
    assert token_count.counts(docs(spark, odd)).where("n_tokens = 0").count() == 2
    marks = "it's%%% a### b12$$$é***'s " * 200  # an edit at each word
    for t in (marks, marks.replace(" ", ""), "x" * 5000 + marks, ""):
        todo, whole, each = token_count.scrubbed(t), token_count.TokenTree(t, count, 64), token_count.TokenTree(t, count, 64)
        for e in reversed(token_count.together(t, todo, 100)):
            whole.edit(*e)
        for e in reversed(todo):
            each.edit(*e)
        assert whole.text() == each.text() == token_count.SCRUB.sub("", t)
        assert whole.total == each.total == count([each.text()])[0]


def test_mix(spark, odd):
    d = docs(spark, odd + ["w " * 50] * 30, ["a", None, "b"] * 14)
    rows = mixing.mix(d).collect()
    assert len(rows) == len(odd) + 30 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - sum(r["size"] for r in rows)) <= 0.05 * sum(r["size"] for r in rows)
    assert mixing.mix(d.limit(0)).count() == 0 and sorted(map(tuple, mixing.mix(d).collect())) == sorted(map(tuple, rows))


def seats_by_brute_force(claims, seats, limits):
    got = [0] * len(claims)
    for _ in range(seats):
        open_rows = [i for i, c in enumerate(claims) if c > 0 and got[i] < limits[i]]
        got[max(open_rows, key=lambda i: (claims[i] / (2 * got[i] + 1), -i))] += 1
    return got


def mix_by_brute_force(rows, block, repeats, shard_docs, fan, seed="mix-1"):
    """(doc_id, size, source_size, target, taken) of rows (doc_id, text, source), dealt seat by seat and taken word by word."""
    h = lambda *parts: int(hashlib.md5(":".join(str(x) for x in (seed, *parts) if x is not None).encode()).hexdigest()[:15], 16)
    sized = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), "b" if src is None else "a" + src, h(d, t)) for d, t, src in rows]
    names = sorted({r[2] for r in sized})
    size = {n: sum(r[1] for r in sized if r[2] == n) for n in names}
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    target, rest = {}, sum(size.values())
    while left := [n for n in names if n not in target]:
        level = rest / sum(weight[n] for n in left)
        over = [n for n in left if weight[n] * level > repeats * size[n] + 1e-9]
        for n in over or left:
            target[n] = float(repeats * size[n]) if over else weight[n] * level
        rest -= sum(target[n] for n in over)
        if not over:
            break
    quota = dict(zip(names, seats_by_brute_force([target[n] for n in names], int(sum(target.values()) / block + 0.5), [10**9] * len(names))))
    out = []
    for n in names:
        own = [r for r in sized if r[2] == n]
        shards = -(-len(own) // shard_docs)
        lanes = {k: sorted(((at, d, z) for d, z, _, at in own if at % shards == k), key=lambda x: (x[0], -1 if x[1] is None else x[1], x[2])) for k in {r[3] % shards for r in own}}
        total = {k: sum(z for *_, z in lane) for k, lane in lanes.items()}
        most = {k: repeats * -(-z // block) for k, z in total.items()}
        groups = sorted({k // fan for k in lanes})
        per = seats_by_brute_force([sum(total[k] for k in lanes if k // fan == g) for g in groups], quota[n], [sum(most[k] for k in lanes if k // fan == g) for g in groups])
        for g, q in zip(groups, per):
            ks = sorted(k for k in lanes if k // fan == g)
            for k, mine in zip(ks, seats_by_brute_force([total[k] for k in ks], q, [most[k] for k in ks])):
                blocks, word = max(1, -(-total[k] // block)), 0
                phase = h(n, k) % blocks
                for _, d, z in lanes[k]:
                    each = [mine // blocks + ((i // block * (mine % blocks) + phase) % blocks < mine % blocks) for i in range(word, word + z)]
                    out.append((d, z, size[n], target[n], sum(each)))
                    word += z
    return out


@pytest.mark.parametrize("shard_docs, fan", [(1024, 4096), (3, 2), (2, 100)])
def test_mix_by_brute_force(spark, shard_docs, fan):
    rnd = random.Random(9)
    rows = [(i, "w " * rnd.choice([0, 1, 7, 16, 40, 200]), rnd.choice(["a", "a", "a", "b", None, "tiny" if i % 9 == 0 else "c"])) for i in range(90)] + [(90, None, "empty"), (91, "one two", "small")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted(tuple(r) for r in mixing.mix(df, shard_docs=shard_docs, fan=fan).collect())
    want = sorted(mix_by_brute_force(rows, mixing.BLOCK, mixing.REPEATS, shard_docs, fan))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want] and all(abs(g[3] - w[3]) < 1e-6 for g, w in zip(got, want))
    for src in {r[2] for r in rows}:
        own = [g for g in got if rows[g[0]][2] == src]
        assert abs(sum(g[4] for g in own) - own[0][3]) <= mixing.BLOCK * (1 + mixing.REPEATS * -(-len(own) // shard_docs))
    kept = mixing.mix(df, shard_docs=shard_docs, fan=fan, keep=True)
    assert kept.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"] and sorted((r[0], r[-1]) for r in kept.collect()) == [(g[0], g[4]) for g in got]


@pytest.mark.parametrize("f", [near_dup.near_duplicates, suffix_dedup.dedup, token_count.counts, lambda d: pii.pseudonyms(d, PII_KEY), lambda d: secret_scan.report(secret_scan.scan(d))])
def test_empty_tables(spark, f):
    assert f(docs(spark, [])).count() == 0


def test_pipeline_by_brute_force(spark, tmp_path):
    """run() over planted cases against the same decisions in plain Python."""
    import corpus_pipeline

    rnd = random.Random(21)
    vocabulary = {lang: ["".join(rnd.choices(letters, k=rnd.randrange(3, 8))) for _ in range(300)] for lang, letters in (("en", "abcdefgh"), ("de", "ijklmnopü"), ("fr", "qrstuvwé"), ("es", "xyzabñ"))}
    say = lambda lang, n: rnd.choices(vocabulary[lang], k=n)
    bench = [(1, " ".join(say("en", 30))), (2, " ".join(say("de", 14))), (None, " ".join(say("fr", 12))), (4, None)]
    rows = []
    for i in range(120):
        lang = ("en", "de", "fr", "es")[i % 4]
        rows.append([i, " ".join(say(lang, rnd.randrange(30, 120))), lang, f"s{i % 5}" if i % 11 else None, 7])
    near = lambda t: " ".join([*t.split()[:-1], "changed"])
    rows += [[200 + i, near(rows[i][1]), "en", "s1", 7] for i in range(6)] + [[300, near(near(rows[0][1])), "en", "s1", 7], [301, rows[9][1], "de", None, 7], [None, rows[10][1] + " tail", "fr", "s2", 7]]
    rows += [[400, rows[1][1] + " " + " ".join(bench[0][1].split()[5:15]) + " on", "en", "s2", 7], [401, "so " + bench[1][1].replace("i", "I").replace("m", "M"), "de", "s2", 7], [402, "x " + bench[2][1], "fr", "s0", 7]]
    rows += [[500, " ".join(say("en", 40)) + " password = 'hunter22'", "en", "s3", 7], [501, "AKIA" + "Q" * 16 + " " + " ".join(say("de", 40)), "de", "s3", 7]]
    rows += [[600, None, "en", "s1", 0], [601, "", "en", "s1", 0], [602, "123 ½ !!", "en", "s1", 8]]
    for name, data, schema in (("documents", [tuple(r) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("benchmark", bench, "item_id bigint, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"file://{tmp_path}/{name}.parquet")
    got = sorted(map(tuple, corpus_pipeline.run(spark, f"file://{tmp_path}").collect()), key=str)

    kept = [r for r in rows if language.has_letter(r[1])]  # a winner of all its pairs scores 0.25 at least
    groups = near_by_brute_force([r[1] for r in kept])
    least = {g: min((r[0] for r, (_, h) in zip(kept, groups) if h == g and r[0] is not None), default=None) for _, g in groups}
    kept = [r for r, (_, g) in zip(kept, groups) if r[0] is None or r[0] == least[g]]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {tuple(ws[i : i + min(10, len(ws))]) for _, t in bench for ws in [words(t)] if ws for i in range(len(ws) - min(10, len(ws)) + 1)}
    held = lambda ws: any(tuple(ws[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(ws) - n + 1))
    kept = [r for r in kept if not held(words(r[1]))]
    clean = []
    for d, t, lang, src, n in kept:
        spans = sorted(m.span() for rule in secret_scan.RULES for m in re.finditer(rule.regex, t) if len(m.group(rule.group)) >= rule.least)
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        clean.append((d, out + t[at:], lang, src, len(out + t[at:]) if spans else n))
    at = {d: (z, s, g, x) for d, z, s, g, x in mix_by_brute_force([(r[0], r[1], r[3]) for r in clean], mixing.BLOCK, 3, 1024, 4096)}
    want = sorted(((*r, *at[r[0]]) for r in clean), key=str)
    assert [g[:7] + g[8:] for g in got] == [w[:7] + w[8:] for w in want] and all(abs(g[7] - w[7]) < 1e-6 for g, w in zip(got, want))
    ids = {g[0] for g in got}
    assert ids & {0, 9, 500, 501, None} == {0, 9, 500, 501, None} and not ids & {200, 300, 301, 400, 401, 402, 600, 601, 602}
