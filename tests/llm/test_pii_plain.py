"""Pseudonyms of all kinds against a plain version: planted values with known places, decoys, and every pseudonym led back to its value."""

import datetime as dt
import hashlib
import ipaddress
import random
import re

import pytest

from citeforge.llm import pii

KEY = b"sixteen bytes at least"
COUNTS = ("email", "iban", "ip", "date", "ssn", "card", "phone")


def back(value, size, tag):
    """The inverse of the keyed permutation, step by step."""
    h = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    while True:
        left, right = divmod(value, 1 << h)
        for r in range(7, -1, -1):
            f = hashlib.blake2b(f"{r}:{size}:{tag}:{left}".encode(), key=KEY, digest_size=16).digest()
            left, right = right ^ (int.from_bytes(f, "big") % (1 << h)), left
        value = left * (1 << h) + right
        if value < size:
            return value


def until(value, size, tag, valid):
    value = back(value, size, tag)
    while not valid(value):
        value = back(value, size, tag)
    return value


def digits(s):
    return re.sub("[^0-9]", "", s)


def check_sum(d):
    odd, even = [int(c) for c in d[-1::-2]], [2 * int(c) for c in d[-2::-2]]
    return (sum(odd) + sum(x // 10 + x % 10 for x in even)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(c if c.isdigit() else str(ord(c) - 55) for c in s[4:] + s[:4])) % 97


def national(v):
    s = str(v).zfill(10)
    return s[0] in "23456789" and s[3] in "23456789"


def number_ok(v):
    a, b, c = v // 10**6, v // 10**4 % 100, v % 10**4
    return a not in (0, 666) and a < 900 and b > 0 and c > 0


FIRST = dt.date(1900, 1, 1)


def as_date(s):
    """(days since FIRST, its order of parts)."""
    for form in ("%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y", "%d-%m-%Y", "%m/%d/%Y"):
        try:
            return (dt.datetime.strptime(s, form).date() - FIRST).days, form
        except ValueError:
            pass
    raise ValueError(s)


def led_back(kind, old, new):
    """Whether the value that ``new`` stands for is that of ``old``; new is a valid value of the same form."""
    if kind != "ip":  # octets have one to three digits
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new))) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", old)))
    n, o = digits(new), digits(old)
    if kind == "card":
        assert check_sum(n)
        return back(int(n[:-1]), 10 ** (len(n) - 1), f"card{len(n) - 1}") == int(o[:-1])
    if kind == "ssn":
        assert number_ok(int(n))
        return until(int(n), 10**9, "ssn", number_ok) == int(o)
    if kind == "ip":
        return back(int(ipaddress.IPv4Address(new)), 1 << 32, "ip") == int(ipaddress.IPv4Address(old))
    if kind == "date":
        (a, form), (b, same) = as_date(new), as_date(old)
        late = (FIRST + dt.timedelta(b)).day > 12
        size = (dt.date(2099, 12, 31) - FIRST).days + 1
        return form == same and until(a, size, "date", lambda v: ((FIRST + dt.timedelta(v)).day > 12) == late) == b
    if kind == "phone":
        if (len(o) == 10 or len(o) == 11 and o[0] == "1") and national(int(o[-10:])):
            assert national(int(n[-10:])) and n[:-10] == o[:-10]
            return until(int(n[-10:]), 10**10, "phone", national) == int(o[-10:])
        return n[:2] == o[:2] and back(int(n[2:]), 10 ** (len(n) - 2), f"phone{n[:2]}-{len(n) - 2}") == int(o[2:])
    if kind == "iban":
        assert mod97(new) == 1 and new[:2] == old[:2]
        a, b = digits(new.replace(" ", "")[4:]), digits(old.replace(" ", "")[4:])
        return back(int(a), 10 ** len(a), f"iban{new[:2]}{len(a)}") == int(b)
    name, host = new.split("@")
    radix = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in name]

    def value(s):
        v = 0
        for c, r in zip(s, radix):
            v = v * r + (0 if r == 1 else int(c) if r == 10 else ord(c.lower()) - ord("a"))
        return v

    size = 1
    for r in radix:
        size *= r
    tag = "email" + "".join({10: "1", 26: "8", 1: "x"}[r] for r in radix)
    return host == old.split("@")[1] and back(value(name), size, tag) == value(old.split("@")[0])


def compared(old, new, spans):
    """Whether new is old with every span led back to its value, and nothing else changed."""
    at, here = 0, 0
    for a, b, k in spans:
        here += a - at
        assert new[here - (a - at) : here] == old[at:a]
        size = b - a if k != "ip" else len(re.compile(r"[0-9]+(?:\.[0-9]+){3}").match(new, here)[0])
        assert led_back(k, old[a:b], new[here : here + size]), (k, old[a:b], new[here : here + size])
        at, here = b, here + size
    assert new[here:] == old[at:]


def planted(rnd):
    """(kind, value): one of any kind, in one of its forms."""
    kind, d = rnd.choice(COUNTS), lambda n: "".join(rnd.choices("0123456789", k=n))
    if kind == "email":
        return kind, f"{rnd.choice(['ab', 'Q.r7', 'x_1', 'longer-name'])}{d(2)}@{rnd.choice(['example.com', 'm.example.co.uk'])}"
    if kind == "iban":
        body = d(18)
        s = f"DE{98 - mod97('DE00' + body):02d}{body}"
        return kind, rnd.choice([s, " ".join(s[i : i + 4] for i in range(0, 22, 4))])
    if kind == "ip":
        return kind, ".".join(str(rnd.randrange(256)) for _ in range(4))
    if kind == "date":
        x = FIRST + dt.timedelta(rnd.randrange(70_000))
        return kind, f"{x:{rnd.choice(['%Y-%m-%d', '%d/%m/%Y', '%d.%m.%Y', '%d-%m-%Y'])}}"
    if kind == "ssn":
        return kind, f"{rnd.randrange(1, 600):03d}-{rnd.randrange(1, 100):02d}-{rnd.randrange(1, 10_000):04d}"
    if kind == "card":
        s = "4" + d(14)
        s += next(c for c in "0123456789" if check_sum(s + c))
        return kind, rnd.choice([s, " ".join(s[i : i + 4] for i in range(0, 16, 4)), "-".join(s[i : i + 4] for i in range(0, 16, 4))])
    a, b, c = f"{rnd.randrange(200, 1000)}", f"{rnd.randrange(200, 1000)}", d(4)
    return kind, rnd.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 {a} {b} {c}", f"+44{rnd.randrange(10**9, 10**10)}"])


DECOYS = ["2023-02-30", "31/04/2001", "300.1.1.1", "000-12-3456", "4111111111111112", "DE00123456781234567890", "x@y", "1.2.3", "12 34", "@home", "v1.2.3.4.5"]


@pytest.mark.parametrize("seed", range(3))
def test_all_kinds_by_a_plain_version(spark, seed):
    rnd = random.Random(seed)
    rows, known = [(0, None), (1, "")], {0: [], 1: []}
    for i in range(2, 200):
        text, spans = "", []
        for _ in range(rnd.randrange(0, 9)):
            text += rnd.choice(["word ", "é ü ", "and, ", "\n", f"{rnd.choice(DECOYS)}, "]) + "so, "
            kind, value = planted(rnd)
            spans.append((len(text), len(text) + len(value), kind))
            text += value + rnd.choice([", ", "; ", " x ", "\n"])
        rows.append((i, text))
        known[i] = spans
    got = pii.pseudonyms(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect()
    assert len(got) == len(rows)
    seen = {}
    for r in got:
        old, spans = rows[r["doc_id"]][1], known[r["doc_id"]]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, b, k in spans), old
        assert r["n_values"] == len(spans) and all(r[f"n_{k}"] == sum(s[2] == k for s in spans) for k in COUNTS)
        if old is None:
            assert r["text"] is None
            continue
        compared(old, r["text"], spans)
        for a, b, k in spans:
            seen.setdefault(k, set()).add(old[a:b])
    assert set(seen) == set(COUNTS)


def test_the_table_by_the_plain_version(spark):
    """Every span in the documents of a table is a value of its kind, and its pseudonym leads back to it."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    old = {r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()}
    n = 0
    for r in pii.pseudonyms(d, KEY).collect():
        spans = [(int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in (r["spans"] or "").split(",") if s]
        compared(old[r["doc_id"]] or "", r["text"] or "", spans)
        n += len(spans)
    assert n > 50
