"""Format-preserving pseudonyms for personal data: validated numbers and dates, permuted within their format.

A value is found by a pattern, validated (Luhn, mod 97, calendar, octets, number plans), and mapped by a keyed
Feistel permutation of its domain; cycle walking stays among valid values and check digits are computed anew. The
permutation depends on key, kind and domain only, so equal values get equal pseudonyms in every document and in
every way to write them (blanks, hyphens), and distinct values stay distinct. The key is the
caller's secret; there is no default, and one of less than 16 bytes is refused.

Where the longest reading of a number is not valid, shorter ones that end at a blank are tried, then those that begin
after its first blank. Null text stays null. Values that fail validation are left alone. Where two kinds claim the same characters, the
earlier in KINDS wins. Repeated rows are treated alike; empty tables give no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


@lru_cache(1 << 16)
def permute(value: int, size: int, tag: str, key: bytes) -> int:
    """A keyed permutation of range(size): a Feistel network over 2 * h bits, walked until it falls into the range."""
    h = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << h) - 1
    while True:
        left, right = value >> h, value & mask
        for r in range(ROUNDS):
            f = hashlib.blake2b(b"%d:%d:%s:%d" % (r, size, tag.encode(), right), key=key[:64], digest_size=16).digest()
            left, right = right, left ^ (int.from_bytes(f, "big") & mask)
        value = left << h | right
        if value < size:
            return value


def walk(value: int, size: int, tag: str, key: bytes, valid: Callable[[int], bool]) -> int:
    """permute() until the value is valid: a permutation of the valid values."""
    while True:
        value = permute(value, size, tag, key)
        if valid(value):
            return value


def luhn(digits: str) -> int:
    """0 if the last digit checks."""
    return sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(digits)))) % 10


def refill(shape: str, digits: str) -> str:
    """shape with its digits replaced one after the other."""
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in shape)


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def card(m: str, key: bytes) -> str | None:
    d = _digits(m)
    if not 13 <= len(d) <= 19 or luhn(d) or len(set(d)) == 1:
        return None
    n = len(d) - 1
    body = f"{permute(int(d[:-1]), 10**n, f'card{n}', key):0{n}d}"
    return refill(m, body + str(-luhn(body + "0") % 10))


def _national(v: int) -> bool:
    s = f"{v:010d}"
    return s[0] in "23456789" and s[3] in "23456789"


def phone(m: str, key: bytes) -> str | None:
    d = _digits(m)
    if (len(d) == 10 or len(d) == 11 and d[0] == "1") and _national(int(d[-10:])):
        return refill(m, d[:-10] + f"{walk(int(d[-10:]), 10**10, 'phone', key, _national):010d}")
    if m.startswith("+") and 9 <= len(d) <= 15 and d[0] != "0":  # the country's two digits stay
        n = len(d) - 2
        return refill(m, d[:2] + f"{permute(int(d[2:]), 10**n, f'phone{d[:2]}-{n}', key):0{n}d}")
    return None


def ssn(m: str, key: bytes) -> str | None:
    valid = lambda v: (a := v // 10**6) not in (0, 666) and a < 900 and v // 10**4 % 100 > 0 and v % 10**4 > 0
    v = int(_digits(m))
    return refill(m, f"{walk(v, 10**9, 'ssn', key, valid):09d}") if valid(v) else None


def ip(m: str, key: bytes) -> str | None:
    parts = m.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    v = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip", key)
    return ".".join(map(str, v.to_bytes(4, "big")))


def date(m: str, key: bytes) -> str | None:
    parts = [int(x) for x in re.split(r"[-/.]", m)]
    iso = len(re.split(r"[-/.]", m)[0]) == 4
    y, mo, d = parts if iso else parts[::-1]
    us = not iso and mo > 12 and "/" in m  # month first, where only that is a date
    if us:
        mo, d = d, mo
    try:
        at = dt.date(y, mo, d).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= at <= LAST_DAY:
        return None
    new = lambda v: dt.date.fromordinal(FIRST_DAY + v)
    # pseudonyms keep the way to read them: month first only for days beyond 12, so that the order stays clear
    p = new(walk(at - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", key, lambda v: (new(v).day > 12) == (d > 12)))
    out = f"{p.year:04d}{p.month:02d}{p.day:02d}" if iso else f"{p.month:02d}{p.day:02d}{p.year:04d}" if us else f"{p.day:02d}{p.month:02d}{p.year:04d}"
    return refill(m, out)


#: Lengths by country; of other countries any length is read.
IBAN_LENGTHS = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}.items() for c in cs.split()}


def iban(m: str, key: bytes) -> str | None:
    s = m.replace(" ", "")
    number = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(s) <= 34 or len(s) != IBAN_LENGTHS.get(s[:2], len(s)) or number(s[4:] + s[:4]) % 97 != 1:
        return None
    d = _digits(s[4:])
    if not d:
        return None
    body = refill(s[4:], f"{permute(int(d), 10 ** len(d), f'iban{s[:2]}{len(d)}', key):0{len(d)}d}")
    new = f"{s[:2]}{98 - number(body + s[:2] + '00') % 97:02d}{body}"
    it = iter(new)
    return "".join(c if c == " " else next(it) for c in m)


def email(m: str, key: bytes) -> str | None:
    """Letters and digits before the @ are permuted as one number of mixed radix; the domain stays."""
    name, _, domain = m.partition("@")
    radix = [10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 1 for c in name]
    size = value = 0
    for c, r in zip(name, radix):
        size, value = (size or 1) * r, value * r + (0 if r == 1 else int(c) if r == 10 else ord(c.lower()) - 97)
    if size < 2:
        return None
    value, out = permute(value, size, "email" + "".join("x" if r == 1 else str(r % 9) for r in radix), key), []
    for c, r in zip(reversed(name), reversed(radix)):
        value, v = divmod(value, r)
        out.append(c if r == 1 else str(v) if r == 10 else chr((65 if c.isupper() else 97) + v))
    return "".join(reversed(out)) + "@" + domain


KINDS: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("email", r"(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![\w-])", email),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", ip),
    ("date", r"(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9])|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.-])[0-9]{2}\1[0-9]{4})(?![\w/-]|\.[0-9]))", date),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", ssn),
    ("card", r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|[.-][0-9])", card),
    ("phone", r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![\w]|[.-][0-9])|(?<![\w.])\+[0-9]{9,15}(?!\w)", phone),
)
_PATTERNS = [(name, re.compile(p), f) for name, p, f in KINDS]
_SIGNS = re.compile(r"[0-9@]")


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, dict[str, int], list[tuple[int, int, str]]]:
    """The text with pseudonyms, counts by kind, and spans (start, end, kind) in the text given."""
    counts = dict.fromkeys((k for k, _, _ in KINDS), 0)
    if text is None or not _SIGNS.search(text):
        return text, counts, []
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern, f in _PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        own = [(a, b, kind, new) for a, b, new in _read(text, pattern, lambda s, f=f: f(s, key), sorted(taken))]
        found += own
        taken += [o[:2] for o in own]
    out, at = [], 0
    found.sort()
    for a, b, kind, new in found:
        counts[kind] += 1
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], counts, [(a, b, k) for a, b, k, _ in found]


def _read(text: str, pattern: re.Pattern, valid: Callable[[str], str | None], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, pseudonym) of the first valid readings, longest first, that overlap none of ``taken``."""
    at = 0
    while m := pattern.search(text, at):
        a, b = m.span()
        blanks = [i for i in range(a, b) if text[i] == " "]
        at = blanks[0] if blanks else b
        for end in (b, *reversed(blanks)):
            if (end == b or pattern.fullmatch(text, a, end)) and not _overlaps(taken, a, end) and (new := valid(text[a:end])) is not None:
                yield a, end, new
                at = end
                break


def _overlaps(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(spans, (b, -1))
    return i > 0 and spans[i - 1][1] > a


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with pseudonyms, a count for each kind, n_values, and spans of what was replaced (in the old text)."""
    if len(key) < 16:
        raise ValueError("a key of 16 bytes at least is needed")
    small_batches(docs.sparkSession)
    kinds = [k for k, _, _ in KINDS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [pseudonymise(t, key) for t in b["text"]]
            out = {"doc_id": b["doc_id"].astype("Int64"), "text": [r[0] for r in rows]}
            out |= {f"n_{k}": [r[1][k] for r in rows] for k in kinds}
            yield pd.DataFrame(out | {"n_values": [len(r[2]) for r in rows], "spans": [",".join(f"{k}:{x}:{y}" for x, y, k in r[2]) for r in rows]})

    schema = "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in kinds) + ", n_values long, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)
