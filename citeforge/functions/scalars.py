"""Column expressions: identifiers, text clean-up, defaults, prefix parsing, exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"(?U)^[\s﻿]+|[\s﻿]+$"
# How identifiers are written. Resolver and prefix before one, and one within a text.
RESOLVER, PREFIX = "^https?://doi[.]org/", "^doi:"
WITHIN = r"(?:doi[.]org/)?(10[.]\d{4,}/[^\s\"'<,]+)"


def trimmed(x: Column) -> Column:
    """Without Unicode blanks at either end."""
    return F.regexp_replace(x, BLANKS, "")


def normalise_doi(x: Column) -> Column:
    """Lower case, without resolver or ``doi:`` prefix; trimmed last, so leading blanks keep a prefix in place."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), RESOLVER, ""), PREFIX, "")
    return trimmed(bare)


def strip_html(x: Column) -> Column:
    return trimmed(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), "<[^>]*>", ""), r"(?U)[\s﻿]+", " "))


def query_label(x: Column) -> Column:
    return trimmed(F.regexp_replace(F.replace(x, F.lit('"'), F.lit("")), r"\s+", " "))


def camel_split(x: Column) -> Column:
    return F.lower(trimmed(F.regexp_replace(x, "([A-Z])", " $1")))


def hyphens_to_blanks(x: Column) -> Column:
    return F.replace(x, F.lit("-"), F.lit(" "))


def or_else(*xs: Column) -> Column:
    """The first that is neither null nor empty; else the last."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs[:-1]], xs[-1])


def number_or(x: Column, default: Column) -> Column:
    """Numbers: 0 counts as missing."""
    return F.coalesce(F.nullif(x, F.lit(0)), default)


def int_prefix(x: Column) -> Column:
    """The integer that a text begins with, else null."""
    return F.nullif(F.regexp_extract(x, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("int")


def find_doi(x: Column) -> Column:
    """An identifier within a text: the whole of it, after a resolver or anywhere, or null."""
    inner = F.nullif(F.regexp_extract(x, WITHIN, 1), F.lit(""))
    return F.when(x.startswith("10."), x).otherwise(inner)


def first_known(x: Column, prefix: str) -> Column:
    """The first identifier of a known registrant in a whole record."""
    return F.nullif(F.regexp_extract(x, prefix.replace(".", "[.]") + r"/[a-z0-9]+-[a-z0-9]+", 0), F.lit(""))


def ratio_1(num: Column, den: Column) -> Column:
    """num / den to one decimal, half up, in integers; 0 if den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.floor((20 * num + den) / (2 * den)) / 10)


def quotes_dropped(x: Column) -> Column:
    return F.replace(x, F.lit('"'), F.lit(""))


def quotes_escaped(x: Column) -> Column:
    return F.replace(x, F.lit('"'), F.lit('\\"'))


def html_escaped(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def url_component(x: Column) -> Column:
    return F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))


def names_joined(items: Column, of, sep: str = "; ", blanks: bool = False) -> Column:
    """of(item) values, joined; no items give ''. ``blanks``: missing values keep their place as empty text."""
    values = F.transform(F.coalesce(items, F.array()), of)
    return F.array_join(values, sep, "") if blanks else F.array_join(F.filter(values, lambda s: F.coalesce(s, F.lit("")) != ""), sep)
