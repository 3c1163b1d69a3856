"""Catalogue records in ISO metadata as JSON text: children of a record, and the identifier, authors and year of one.

Values may be a text or an object with ``#text``; lists may be a single object. Records are parsed once, as variants; lists of children stay
JSON text, as the order of languages counts there, which a variant does not keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.inventory import names_by_role

# Where the fields lie in a record, and the registrant of the catalogue's own identifiers.
CITATION = "['gmd:identificationInfo']['gmd:MD_DataIdentification']['gmd:citation']['gmd:CI_Citation']"
TEXT = "['gco:CharacterString']"
ROLE = "['gmd:role']['gmd:CI_RoleCode']['@codeListValue']"
REGISTRANT = "10.25914"

_blank = lambda x: F.nullif(x, F.lit(""))


def _at(json: Column, path: str) -> Column:
    return F.get_json_object(json, f"${path}")


def _several(json: Column, path: str) -> Column:
    """array<string> of the objects at path, where one may stand alone."""
    there = _at(json, path)
    return F.coalesce(F.from_json(F.when(there.startswith("["), there).otherwise(F.concat(F.lit("["), there, F.lit("]"))), "array<string>"), F.array().cast("array<string>"))


def child_title(child: Column) -> Column:
    """English, else the first of several languages; a plain title, else the default one."""
    title, none = _at(child, "['title']"), F.lit("Untitled")
    names = F.map_values(F.from_json(title, "map<string,string>"))
    many = F.coalesce(_blank(_at(child, "['title']['eng']")), _blank(_at(child, "['title']['en']")), _blank(F.get(names, F.lit(0))), none)
    return F.when(title.startswith("{"), many).otherwise(F.coalesce(_blank(title), _blank(_at(child, "['defaultTitle']")), none))


def children(raw: DataFrame) -> DataFrame:
    """Edges (parent, id, title, pos) of raw(parent, record): an answer with a list of children each; no list, no edges."""
    return raw.select("parent", F.posexplode(_several(F.col("record"), "['children']")).alias("pos", "c")).select(
        "parent", F.coalesce(_blank(_at(F.col("c"), "['id']")), _blank(_at(F.col("c"), "['@id']")), F.lit("")).alias("id"), child_title(F.col("c")).alias("title"), F.col("pos").cast("long").alias("pos")
    )


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"${path}", kind)


def _said(v: Column, path: str) -> Column:
    """The text at path of a variant, or the text within the object there; null if empty."""
    there = _get(v, path, "variant")
    return _blank(F.when(F.schema_of_variant(there).startswith("OBJECT"), _get(there, "['#text']")).otherwise(_get(there, "")))


def _listed(v: Column, path: str) -> Column:
    """array<variant> of what is at path, where one may stand alone."""
    there = _get(v, path, "variant")
    several = F.schema_of_variant(there).startswith("ARRAY")
    return F.when(several, F.try_variant_get(there, "$", "array<variant>")).when(there.isNotNull(), F.array(there)).otherwise(F.array().cast("array<variant>"))


def identifier(record: Column, v: Column) -> Column:
    """From the data set's address; else any of the catalogue's own in the whole record; else ''."""
    return F.coalesce(_blank(S.find_doi(_said(v, f"['gmd:dataSetURI']{TEXT}"))), S.first_known(record, REGISTRANT), F.lit(""))


def authors(v: Column) -> Column:
    """Names of parties with an author's role: the person's, else the organisation's."""
    party = "['gmd:CI_ResponsibleParty']"
    parties = F.transform(
        _listed(v, f"{CITATION}['gmd:citedResponsibleParty']"),
        lambda p: F.struct(_get(p, party + ROLE).alias("role"), _said(p, f"{party}['gmd:individualName']{TEXT}").alias("individual"), _said(p, f"{party}['gmd:organisationName']{TEXT}").alias("organisation")),
    )
    return names_by_role(parties, ", ")


def year(v: Column) -> Column:
    """Of the first date there is."""
    date = "['gmd:CI_Date']['gmd:date']"
    dates = F.transform(_listed(v, f"{CITATION}['gmd:date']"), lambda d: F.coalesce(_said(d, f"{date}['gco:DateTime']"), _said(d, f"{date}['gco:Date']")))
    return S.int_prefix(F.substring(F.get(F.array_compact(dates), F.lit(0)), 1, 4))


def metadata(raw: DataFrame) -> DataFrame:
    """id, doi, authors, year of raw(id, record); the text of a record is parsed once, as a variant."""
    parsed = raw.select("id", "record", F.try_parse_json("record").alias("v"))
    r, v = F.col("record"), F.col("v")
    return parsed.select("id", identifier(r, v).alias("doi"), authors(v).alias("authors"), year(v).alias("year"))


def datasets(listed: DataFrame, meta: DataFrame) -> DataFrame:
    """Dataset rows of listed(id, title, a, b) with what meta(id, doi, authors, year) knows; a and b keep their order."""
    known = meta.groupBy("id").agg(F.min(F.struct("doi", "authors", "year")).alias("m"))
    j = listed.join(known, "id", "left")
    return j.select(
        F.coalesce("m.doi", F.lit("")).alias("doi"), F.col("title").alias("name"), F.coalesce("m.authors", F.lit("")).alias("authors"), F.col("m.year").alias("year"),
        F.lit("NCI").alias("platform"), F.lit("Dataset").alias("type"), F.col("id").alias("uuid"), "a", "b",
    )
