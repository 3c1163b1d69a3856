"""Source payloads, landed as JSON, projected onto canonical publication columns.

Every reader takes a frame with one record per row in explicit columns (see SCHEMAS); fetching is not its business.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import scalars as S

SCHEMAS = {
    "openalex": "doi string, title string, publication_year int, authorships array<struct<author:struct<display_name:string>,institutions:array<struct<display_name:string,country_code:string>>>>, "
    "primary_location struct<source:struct<display_name:string,host_organization_name:string>>, cited_by_count bigint, type string, open_access struct<is_oa:boolean>, topics array<struct<display_name:string>>",
    "crossref": "message struct<DOI:string,title:string,author:array<struct<given:string,family:string>>,`published-print`:struct<`date-parts`:array<array<int>>>,`published-online`:struct<`date-parts`:array<array<int>>>,"
    "`container-title`:array<string>,publisher:string,`is-referenced-by-count`:bigint,type:string,subject:array<string>>",
    "semantic_scholar": "title string, externalIds struct<DOI:string>, authors array<struct<name:string>>, year int, citationCount bigint, journal struct<name:string>, openAccessPdf struct<url:string>, publicationTypes array<string>, s2FieldsOfStudy array<struct<category:string>>",
    "europepmc": "doi string, title string, authorList struct<author:array<struct<firstName:string,lastName:string>>>, authorString string, journalTitle string, pubYear string, citedByCount bigint, pubType string, isOpenAccess string, "
    "meshHeadingList struct<meshHeading:array<struct<descriptorName:string>>>, keywordList struct<keyword:array<string>>",
    "core": "doi string, title string, authors array<string>, yearPublished int, publishedDate string, journals array<struct<title:string>>, publisher string, citationCount bigint, documentType string, subjects array<string>",
    "dimensions": "doi string, title string, year int, journal struct<title:string>, authors array<struct<first_name:string,last_name:string,full_name:string>>, times_cited bigint, type string, open_access array<string>, category_for array<struct<name:string>>",
}
DATACITE = (
    "id string, attributes struct<doi:string,titles:array<struct<title:string>>,creators:array<struct<name:string,familyName:string,givenName:string>>,publicationYear:int,types:struct<resourceTypeGeneral:string>>"
)
NETWORKS = "fdsn_code string, start_date string, doi string"
_some = lambda s: F.coalesce(s, F.lit("")) != ""


def envelope(spark: SparkSession, path: str, schema: str, field: str = "records") -> DataFrame:
    """The records of a JSON document {field: [...]}; a missing path is an empty table."""
    empty = spark.createDataFrame([], schema)
    try:
        docs = spark.read.schema(f"`{field}` array<struct<{empty._jdf.schema().toDDL()}>>").option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise
    return docs.selectExpr(f"inline(`{field}`)")


def _bare(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), "(?i)^https?://doi[.]org/", "")


def _done(df: DataFrame, doi: Column, keep: tuple[str, ...] = (), **cols: Column) -> DataFrame:
    """Rows without an identifier are dropped; columns ``keep`` stay beside the canonical ones."""
    return df.withColumn("_doi", doi).where(_some(F.col("_doi"))).select(*keep, F.col("_doi").alias("doi"), *[c.alias(n) for n, c in cols.items()])


def _oa(yes: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), "Yes").otherwise("No")


def _text(x: Column, default: str = "") -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(default))


def _year(x: Column) -> Column:
    """A year of 0 counts as none."""
    return F.nullif(x, F.lit(0))


def _title(x: Column) -> Column:
    return _text(S.strip_html(x), "Untitled")


def _full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", first, last))


def _first_three(items: Column) -> Column:
    """Missing items keep their place."""
    return F.array_join(F.slice(items, 1, 3), "; ", "")


def openalex(df: DataFrame, lookup: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A lookup has no placeholder title (rows without one are dropped), an unknown access flag where none is given, and no affiliations."""
    inst = F.flatten(F.transform(F.coalesce("authorships", F.array()), lambda a: F.coalesce(a["institutions"], F.array())))
    of = lambda name: F.array_distinct(F.filter(F.transform(inst, lambda i: i[name]), _some))
    is_oa = _oa(F.col("open_access.is_oa"))
    if lookup:
        df, is_oa = df.where(_some(F.col("title"))), F.when(F.col("open_access").isNull(), "Unknown").otherwise(is_oa)
    cols = {
        "title": _text(S.strip_html(F.col("title")), "" if lookup else "Untitled"),
        "authors": S.names_joined(F.col("authorships"), lambda a: a["author"]["display_name"], blanks=True),
        "year": _year(F.col("publication_year")),
        "journal": _text(F.col("primary_location.source.display_name")),
        "publisher": _text(F.col("primary_location.source.host_organization_name")),
        "cited": F.coalesce("cited_by_count", F.lit(0)),
        "type": S.hyphens_to_blanks(_text(F.col("type"))),
        "is_oa": is_oa,
        "subject": _first_three(F.transform(F.coalesce("topics", F.array()), lambda t: t["display_name"])),
    }
    if not lookup:
        cols |= {"author_count": F.size(F.coalesce("authorships", F.array())), "institutions": of("display_name"), "countries": of("country_code")}
    return _done(df, _bare(F.col("doi")), keep, **cols)


def crossref(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The online year counts only where the print date has no parts at all."""
    m = df.select(*keep, "message.*")
    part = lambda c: F.col(f"`{c}`.`date-parts`")
    year = lambda c: F.get(F.get(part(c), F.lit(0)), F.lit(0))
    title = F.when(F.col("title").startswith("["), F.get(F.from_json("title", "array<string>"), F.lit(0))).otherwise(F.col("title"))
    return _done(
        m, F.lower("DOI"), keep, title=_text(S.strip_html(title)),
        authors=S.names_joined(F.col("author"), lambda a: _full_name(a["given"], a["family"]), blanks=True),
        year=_year(F.when(F.get(part("published-print"), F.lit(0)).isNotNull(), year("published-print")).otherwise(year("published-online"))),
        journal=_text(F.get(F.col("`container-title`"), F.lit(0))), publisher=_text(F.col("publisher")), cited=F.coalesce(F.col("`is-referenced-by-count`"), F.lit(0)),
        type=S.hyphens_to_blanks(_text(F.col("type"))), is_oa=F.lit("Unknown"), subject=_first_three(F.coalesce("subject", F.array())),
    )


def semantic_scholar(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    fields = F.array_distinct(F.filter(F.transform(F.coalesce("s2FieldsOfStudy", F.array()), lambda f: f["category"]), _some))
    return _done(
        df, F.col("externalIds.DOI"), keep, title=_title(F.col("title")), authors=S.names_joined(F.col("authors"), lambda a: a["name"], blanks=True), year=_year(F.col("year")), journal=_text(F.col("journal.name")), publisher=F.lit(""),
        cited=F.coalesce("citationCount", F.lit(0)), type=S.camel_split(F.array_join(F.coalesce("publicationTypes", F.array()), ", ")), is_oa=_oa(_some(F.col("openAccessPdf.url"))), subject=_first_three(fields),
    )


def europepmc(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    people = F.col("authorList.author")
    names = F.when(people.isNotNull(), S.names_joined(people, lambda a: _full_name(a["firstName"], a["lastName"]), blanks=True)).otherwise(_text(F.col("authorString")))
    mesh = F.transform(F.col("meshHeadingList.meshHeading"), lambda h: h["descriptorName"])
    return _done(
        df, F.col("doi"), keep, title=_title(F.col("title")), authors=names, year=S.int_prefix(F.col("pubYear")), journal=_text(F.col("journalTitle")), publisher=F.lit(""), cited=F.coalesce("citedByCount", F.lit(0)),
        type=_text(F.col("pubType")), is_oa=_oa(F.col("isOpenAccess") == "Y"), subject=_first_three(F.coalesce(mesh, F.col("keywordList.keyword"), F.array())),
    )


def core(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Authors come as text or as an object with a name."""
    name = lambda a: F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a)
    return _done(
        df, _bare(F.col("doi")), keep, title=_title(F.col("title")), authors=S.names_joined(F.col("authors"), name), year=_year(S.number_or(F.col("yearPublished"), S.int_prefix(F.substring("publishedDate", 1, 4)))),
        journal=_text(F.get(F.col("journals"), F.lit(0))["title"]), publisher=_text(F.col("publisher")), cited=F.coalesce("citationCount", F.lit(0)), type=_text(F.col("documentType")), is_oa=F.lit("Yes"), subject=_first_three(F.coalesce("subjects", F.array())),
    )


def dimensions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Categories are cut to three before blanks go; half a name gives way to the full one."""
    person = lambda a: F.when(_some(a["first_name"]) & _some(a["last_name"]), F.concat(a["first_name"], F.lit(" "), a["last_name"])).otherwise(a["full_name"])
    three = F.filter(F.transform(F.slice(F.coalesce("category_for", F.array()), 1, 3), lambda c: c["name"]), _some)
    return _done(
        df, F.col("doi"), keep, title=_title(F.col("title")), authors=S.names_joined(F.col("authors"), person), year=_year(F.col("year")), journal=_text(F.col("journal.title")), publisher=F.lit(""), cited=F.coalesce("times_cited", F.lit(0)),
        type=_text(F.col("type")), is_oa=_oa(F.size(F.coalesce("open_access", F.array())) > 0), subject=F.array_join(three, "; "),
    )


READERS = {"openalex": openalex, "crossref": crossref, "semantic_scholar": semantic_scholar, "europepmc": europepmc, "core": core, "dimensions": dimensions}


def station_networks(lines: DataFrame, *keep: str) -> DataFrame:
    """code, name, year, start from pipe-delimited lines ``value`` with a header; lines under five fields are dropped. Columns ``keep`` stay: codes recur."""
    f = F.split("value", r"\|")
    rows = lines.where((F.size(f) >= 5) & ~F.col("value").startswith("#"))
    start = F.trim(f[2])
    return rows.select(*keep, F.trim(f[0]).alias("code"), F.trim(f[1]).alias("name"), S.int_prefix(F.substring(start, 1, 4)).alias("year"), F.lit("AusPass").alias("platform"), F.lit("Seismic Network").alias("type"))


def datacite(df: DataFrame, *keep: str) -> DataFrame:
    """Rows (id, attributes struct) of a DataCite page; columns ``keep`` stay."""
    a = F.col("attributes")
    person = lambda c: F.when(_some(c["familyName"]) & _some(c["givenName"]), F.concat(c["familyName"], F.lit(", "), F.substring(c["givenName"], 1, 1), F.lit("."))).otherwise(_text(c["name"], "Unknown"))
    return df.select(
        *keep, S.or_else(a["doi"], F.col("id")).alias("doi"), _text(F.get(a["titles"], F.lit(0))["title"], "Untitled").alias("name"), F.array_join(F.transform(F.coalesce(a["creators"], F.array()), person), ", ").alias("authors"),
        _year(a["publicationYear"].cast("int")).alias("year"), F.lit("EarthBank").alias("platform"), _text(a["types"]["resourceTypeGeneral"], "Dataset").alias("type"),
    )


def network_registry(df: DataFrame) -> DataFrame:
    """code, year, doi of rows (fdsn_code, start_date, doi) that have a code and a doi; other columns stay."""
    rest = [c for c in df.columns if c not in ("fdsn_code", "start_date", "doi")]
    return df.where(_some(F.col("doi")) & _some(F.col("fdsn_code"))).select(F.col("fdsn_code").alias("code"), S.int_prefix(F.substring("start_date", 1, 4)).alias("year"), "doi", *rest)


def read_records(raw: DataFrame, schema: str, *keep: str) -> DataFrame:
    """Fields of the JSON text ``record`` beside the columns kept; text that is no object is dropped."""
    return raw.withColumn("_r", F.from_json("record", schema)).where(F.col("_r").isNotNull()).select(*keep, "_r.*")
