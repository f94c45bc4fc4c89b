"""Manifest and company nodes: file names, content statistics, issuer resolution, exclusions, enrichment, purge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.patterns import ANY_CASE, LINES, any_of, blank_to_null, matches, title_case
from ..functions.rows import exploded
from ..rules import filings as R


def company_name(raw: Column) -> Column:
    name = F.trim(F.regexp_replace(F.translate(raw, "_", " "), r"(?U)\s+", " "))
    return F.when((F.upper(name) == name) & (F.lower(name) != name), title_case(name)).otherwise(name)


def integer_cik(c: Column) -> Column:
    """Digits without leading zeros, null if there are none."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.nullif(F.when(F.length(digits) > 0, F.coalesce(F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit("")), F.lit("0"))), F.lit(""))


def parse_stem(df: DataFrame, stem: str = "stem") -> DataFrame:
    """Adds filing_date, company_name, accession, section_type, submitter_cik, parse_notes and parse_success."""
    parts = F.split(stem, "__")
    date = F.get(parts, 0)
    month, day = F.substring(date, 6, 2).try_cast("int"), F.substring(date, 9, 2).try_cast("int")
    good_date = date.rlike(r"^\d{4}-\d{2}-\d{2}$") & month.between(1, 12) & day.between(1, 31)
    tail = F.element_at(parts, -1)
    accession = F.nullif(F.regexp_extract(tail, r"(\d{10}-\d{2}-\d{6})", 1), F.lit(""))
    section = F.nullif(F.regexp_replace(F.lower(F.regexp_extract(tail, r"\d{10}-\d{2}-\d{6}[_ \t]*(.*)$", 1)), r"[^a-z0-9_-]", ""), F.lit(""))
    out = df.withColumns({
        "filing_date": F.when(good_date, date), "company_name": F.when(F.size(parts) >= 3, company_name(F.get(parts, 1))), "accession": accession,
        "section_type": section, "submitter_cik": F.when(accession.isNotNull(), integer_cik(F.substring(accession, 1, 10))),
    })
    notes = F.array_compact(F.array(
        F.when(F.col("filing_date").isNull(), "no date"), F.when(F.col("company_name").isNull(), "no company"), F.when(F.col("accession").isNull(), "no accession"), F.when(F.col("section_type").isNull(), "no section")))
    return out.withColumn("parse_notes", F.array_join(notes, "; ")).withColumn("parse_success", F.size(notes) == 0)


def first_present(columns: Sequence[str], names: Sequence[str] = R.FILE_COLUMNS) -> Column:
    """The first of the named columns that isn't blank in the row, with slashes for backslashes; null if there is none."""
    given = [blank_to_null(F.col(n).cast("string")) for n in names if n in columns]
    return F.translate(F.coalesce(*given), "\\", "/") if given else F.lit(None).cast("string")


def overlay(parsed: DataFrame, given: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """parsed with the columns' values from given, one row a key, wherever those aren't blank."""
    other = given.select(key, *[blank_to_null(F.col(c).cast("string")).alias(f"__{c}") for c in columns])
    return parsed.join(other, key, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*[f"__{c}" for c in columns])


def content_section_type(text: Column, both: Column) -> Column:
    """What a text's head says of its section where the file name says nothing; both: whether the text has both headings."""
    head = F.left(text, F.lit(R.CONTENT_HEAD_CHARS))
    named = F.nullif(F.lower(F.regexp_extract(head, ANY_CASE + R.NAMED_SECTION, 1)), F.lit(""))
    out = F.when(both, "business+competition").when(named.isNotNull(), named)
    for pattern, kind in R.HEAD_SECTIONS:
        out = out.when(head.rlike(LINES + pattern), kind)
    return out


def node_cik(files: DataFrame, raw: DataFrame, stem: str = "stem") -> DataFrame:
    """files (stem, submitter_cik) with cik: of the raw file of the same stem, else the accession's first ten digits, else as parsed.

    raw: stem, cik, seen; of several rows for a stem the first seen counts. Stems are compared without a `_business` ending, in lower case.
    """
    key = lambda c: F.lower(F.trim(F.regexp_replace(c, "(?i)_business$", "")))
    first = raw.withColumn("__c", integer_cik(F.col("cik"))).filter("__c is not null").groupBy(key(F.col("stem")).alias("__stem")).agg(F.min_by("__c", "seen").alias("__raw"))
    joined = files.withColumn("__stem", key(F.col(stem))).join(first, "__stem", "left")
    accession = integer_cik(F.nullif(F.regexp_extract(F.get(F.split(stem, "__"), 2), r"^(\d{10})", 1), F.lit("")))
    return joined.withColumn("cik", F.coalesce("__raw", accession, F.col("submitter_cik"))).withColumn("from_raw", F.col("__raw").isNotNull()).drop("__stem", "__raw")


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in the given order, which should be total."""
    return df.orderBy(*order).limit(n)


def content_stats(df: DataFrame, text: str = "text", large: int = R.LARGE_CHARS) -> DataFrame:
    """Adds text_char_count, text_line_count, is_large and section_presence."""
    t = F.col(text)
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    business, competition = matches(t, R.BUSINESS_START, LINES), matches(t, R.COMPETITION_START, LINES)
    return df.withColumns({
        "text_char_count": F.length(t), "text_line_count": lines + F.when((t != "") & ~t.endswith("\n"), 1).otherwise(0), "is_large": F.length(t) > large,
        "section_presence": F.when(business & competition, "both").when(business, "business_only").when(competition, "competition_only").otherwise("neither"),
    })


def resolve_issuers(manifest: DataFrame, lookup: DataFrame) -> DataFrame:
    """lookup: accession, cik. Adds source_cik and source_cik_source: resolved if an accession has one CIK, ambiguous if more."""
    found = lookup.select("accession", integer_cik(F.col("cik")).alias("c")).filter("accession is not null and c is not null").groupBy("accession").agg(F.countDistinct("c").alias("__n"), F.min("c").alias("__c"))
    return manifest.join(found, "accession", "left").withColumns({
        "source_cik": F.when(F.col("__n") == 1, F.col("__c")), "source_cik_source": F.when(F.col("__n") == 1, "issuer_lookup").when(F.col("__n") > 1, "ambiguous").otherwise("missing"),
    }).drop("__n", "__c")


def is_excluded(name: Column) -> Column:
    """Funds, trusts and exchanges are no company nodes."""
    return F.coalesce(name.rlike(ANY_CASE + any_of(R.EXCLUDED_NAMES)), F.lit(False))


def company_nodes(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (one row per file) and the rows left out for want of a name or CIK."""
    rows = manifest.select("company_name", F.coalesce("source_cik", "submitter_cik").alias("cik"), "stem")
    whole = blank_to_null(F.col("company_name")).isNotNull() & blank_to_null(F.col("cik")).isNotNull()
    return rows.filter(whole & ~is_excluded(F.col("company_name"))), rows.filter(~whole)


def enrich(nodes: DataFrame, extra: DataFrame, position: str) -> DataFrame:
    """extra: cik, ticker, gics_sector; of several rows for a CIK the last by position counts, blank values change nothing."""
    last = extra.groupBy(integer_cik(F.col("cik")).alias("cik")).agg(F.max_by("ticker", position).alias("__t"), F.max_by("gics_sector", position).alias("__g"))
    joined = nodes.join(last, "cik", "left")
    return joined.withColumns({"ticker": F.coalesce(blank_to_null(F.col("__t")), F.lit("")), "gics_sector": F.coalesce(blank_to_null(F.col("__g")), F.lit(""))}).drop("__t", "__g")


def exclusion_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"(?U)\s+", " ")


def excluded_rows(df: DataFrame, names: DataFrame, name: str = "name", columns: Sequence[str] | None = None) -> DataFrame:
    """df with excluded: whether a cell, or a part of one between ` ; `, `;` or `,`, is one of the names. Joined by key, for any number of names."""
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns or df.columns])
    parts = F.concat(cells, F.flatten(F.transform(cells, lambda c: F.split(c, ";"))), F.flatten(F.transform(cells, lambda c: F.split(c, ","))))
    keyed = df.withColumn("__row", F.monotonically_increasing_id())
    keys = names.select(exclusion_key(F.col(name)).alias("__key")).filter("__key <> ''").distinct()
    hit = exploded(keyed, ["__row"], F.array_distinct(F.transform(parts, exclusion_key)), "__key").join(keys, "__key", "left_semi").select("__row").distinct().withColumn("__hit", F.lit(True))
    return keyed.join(hit, "__row", "left").withColumn("excluded", F.coalesce("__hit", F.lit(False))).drop("__row", "__hit")


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in an order that only key and seed decide."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def rewrite_path(path: Column, old: str, new: str) -> Column:
    """Replaces a path component, only as a whole, so doing it twice changes nothing."""
    return F.regexp_replace(path, rf"(^|/){old}(?=/|$)", f"$1{new}")


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """One row of each key, the first in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
