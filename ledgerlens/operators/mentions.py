"""Mention spans: gazetteer extraction, types, merging, aggregation per window, differences, owner resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.patterns import ANY_CASE, bound
from ..functions.rows import exploded
from ..rules import mentions as R

PATTERNS = (("pattern_a", r"\b(?:Supplier|Customer)#\d+"), ("pattern_b", r"\b(?:Customer#\d+(?:, Inc\.)?|Europe|U\.S\.)"))


def extract_spans(windows: DataFrame, patterns: tuple[tuple[str, str], ...] = PATTERNS, id_col: str = "window_id", text_col: str = "window_text") -> DataFrame:
    """Stand-in for the neural extractors: all matches of each pattern with their character offsets. Other extractors give the same columns."""
    return exploded(windows, [id_col], F.concat(*[_matches(F.col(text_col), name, pattern) for name, pattern in patterns]), "__x").select(id_col, "__x.*")


def _matches(text: Column, name: str, pattern: str) -> Column:
    """Array of struct(text, start, end, extractor): before the end of a match stand the pieces and matches up to it."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(pieces.alias("p"), found.alias("m")), lambda x: F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0)))

    def placed(match: Column, k: Column) -> Column:
        end = F.aggregate(F.slice(lengths, 1, k + 1), F.lit(0), lambda acc, x: acc + x)
        return F.struct(match.alias("text"), (end - F.length(match)).alias("start"), end.alias("end"), F.lit(name).alias("extractor"))

    return F.transform(found, placed)


def merge_spans(spans: DataFrame, id_col: str = "window_id") -> DataFrame:
    """One row per window and offsets, with the extractors that found it."""
    return spans.groupBy(id_col, "start", "end").agg(F.min("text").alias("text"), F.array_join(F.array_sort(F.collect_set("extractor")), "+").alias("extractors"))


def mention_type(text: Column) -> Column:
    return F.when(text.rlike(r"^[A-Z]{1,5}$|^[A-Z]{1,5}\.[A-Z]$"), "TICKER").when(text.isin("Europe", "U.S."), "REGION").otherwise("ORGANIZATION")


def _collected(spans: DataFrame, id_col: str) -> DataFrame:
    one = F.array_sort(F.collect_list(F.struct("start", "end", "extractors", "text", mention_type(F.col("text")).alias("type"))))
    return spans.groupBy(id_col).agg(one.alias("__all"))


def _joined(part: str) -> Column:
    return F.coalesce(F.array_join(F.filter(F.transform("__all", lambda x: x[part].cast("string")), lambda s: s != ""), R.SEPARATOR), F.lit(""))


def mentions_raw(windows: DataFrame, merged: DataFrame, id_col: str = "window_id") -> DataFrame:
    """Per window all mentions in order; windows without any have an empty list and 0."""
    joined = windows.select(id_col).join(_collected(merged, id_col), id_col, "left")
    return joined.select(id_col, F.coalesce(F.size("__all"), F.lit(0)).alias("n_mentions"), _joined("text").alias("mentions"), _joined("start").alias("starts"), _joined("type").alias("types"))


def _ranked(merged: DataFrame, id_col: str) -> DataFrame:
    w = Window.partitionBy(id_col, F.lower("text")).orderBy("start", "end")
    return merged.withColumn("__n", F.row_number().over(w))


def mentions_unique(windows: DataFrame, merged: DataFrame, id_col: str = "window_id") -> DataFrame:
    """Per window the first mention of each text, whatever its case."""
    return mentions_raw(windows, _ranked(merged, id_col).filter("__n = 1").drop("__n"), id_col)


def mention_surplus(merged: DataFrame, id_col: str = "window_id") -> DataFrame:
    """The mentions that mentions_unique leaves out."""
    return _ranked(merged, id_col).filter("__n > 1").select(id_col, F.col("text").alias("raw_mention"), "start", "end", F.lit("duplicate_in_window").alias("diff_reason"))


def competitor_phrases(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Phrases of at least 15 characters by four patterns, each once per text whatever its case; the first spelling stays.

    No match goes beyond a mark of R.PHRASE_ENDS, so patterns that need a word of competition, one of them slow, see only the clauses with one.
    """
    phrases = lambda t, patterns: F.concat(*[F.transform(F.regexp_extract_all(t, F.lit(ANY_CASE + p), 1), lambda x: F.trim(x)) for p in patterns])
    clauses = F.filter(F.split(F.col(text_col), f"(?<={R.PHRASE_ENDS})"), lambda s: s.rlike(ANY_CASE + R.PHRASE_STEM))
    found = F.concat(phrases(F.col(text_col), R.PHRASES[:1]), bound(F.array_join(clauses, ""), lambda t: phrases(t, R.PHRASES[1:])))
    unique = F.aggregate(F.filter(found, lambda x: F.length(x) >= 15), F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return exploded(df, [id_col], unique, "phrase")


def filtered_out(rows: DataFrame, union: Column, kept: Column) -> DataFrame:
    """Multiset difference of two list columns over all rows: mention, removed."""
    count = lambda c, n: exploded(rows, [], c, "mention").groupBy("mention").agg(F.count("*").alias(n))
    both = count(union, "a").join(count(kept, "b"), "mention", "left")
    return both.select("mention", (F.col("a") - F.coalesce("b", F.lit(0))).alias("removed")).filter("removed > 0")


def name_key(name: Column, loose: bool = False) -> Column:
    """Letters and digits of a name's words; loose: without legal words at the end."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z0-9]+"), 0)
    joined = F.array_join(words, " ")
    return F.trim(F.regexp_replace(joined, rf"(?:(?:^|\s+)(?:{'|'.join(R.LEGAL_SUFFIXES)}))+$", "")) if loose else joined


def vote(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each key, of equals the one seen first."""
    counts = rows.filter(F.col(key) != "").groupBy(key, value).agg(F.count("*").alias("__c"), F.min(order).alias("__f"))
    return counts.groupBy(key).agg(F.max_by(value, F.struct("__c", -F.col("__f"))).alias(value), F.sum("__c").alias("votes"))


def owner_cik(rows: DataFrame, companies: DataFrame, owner: str = "owner") -> DataFrame:
    """companies: name, cik, seen. The CIK that an owner's name votes for, by its strict key, then by its loose one."""
    strict = vote(companies.withColumn("k", name_key(F.col("name"))), "k", "cik", "seen").select(F.col("k").alias("__ks"), F.col("cik").alias("__cs"))
    loose = vote(companies.withColumn("k", name_key(F.col("name"), True)), "k", "cik", "seen").select(F.col("k").alias("__kl"), F.col("cik").alias("__cl"))
    keyed = rows.withColumn("__ks", name_key(F.col(owner))).withColumn("__kl", name_key(F.col(owner), True))
    return keyed.join(strict, "__ks", "left").join(loose, "__kl", "left").withColumn("owner_cik", F.coalesce("__cs", "__cl", F.lit(""))).drop("__ks", "__kl", "__cs", "__cl")


def pipeline_role(label: Column, owner: Column) -> Column:
    l, o = F.trim(F.coalesce(label, F.lit(""))), F.trim(F.coalesce(owner, F.lit("")))
    out = F
    for name, role in R.ROLES:
        out = out.when((l == name) & ((o != "") if name == "PRODUCT_BRAND" else F.lit(True)), role)
    return out.otherwise("ignore_or_review")


def cache_key(mention: Column, company: Column, sentence: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[F.trim(F.coalesce(c, F.lit(""))) for c in (mention, company, sentence)]), 256)


LABEL_SCHEMA = "labels array<struct<row_index: int, llm_label: string, llm_owner_company_candidate: string>>"


def parse_labels(raw: Column) -> Column:
    """Labels of a response, code fences taken off; labels that aren't known become OTHER; null if it is no such JSON."""
    body = F.regexp_replace(F.trim(raw), r"(?s)^```(?:json)?\s*|\s*```$", "")
    parsed = F.from_json(body, LABEL_SCHEMA)["labels"]
    return F.transform(parsed, lambda x: x.withField("llm_label", F.when(x["llm_label"].isin(*R.LABELS), x["llm_label"]).otherwise("OTHER")))


def missing_labels(rows: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """What isn't labelled yet, each key once."""
    return rows.join(cache.select(key), key, "left_anti").dropDuplicates([key])
