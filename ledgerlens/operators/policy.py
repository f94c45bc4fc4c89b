"""Mention policy: normalisation, keep / drop / review labels, list columns and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.patterns import first_reason
from ..rules import mentions as R


def normalized(mention: Column) -> Column:
    """Straight quotes, no quotes, bullets or blanks at the ends, single blanks. (For non-ASCII data: operators.cleaning.nfkc first.)"""
    m = F.translate(F.coalesce(mention, F.lit("")), R.CURLY, R.STRAIGHT)
    m = F.regexp_replace(m, r"(?U)\s+", " ")
    return F.btrim(m, F.lit(R.STRIPPED))


def fingerprint(name: Column) -> Column:
    """Lower-cased words without punctuation and without legal endings, of which at least one word stays."""
    f = F.trim(F.regexp_replace(F.regexp_replace(F.lower(normalized(name)), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))
    return F.regexp_replace(f, rf"(?<=\S)(\s+(?:{'|'.join(R.LEGAL_TAIL)}))+$", "")


def label(mention: Column, source: Column, keep: Sequence[str] = R.KEEP, drop: Sequence[str] = R.DROP) -> Column:
    """struct(label, reason) of a mention, given the company whose text it is in. The rules are tried in this order."""
    m = normalized(mention)
    low = F.lower(m)
    mine, own = fingerprint(mention), fingerprint(source)
    both = (F.length(mine) > 0) & (F.length(F.coalesce(own, F.lit(""))) > 0)
    inside = both & F.contains(F.concat(F.lit(" "), own, F.lit(" ")), F.concat(F.lit(" "), mine, F.lit(" ")))
    out = lambda kind, reason: F.struct(F.lit(kind).alias("label"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))
    junk = first_reason(m, R.DROP_PATTERNS, "(?U)")
    return (
        F.when(m == "", out("drop_obvious_junk", "empty_after_normalize")).when(low.isin(*keep), out("keep", "whitelist")).when(low.isin(*drop), out("drop_obvious_junk", "exact_drop"))
        .when(junk.isNotNull(), out("drop_obvious_junk", junk)).when(both & (mine == own), out("drop_obvious_junk", "self_source_full_match"))
        .when(inside & (F.length(mine) >= 8), out("drop_obvious_junk", "self_source_fragment")).when(inside, out("review", "self_source_fragment_review"))
        .when((F.length(m) == 1) & ~m.rlike(r"(?U)[\p{L}\p{N}]"), out("drop_obvious_junk", "single_non_alnum")).when(F.length(m) == 1, out("drop_obvious_junk", "single_letter"))
        .when(low.isin(*R.REVIEW), out("review", "review_exact")).when(m.rlike("^[A-Z]{2}$"), out("review", "short_all_caps_2")).otherwise(out("keep", "default_keep"))
    )


def split_list(c: Column, sep: str = R.SEPARATOR) -> Column:
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), sep, -1), lambda s: F.trim(s))
    return F.filter(parts, lambda x: x != "")


def type_counts(types: Column) -> Column:
    """`TYPE:n` by type, joined."""
    return F.array_join(F.transform(F.array_sort(F.array_distinct(types)), lambda t: F.concat(t, F.lit(":"), F.size(F.filter(types, lambda x: x == t)).cast("string"))), R.SEPARATOR)


def prefilter(rows: DataFrame, mentions: str = "org_mentions", types: str = "mention_types", source: str = "source_company") -> DataFrame:
    """Labels each mention of a list column and regroups the list: keep, drop and review lists, reasons, counts and counts by type."""
    names, kinds = split_list(F.col(mentions)), split_list(F.col(types))
    padded = F.transform(names, lambda _, i: F.coalesce(F.get(kinds, i), F.lit("COMPANY")))
    labeled = rows.withColumn("__names", names).withColumn("__types", padded)
    labeled = labeled.withColumn("__l", F.transform("__names", lambda n, i: F.struct(n.alias("n"), F.get(F.col("__types"), i).alias("t"), label(n, F.col(source)).alias("l"))))
    of = lambda kind: F.filter("__l", lambda x: x["l"]["label"] == kind)
    text = lambda items, part: F.array_join(F.transform(items, part), R.SEPARATOR)
    out = labeled
    for kind, short in (("keep", "keep"), ("drop_obvious_junk", "drop"), ("review", "review")):
        out = out.withColumns({f"mentions_{short}": text(of(kind), lambda x: x["n"]), f"{short}_reasons": text(of(kind), lambda x: x["l"]["reason"]), f"{short}_count": F.size(of(kind)), f"{short}_types": type_counts(F.transform(of(kind), lambda x: x["t"]))})
    return out.withColumn("union_count", F.size("__names")).withColumn("union_types", type_counts(F.col("__types"))).withColumn("removed_count", F.col("union_count") - F.col("keep_count")).drop("__names", "__types", "__l")


def safe_int(c: Column) -> Column:
    """A whole number that may have blanks around it, null for anything else."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))


def first_column(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of the named columns that df has; null without any."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast("string"))


def union_count(df: DataFrame, names: Sequence[str] = R.UNION_COUNT_NAMES, mentions: str = "org_mentions") -> Column:
    """The first count column that is there, if it holds a number, else the length of the list."""
    return F.coalesce(safe_int(first_column(df, names)), F.size(split_list(F.col(mentions))).cast("long"))


def parsed_counts(c: Column) -> Column:
    """`TYPE:n ; TYPE:n` as a map; parts without a number are left out, of equal types the last counts."""
    parts = F.filter(F.transform(split_list(c), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("t"), safe_int(F.substring(x, F.instr(x, ":") + 1, 1 << 30)).alias("n"))), lambda x: x["n"].isNotNull())
    last = F.filter(parts, lambda x, i: ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda y: y["t"] == x["t"]))
    return F.map_from_entries(last)


def removed_by_type(types: Column, kept: Column) -> Column:
    """How many of each type went: listed less kept, where that is over 0, as `TYPE:n` by type."""
    counted = parsed_counts(kept)
    rows = F.transform(F.array_sort(F.array_distinct(types)), lambda t: F.struct(t.alias("t"), (F.size(F.filter(types, lambda x: x == t)) - F.coalesce(F.try_element_at(counted, t), F.lit(0))).alias("n")))
    return F.array_join(F.transform(F.filter(rows, lambda x: x["n"] > 0), lambda x: F.concat(x["t"], F.lit(":"), x["n"].cast("string"))), R.SEPARATOR)


def clean_columns(rows: DataFrame) -> DataFrame:
    """CLEAN_COLUMNS of a prefilter's table: its counts and lists under whatever name they come, how many mentions went and of which types.

    Columns that rows lacks are empty.
    """
    text = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")) if n in rows.columns else F.lit("")
    union = F.coalesce(first_column(rows, R.UNION_NAMES).cast("string"), F.lit(""))
    size = lambda c: F.size(split_list(c))
    made = {
        "org_mentions_union": union, "org_mentions_union_count": F.coalesce(first_column(rows, R.UNION_COUNT_NAMES[:2]).cast("string"), size(union).cast("string")),
        "org_mentions_removed_count": (size(union) - size(text("org_mentions_union_filtered"))).cast("string"),
        "org_mentions_removed_count_by_type": removed_by_type(split_list(text("mention_types_union")), text("prefilter_keep_count_by_type")),
    }
    return rows.select(*[made.get(n, text(n)).alias(n) for n in R.CLEAN_COLUMNS])


def with_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """df with those of the named columns that it lacks, empty, behind its own."""
    return df.withColumns({n: F.lit("") for n in names if n not in df.columns})


def merge_dot_coms(spans: Column) -> Column:
    """spans: sorted array of struct(text, start, end). `Bill.` right before `com` becomes one span."""
    empty = F.slice(spans, 1, 0)

    def step(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joins = last.isNotNull() & last["text"].endswith(".") & (last["end"] == s["start"]) & F.lower(s["text"]).isin(*R.TLDS)
        merged = F.struct(F.concat(last["text"], s["text"]).alias("text"), last["start"].alias("start"), s["end"].alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, empty, step)


def rule_table(spark) -> DataFrame:
    """The policy's rules as rows: kind, pattern, reason, position. Flags stand in the patterns."""
    rows = [("keep", k, "whitelist") for k in R.KEEP] + [("drop", d, "exact_drop") for d in R.DROP] + [("drop_pattern", p, r) for p, r in R.DROP_PATTERNS] + [("review", r, "review_exact") for r in R.REVIEW]
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "rule_kind string, pattern string, reason string, position int")
