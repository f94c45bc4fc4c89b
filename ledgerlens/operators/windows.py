"""Cue windows: bounds, priority, hints, heading fallback, per-span choice and near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.patterns import ANY_CASE, any_of, bound, matches
from ..functions.rows import exploded
from ..rules import cues as R
from .sentences import sentences, with_cues, with_headings

COLUMNS = ("doc_id", "trigger_idx", "start_idx", "end_idx", "cue_group", "cue_tier", "cue_text", "window_priority", "heading_text", "heading_category", "trigger_sentence", "window_text", "hint", "demotion_reason", "is_fallback")


def profile_hint(text: Column, category: Column, group: Column) -> Column:
    has = lambda words: text.rlike(ANY_CASE + words)
    return (
        F.when(category == "competition_heading", "competition_market").when(category == "geography_channel_heading", "geography_channel").when(category == "customer_heading", "customer_use_case")
        .when(category == "product_service_heading", "products_services").when(has(R.GEOGRAPHY_WORDS), "geography_channel").when(has(R.CUSTOMER_WORDS) & (group != "implicit_or_broad"), "customer_use_case")
        .when(has(R.SEGMENT_WORDS), "segment").when(has(R.PRODUCT_WORDS) & (group == "implicit_or_broad"), "products_services").when(group.isin("strict_explicit", "contextual_explicit"), "competition_market").otherwise("unknown")
    )


def annotated(filings: DataFrame) -> DataFrame:
    return with_headings(with_cues(sentences(filings)))


def bounded(rows: DataFrame) -> DataFrame:
    """Bounds, priority, text and hint of the window of each row; fallbacks are one sentence of the lowest priority."""
    group, under, fallback = F.col("cue_group"), F.col("under_competition"), F.col("is_fallback")
    near = under | F.col("strict_nearby")
    reach = F.when(group == "strict_explicit", F.when(under, 1).otherwise(0)).when(group == "contextual_explicit", F.when(near, 2).otherwise(1)).otherwise(0)
    priority = F.when(group == "strict_explicit", F.when(under, 5).otherwise(4)).when(group == "contextual_explicit", F.when(near, 3).otherwise(2)).when(fallback, 0).otherwise(1)
    rows = rows.withColumn("start_idx", F.greatest(F.lit(0), F.col("idx") - reach)).withColumn("end_idx", F.least(F.col("n_sentences") - 1, F.col("idx") + reach))
    span = F.slice("around", F.col("start_idx") - F.greatest(F.lit(0), F.col("idx") - R.REACH) + 1, F.col("end_idx") - F.col("start_idx") + 1)
    rows = rows.withColumn("window_text", F.when(fallback, F.col("sentence")).otherwise(F.array_join(span, " ")))
    hint = F.when(fallback, "competition_market").otherwise(profile_hint(F.col("window_text"), F.col("heading_category"), group))
    return rows.select(
        "doc_id", F.col("idx").alias("trigger_idx"), "start_idx", "end_idx", "cue_group", "cue_tier", "cue_text", priority.alias("window_priority"), "heading_text", "heading_category",
        F.col("sentence").alias("trigger_sentence"), "window_text", hint.alias("hint"), F.coalesce("demotion_reason", F.lit("")).alias("demotion_reason"), "is_fallback",
    )


def fallback_rows(rows: DataFrame) -> DataFrame:
    """rows with fallback_heading, set at the first sentence with a word below a competition heading whose block has no cue below it."""
    block = Window.partitionBy("doc_id", "block").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    body = (F.col("block") > 0) & ~F.col("is_heading") & F.col("sentence").rlike(r"(?U)\w")
    rows = rows.withColumns({
        "__heading": F.first("sentence").over(block), "__cued": F.max(F.col("cue_group").isNotNull() & ~F.col("is_heading")).over(block), "__first": F.min(F.when(body, F.col("idx"))).over(block),
    })
    found = (F.col("idx") == F.col("__first")) & ~F.col("__cued") & matches(F.col("__heading"), R.FALLBACK_HEADINGS)
    return rows.withColumn("fallback_heading", F.when(found, F.col("__heading"))).drop("__heading", "__cued", "__first")


def candidate_windows(filings: DataFrame) -> DataFrame:
    """All windows, the best one of each span of sentences. Sentences are annotated once: a row has a cue, or a fallback, or neither.

    A null or empty text has no windows; rows that repeat a doc_id are taken for one document's and mix.
    """
    rows = fallback_rows(annotated(filings)).filter("cue_group is not null or fallback_heading is not null")
    # a sentence with a cue is no fallback, as its block then has a cue below the heading
    group, heading = F.col("cue_group"), F.col("fallback_heading")
    rows = rows.withColumns({
        "is_fallback": heading.isNotNull(), "cue_text": F.coalesce(heading, "cue_text"), "cue_tier": F.coalesce("cue_tier", F.lit(1)), "heading_text": F.coalesce(heading, "heading_text"),
        "heading_category": F.when(heading.isNotNull(), "competition_heading").otherwise(F.col("heading_category")), "demotion_reason": F.when(heading.isNull(), F.col("demotion_reason")), "cue_group": F.coalesce(group, F.lit("heading_fallback_broad")),
    })
    best = Window.partitionBy("doc_id", "start_idx", "end_idx").orderBy(F.desc("window_priority"), "is_fallback", "trigger_idx")
    return bounded(rows).withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")


def export_bucket(group: Column) -> Column:
    return F.when(group == "strict_explicit", "strict").when(group == "contextual_explicit", "contextual").otherwise("broad")


def bigrams(text: Column) -> Column:
    """The distinct pairs of neighbouring characters. They are cut from an array: each substring would walk over the text from its begin."""
    pairs = lambda chars: F.transform(F.slice(chars, 2, F.size(chars)), lambda c, i: F.concat(F.get(chars, i), c))
    return F.when(F.length(text) >= 2, F.array_distinct(bound(F.split(text, ""), pairs))).otherwise(F.array().cast("array<string>"))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of bigrams; two empty sets are alike."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(bound(F.size(F.array_intersect(a, b)), lambda shared: shared / (both - shared)))


def near_pairs(windows: DataFrame, gap: int = 5) -> DataFrame:
    """doc_id, trigger_idx, hint, other_idx, other_hint and overlap of the windows of a document of which the other begins 0 to gap sentences
    after the end of the first, whose trigger comes before its own.

    The windows are made once and met in a frame: no trigger of such a pair is farther off than the gap and the reach of both.
    """
    ahead = Window.partitionBy("doc_id").orderBy("trigger_idx").rangeBetween(1, gap + 2 * R.REACH)
    w = windows.select("doc_id", "trigger_idx", "start_idx", "end_idx", "hint", bigrams(F.col("window_text")).alias("bg"))
    others = F.collect_list(F.struct(F.col("trigger_idx").alias("other_idx"), "start_idx", F.col("hint").alias("other_hint"), "bg")).over(ahead)
    near = F.filter("others", lambda o: (o["start_idx"] - F.col("end_idx")).between(0, gap))
    pairs = exploded(w.withColumn("others", others), ["doc_id", "trigger_idx", "hint", "bg"], near, "o")
    return pairs.select("doc_id", "trigger_idx", "hint", "o.other_idx", "o.other_hint", F.round(overlap(F.col("bg"), F.col("o.bg")), 6).alias("overlap"))


def folded(windows: DataFrame, threshold: float = R.NEAR_DUPLICATE) -> DataFrame:
    """One row per document with windows: doc_id, how many it has (n), and those that drop_near_duplicates keeps (ws), as struct(row, dup, ...)."""
    key = F.struct((-F.col("window_priority")).alias("p"), (-F.col("cue_tier")).alias("t"), F.col("is_fallback").cast("int").alias("f"), F.col("trigger_idx").alias("i"), bigrams(F.col("window_text")).alias("bg"), F.lit(False).alias("dup"), F.struct(*windows.columns).alias("row"))
    groups = windows.groupBy("doc_id").agg(F.array_sort(F.collect_list(key)).alias("ws"))

    def fold(kept: Column, w: Column) -> Column:
        hit = F.transform(kept, lambda k: overlap(k["bg"], w["bg"]) >= threshold)
        marked = lambda first: F.transform(kept, lambda k, i: F.when(i + 1 == first, k.withField("dup", F.lit(True))).otherwise(k))
        return bound(F.array_position(hit, True), lambda first: F.when(first > 0, marked(first)).otherwise(F.concat(kept, F.array(w))))

    return groups.select("doc_id", F.size("ws").alias("n"), F.aggregate("ws", F.slice("ws", 1, 0), fold).alias("ws"))


def drop_near_duplicates(windows: DataFrame, threshold: float = R.NEAR_DUPLICATE) -> DataFrame:
    """Greedy within a document by falling priority and tier: a window that overlaps a kept one goes, the first such one is marked.

    A document's windows are few and bounded by its sentences, so they meet in one array with their columns, and are made once.
    """
    return exploded(folded(windows, threshold), [], F.col("ws"), "w").select("w.row.*", F.col("w.dup").alias("is_deduplicated"))


def export_order() -> list[Column]:
    """Exported windows by year, company and falling priority, then by place."""
    return [F.col("filing_year"), F.col("company"), F.desc("window_priority"), F.col("doc_id"), F.col("trigger_idx"), F.col("is_fallback")]


def duplicate_candidates(pairs: DataFrame, threshold: float = R.NEAR_DUPLICATE) -> DataFrame:
    """Pairs of near windows (overlap, hint, other_hint) that overlap by the threshold, or whose hint changes."""
    return pairs.filter((F.col("overlap") >= threshold) | (F.col("hint") != F.col("other_hint")))
