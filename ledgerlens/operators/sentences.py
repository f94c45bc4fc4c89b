"""Sentences, headings and cues of filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.patterns import LINES, any_of, first_match, first_reason, has_word, matches
from ..rules import cues as R

#: Stands for a full stop that ends no sentence, in the SQL and so in texts that hold it.
_MARK = "\x01"
#: After the blank behind a full stop: this isn't the full stop of an abbreviation. The first one of e.g. has no blank behind it.
_NO_ABBREVIATION = rf"(?<!(?i:\b(?:{'|'.join((*R.ABBREVIATIONS, *(rf'{a}\.{b}' for a, b in R.DOTTED_ABBREVIATIONS)))})\.)\s)"
#: Unicode's white space.
_BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def sentence_array(text: Column) -> Column:
    """Sentences of a text in order: split after . ! ? before a capital or quote, after . ! ? at line ends, and at blank lines."""
    t = F.when(F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")), F.regexp_replace(text, r"[ \t]{2,}|\t", " ")).otherwise(text)
    # one pattern, that begins with a blank and looks back from it: every pass over a text costs, and a word boundary tried at every place most
    parts = F.split(t, rf"(?U)\s(?<=[.!?]\s){_NO_ABBREVIATION}\s*(?=[A-Z\"])|\n(?<=[.!?]\n){_NO_ABBREVIATION}\n*|\n{{2,}}")
    return F.filter(F.transform(parts, lambda s: F.btrim(F.replace(s, F.lit(_MARK), F.lit(".")), F.lit(_BLANKS))), lambda s: s != "")


def is_heading(s: Column) -> Column:
    n = F.length(s)
    upper = (F.upper(s) == s) & (F.lower(s) != s) & (n >= 3)
    capitalised = s.rlike(r"(?U)^[A-Z][^a-z]*(?:\s+[A-Z][^\s]*)*\s*:?\s*$") & (n < 80)
    return (n > 0) & (n <= R.HEADING_LENGTH) & ~s.rlike(r"[a-z]\.[A-Z]") & (((n <= 80) & ~s.endswith(".")) | upper | capitalised | s.endswith(":"))


def heading_category(s: Column) -> Column:
    out = F
    for name, patterns in R.HEADINGS:
        out = out.when(s.rlike(LINES + any_of(patterns)), name)
    return out.otherwise("general_business_heading")


def sentences(filings: DataFrame) -> DataFrame:
    """doc_id, n_sentences, idx and sentence, one row per sentence.

    Documents are dealt by id before they are split: all windows over a document's sentences then do without another shuffle,
    and a table in few large row groups is worked on by all cores. The outer explode keeps the optimizer from adding a filter on the
    array's size, which would split every text twice more, and before the documents are dealt.
    """
    parts = int(filings.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that it isn't coalesced: the work is in the patterns
    split = filings.select("doc_id", "text").repartition(parts, "doc_id").select("doc_id", sentence_array(F.col("text")).alias("all"))
    return split.select("doc_id", F.size("all").alias("n_sentences"), F.posexplode_outer("all").alias("idx", "sentence")).filter("idx is not null")


def with_cues(rows: DataFrame) -> DataFrame:
    """Adds demotion_reason, cue_group, cue_text, cue_tier. Plain words and one combined test keep most sentences from the single patterns."""
    s, cue = F.col("sentence"), F.col("__cue")
    guard = has_word(s, R.CUE_WORDS) & matches(s, (*R.STRICT, *R.CONTEXTUAL, *R.IMPLICIT))
    rows = rows.withColumn("__cue", guard)  # a column of its own, and each of its users too, so that no pattern is tried twice
    rows = rows.withColumns({"demotion_reason": F.when(cue, first_reason(s, R.DEMOTIONS)), **{n: F.when(cue, first_match(s, p)) for n, p in (("__s", R.STRICT), ("__c", R.CONTEXTUAL), ("__i", R.IMPLICIT))}}).drop("__cue")
    reason = F.col("demotion_reason")
    suppressed = F.coalesce(reason != R.GENERIC_ADVANTAGE, F.lit(False))
    group = F.when(F.col("__s").isNotNull(), "strict_explicit").when(F.col("__c").isNotNull(), F.when(~suppressed, "contextual_explicit")).when(F.col("__i").isNotNull() & reason.isNull(), "implicit_or_broad")
    rows = rows.withColumn("cue_group", group)
    tier = F.when(F.col("cue_group") == "strict_explicit", 4).when(F.col("cue_group") == "contextual_explicit", 3).when(F.col("cue_group") == "implicit_or_broad", 2)
    return rows.withColumn("cue_text", F.when(F.col("cue_group").isNotNull(), F.coalesce("__s", "__c", "__i"))).withColumn("cue_tier", tier).withColumn("is_strict", F.col("__s").isNotNull()).drop("__s", "__c", "__i")


def with_headings(rows: DataFrame) -> DataFrame:
    """Adds is_heading, is_competition (a competition heading pattern, heading line or not), nearest heading, block and, to cues, the sentences around.

    Few sentences are cues: to copy its neighbours to each made every later sort several times the size of the text.
    """
    doc = Window.partitionBy("doc_id").orderBy("idx")
    back = doc.rowsBetween(-R.LOOKBACK, 0)
    s = F.col("sentence")
    rows = rows.withColumn("is_heading", is_heading(s)).withColumn("is_competition", has_word(s, R.CUE_WORDS[:1]) & matches(s, R.HEADINGS[0][1], LINES))
    near = F.last(F.when(F.col("is_heading"), F.struct(s.alias("text"), heading_category(s).alias("category"))), ignorenulls=True).over(back)
    return rows.select(
        "*",
        near.alias("__near"),
        F.max("is_competition").over(back).alias("under_competition"),
        (F.coalesce(F.max("is_strict").over(doc.rowsBetween(-R.NEARBY, -1)), F.lit(False)) | F.coalesce(F.max("is_strict").over(doc.rowsBetween(1, R.NEARBY)), F.lit(False))).alias("strict_nearby"),
        F.when(F.col("cue_group").isNotNull(), F.array_compact(F.array(*[F.lag("sentence", -k).over(doc) for k in range(-R.REACH, R.REACH + 1)]))).alias("around"),
        F.sum(F.col("is_heading").cast("int")).over(doc.rowsBetween(Window.unboundedPreceding, 0)).alias("block"),
    ).select("*", F.coalesce("__near.text", F.lit("")).alias("heading_text"), F.coalesce("__near.category", F.lit("no_heading")).alias("heading_category")).drop("__near")
