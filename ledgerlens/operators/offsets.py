"""Spans and their texts: light normalisation that remembers offsets, the sentence around a span, attributes, types, scores.

A null text has no characters, a span outside its text maps to null; repeated rows are treated alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.patterns import bound
from ..rules import mentions as R

_GONE = frozenset(R.ZERO_WIDTH)
_BREAKS = ("at", "starts", "widths")
_NORMALISED = T.StructType([T.StructField("clean", T.StringType())] + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in _BREAKS])
#: Blanks and characters of no width, but for a space that stands alone, which stays where it is.
_ODD = re.compile(rf"[\s{R.ZERO_WIDTH}]{{2,}}|[^\S ]|[{R.ZERO_WIDTH}]")


def with_offsets(text: str | None) -> tuple[str, list[int], list[int]]:
    """text without characters of no width, blanks of any kind as one space; where each character begins and ends in the text."""
    out, starts, ends = [], [], []
    for at, c in enumerate(text or ""):
        if c in _GONE:
            continue
        blank = c.isspace()
        if blank and out and out[-1] == " ":
            ends[-1] = at + 1
        else:
            out.append(" " if blank else c)
            starts.append(at)
            ends.append(at + 1)
    return "".join(out), starts, ends


def with_breaks(text: str | None) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The clean text of with_offsets, and its offsets as breaks: character at[k] of it begins at starts[k] and is widths[k] wide in the text,
    those up to the next break follow one by one. Memory goes with the breaks, of which prose has few, not with the characters."""
    text, pieces, breaks, n, done = text or "", [], [(0, 0, 1)], 0, 0
    for m in _ODD.finditer(text):
        (begin, end), run = m.span(), m.group()
        pieces.append(text[done:begin])
        n, done = n + begin - done, end
        width, first = len(run.strip(R.ZERO_WIDTH)), end - len(run.lstrip(R.ZERO_WIDTH))
        if width:
            pieces.append(" ")
            if first > begin or width > 1:
                breaks.append((n, first, width))
            n += 1
        if not width or first + width < end:
            breaks.append((n, end, 1))
    pieces.append(text[done:])
    return "".join(pieces), *np.array(breaks, dtype=np.int32).T


@F.pandas_udf(_NORMALISED)
def normalized_with_offsets(texts: pd.Series) -> pd.DataFrame:
    """struct(clean, at, starts, widths) of each text, as with_breaks gives them."""
    return pd.DataFrame([with_breaks(t) for t in texts], columns=["clean", *_BREAKS])


def original_span(normalized: Column, start: Column, end: Column) -> Column:
    """struct(start, end) in the original of a span of the clean text; null if it is empty or reaches beyond it."""
    valid = (start >= 0) & (end > start) & (end <= F.length(normalized["clean"]))

    def end_of(k: Column, i: Column) -> Column:
        return F.get(normalized["starts"], k) + F.get(normalized["widths"], k) + i - F.get(normalized["at"], k)

    def in_break(i: Column, use: Callable[[Column], Column]) -> Column:
        return bound(F.size(F.filter(normalized["at"], lambda at: at <= i)) - 1, use)

    begins = in_break(start, lambda k: F.when(F.get(normalized["at"], k) == start, F.get(normalized["starts"], k)).otherwise(end_of(k, start) - 1))
    return F.when(valid, F.struct(begins.alias("start"), in_break(end - 1, lambda k: end_of(k, end - 1)).alias("end")))


def sentence_of_span(text: Column, sentences: Column, start: Column, end: Column) -> Column:
    """The sentence, of an array of struct(start, end) in order, that holds the span's middle; empty if none does."""
    middle = F.floor((start + end) / 2)
    held = F.filter(sentences, lambda s: (s["start"] <= middle) & (middle < s["end"]))
    first = F.get(held, 0)
    return F.coalesce(F.substr(text, first["start"] + 1, first["end"] - first["start"]), F.lit(""))


def entity_attribute(labels: Column) -> Column:
    """LOC before PRODUCT before ORG, whatever the case of the labels and with or without B- and I-."""
    plain = F.transform(labels, lambda x: F.regexp_replace(F.upper(x), "B-|I-", ""))
    out = F
    for name in R.ATTRIBUTES:
        out = out.when(F.array_contains(plain, name), name)
    return out.otherwise("ORG")


def typed(mention: Column, attribute: Column) -> Column:
    """TICKER by form, else by attribute; organisations otherwise."""
    out = F.when(F.trim(mention).rlike(R.TICKER), "TICKER")
    for name, kind in R.TYPE_OF_ATTRIBUTE:
        out = out.when(attribute == name, kind)
    return out.otherwise("ORGANIZATION")


def kept_labels(listed: str | None) -> tuple[str, ...]:
    """Labels of a list with commas, semicolons or blanks between, in upper case, each once."""
    return tuple(dict.fromkeys((listed or "").upper().replace(",", " ").replace(";", " ").split()))


def text_column(columns: Sequence[str], wanted: str = "auto") -> str:
    """The column that extractors read: the filtered mentions if there are any, else the window."""
    return wanted if wanted != "auto" else "org_mentions_union_filtered" if "org_mentions_union_filtered" in columns else "window_text"


def merge_labelled(spans: DataFrame, id_col: str = "window_id") -> DataFrame:
    """One row per window and offsets: text, extractors in order joined by +, and the attribute of all labels."""
    found = spans.groupBy(id_col, "start", "end").agg(F.min("text").alias("text"), F.array_join(F.array_sort(F.collect_set("extractor")), "+").alias("extractors"), F.collect_set("label").alias("__labels"))
    return found.withColumn("attribute", entity_attribute(F.col("__labels"))).withColumn("type", typed(F.col("text"), F.col("attribute"))).drop("__labels")


def span_scores(gold: DataFrame, found: DataFrame, id_col: str = "window_id") -> DataFrame:
    """scheme (strict, exact, partial, type), correct, incorrect, partial, missed, spurious, precision and recall.

    Both tables: id, start, end, type, spans of one table not overlapping each other. Each found span meets the gold span it shares most
    characters with, of equals the first; each gold span is met once.
    """
    g = gold.select(F.col(id_col).alias("i"), F.col("start").alias("gs"), F.col("end").alias("ge"), F.col("type").alias("gt"))
    f = found.select(F.col(id_col).alias("i"), F.col("start").alias("fs"), F.col("end").alias("fe"), F.col("type").alias("ft"))
    shared = F.least("ge", "fe") - F.greatest("gs", "fs")
    pairs = g.join(f, "i").withColumn("shared", shared).filter("shared > 0")
    best = lambda *by: F.row_number().over(Window.partitionBy("i", *by).orderBy(F.desc("shared"), "gs", "fs"))
    met = pairs.withColumn("n", best("fs", "fe")).filter("n = 1").withColumn("m", best("gs", "ge")).filter("m = 1")
    same, alike = (F.col("gs") == F.col("fs")) & (F.col("ge") == F.col("fe")), F.col("gt") == F.col("ft")
    counts = met.agg(F.count("*").alias("met"), F.count_if(same & alike).alias("strict"), F.count_if(same).alias("exact"), F.count_if(alike).alias("type"))
    totals = counts.crossJoin(g.agg(F.count("*").alias("gold"))).crossJoin(f.agg(F.count("*").alias("found")))  # one row each
    schemes = F.array(*[F.struct(F.lit(n).alias("scheme"), F.col(c).alias("correct"), (F.lit(0).cast("long") if n == "partial" else F.col("met") - F.col(c)).alias("incorrect"), (F.col("met") - F.col("exact") if n == "partial" else F.lit(0).cast("long")).alias("partial")) for n, c in (("strict", "strict"), ("exact", "exact"), ("partial", "exact"), ("type", "type"))])
    rows = totals.select(F.explode(schemes).alias("x"), "met", "gold", "found").select("x.*", (F.col("gold") - F.col("met")).alias("missed"), (F.col("found") - F.col("met")).alias("spurious"), "gold", "found")
    hits = F.col("correct") + F.col("partial") / 2
    return rows.select("scheme", "correct", "incorrect", "partial", "missed", "spurious", F.round(hits / F.greatest("found", F.lit(1)), 6).alias("precision"), F.round(hits / F.greatest("gold", F.lit(1)), 6).alias("recall"))


def labels_of(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])
