"""Explicit windows: stable schema, filter, order, exact deduplication and numbering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.patterns import blank_to_null

EXPLICIT_GROUPS, EXPLICIT_BUCKETS = ("strict_explicit", "contextual_explicit"), ("strict", "contextual")


def coalesce_columns(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each wanted column from the first of its names that isn't blank in the row; absent columns are empty."""
    return df.select(*[F.coalesce(*[blank_to_null(F.col(n).cast("string")) for n in names if n in df.columns], F.lit("")).alias(out) for out, names in wanted.items()])


def numbered(df: DataFrame, order: Sequence, prefix: str, name: str) -> DataFrame:
    """Ids prefix + 7 digits over a total order: ranges are numbered apart and joined by their offsets, so no task holds all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    own = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = own.groupBy("__part").agg(F.max("__n").alias("__size"))
    offsets = sizes.select(F.col("__part"), F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return own.join(offsets, "__part").withColumn(name, F.format_string(f"{prefix}%07d", (F.col("__n") + F.col("__before")).cast("long"))).drop("__part", "__n", "__before")


def explicit_windows(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Strict and contextual windows, exact duplicates of all columns but the id once; keys: the order that ids follow."""
    kept = windows.filter(F.col("cue_group").isin(*EXPLICIT_GROUPS) | F.col("export_bucket").isin(*EXPLICIT_BUCKETS)).distinct()
    return numbered(kept, keys, "EXPW", "explicit_id")
