"""Rows from arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def exploded(rows: DataFrame, keep: list[str], array: Column, name: str) -> DataFrame:
    """One row per element of array, null elements too; none for an empty or null array.

    For a plain explode the optimizer adds a filter on the array's size, below it and below exchanges, that computes the array twice
    more. That is worth it for a stored array, and not for one that is computed from a text.
    """
    return rows.select(*keep, F.posexplode_outer(array).alias("__pos", name)).filter("__pos is not null").drop("__pos")


def with_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with the column name of value, which is computed once a row even where a filter uses it as well as what follows.

    A filter on a plain column is moved below the projection that makes it, and computes it again, by a second set of Python workers
    if it is a Python function. Nothing is moved below an explode whose result it needs.
    """
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def in_small_batches(rows: DataFrame, records: int = 500, size: str = "2m") -> DataFrame:
    """rows, after the session is told to hand texts to Python functions in Arrow batches of few rows and bytes.

    A worker holds a batch and what it makes of it at once. Spark's bounds, 10,000 rows and 64 MB, are many times that for whole texts.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return rows
