"""Folders by year, and tables below a root that are purged one by one. Paths are Hadoop paths."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.manifest import excluded_rows
from ..rules import filings as R
from . import readers, writers


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the folders right below base, in order; FileNotFoundError if there is no base."""
    fs, path = _files(spark, base)
    if not fs.exists(path):
        raise FileNotFoundError(base)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def cleaned_folders(spark: SparkSession, base: str, year: int | None = None) -> list[str]:
    """Folders of cleaned filings right below base, of all years or of one."""
    found = [(n, re.match(R.CLEANED_FOLDER, n, re.I)) for n in folders(spark, base)]
    return [f"{base.rstrip('/')}/{n}" for n, m in found if m and year in (None, int(m[1]))]


def business_folder(cleaned: str) -> str:
    """The folder of business sections that stands beside a folder of cleaned filings."""
    parent, _, name = cleaned.rstrip("/").rpartition("/")
    m = re.match(R.CLEANED_FOLDER, name, re.I)
    if not m:
        raise ValueError(f"{name} names no year of cleaned filings")
    return f"{parent}/{m[1]}_10K_business"


def tables_below(spark: SparkSession, root: str, skip: Sequence[str] = ()) -> list[str]:
    """Paths of all CSV files below root in order, but for those whose name or path is in skip."""
    fs, path = _files(spark, root)
    found, files = [], fs.listFiles(path, True)
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().lower().endswith(".csv") and at.getName() not in skip and str(at) not in skip:
            found.append(str(at))
    return sorted(found)


def purge_tree(spark: SparkSession, root: str, names: DataFrame, name: str = "name", skip: Sequence[str] = ()) -> DataFrame:
    """Rows with an excluded name go from every CSV below root. file, input_rows, removed_rows, output_rows of each file that lost some.

    Files are few and each is a job of its own; only its two counts reach the driver. A file without rows, or without such rows, stays.
    """
    report = []
    for path in tables_below(spark, root, skip):
        rows = excluded_rows(readers.csv(spark, path), names, name)
        total, gone = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("excluded").cast("long")), F.lit(0))).first()
        if gone:
            writers.rewrite_csv(rows.filter(~F.col("excluded")).drop("excluded"), path)
            report.append((path.removeprefix("file:").removeprefix(root.removeprefix("file:").rstrip("/") + "/"), total, gone, total - gone))
    return spark.createDataFrame(report, "file string, input_rows long, removed_rows long, output_rows long")
