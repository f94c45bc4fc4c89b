"""Readers: file trees, manifests, JSON lines, CSV, exclusion logs, enrichment tables. Paths are Hadoop paths."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cleaning import decode_text

SUFFIXES = (".txt", ".html", ".htm", ".xml")


def file_tree(spark: SparkSession, paths: str | Sequence[str], suffixes: Iterable[str] = SUFFIXES, content: bool = True) -> DataFrame:
    """path, length and decoded text of every file with one of the suffixes, each path once; without content only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    low = F.lower("path")
    wanted = None
    for s in suffixes:
        hit = low.endswith(s)
        wanted = hit if wanted is None else wanted | hit
    files = files.filter(wanted).dropDuplicates(["path"])
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select("path", "length", stem.alias("stem"), *([decode_text("content").alias("text")] if content else []))


def csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with header, quoted line ends and an optional byte order mark; all columns are text."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(paths)
    return df.toDF(*[c.lstrip("\ufeff").strip('"') for c in df.columns])


def json_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.json(paths)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest as CSV, or as JSON (an array or one object)."""
    return csv(spark, path) if path.lower().endswith(".csv") else spark.read.option("multiLine", True).json(path)


def any_format(spark: SparkSession, path: str) -> DataFrame:
    low = path.lower().rstrip("/")
    if low.endswith(".jsonl"):
        return json_lines(spark, path)
    if low.endswith((".csv", ".json")):
        return manifest(spark, path)
    return spark.read.parquet(path)


def union_all(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of any format below one another; columns that one lacks are null."""
    out = None
    for p in paths:
        df = any_format(spark, p)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no input paths")
    return out


def existing(spark: SparkSession, candidates: Sequence[str]) -> list[str]:
    """Those of the candidate paths (globs allowed) that exist."""
    out = []
    for c in candidates:
        path = spark._jvm.org.apache.hadoop.fs.Path(c)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        out += [str(f.getPath()) for f in found or []]
    return list(dict.fromkeys(out))


def discover(spark: SparkSession, base: str, year: str = "") -> list[str]:
    """Window files of a folder: bucket files, else JSON lines, else CSV."""
    tag = f"{year}_" if year else ""
    for names in ([f"{tag}candidate_windows_{b}.csv" for b in ("strict", "contextual", "broad")], [f"{tag}*windows*.jsonl"], [f"{tag}*windows*.csv"]):
        if found := existing(spark, [f"{base}/{n}" for n in names]):
            return found
    return []


def exclusions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """name: one per line of the logs; blank and heading lines are skipped."""
    return spark.read.text(paths).select(F.trim("value").alias("name")).filter(~F.col("name").rlike("(?i)^(excluded companies.*)?$")).distinct()


def issuer_paths(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """stem and cik of raw files whose folder is named by the CIK; contents aren't read."""
    files = file_tree(spark, paths, content=False)
    return files.select("stem", F.regexp_extract("path", r"/(\d{1,10})/[^/]+$", 1).alias("cik")).filter("cik <> ''")
