"""Writers: routed documents, audits, buckets, exports, label cache, in-place rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def routed(df: DataFrame, path: str, by: Sequence[str] = ("route",), fmt: str = "parquet") -> None:
    """One folder per route (or bucket, category, year)."""
    df.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def audit(df: DataFrame, path: str, preferred: Sequence[str]) -> DataFrame:
    """JSON and CSV with the preferred columns first and the others by name."""
    first = [c for c in preferred if c in df.columns]
    out = df.select(*first, *sorted(set(df.columns) - set(first)))
    out.write.mode("overwrite").json(f"{path}/json")
    export_csv(out, f"{path}/csv")
    return out


def export_csv(df: DataFrame, path: str, excel: bool = False) -> None:
    """CSV with header. excel: with a byte order mark before the first column's name."""
    out = df.toDF(*[("\ufeff" if excel and k == 0 else "") + c for k, c in enumerate(df.columns)])
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def parse_issues(manifest: DataFrame) -> DataFrame:
    return manifest.filter(~F.col("parse_success") | (F.col("parse_notes") != ""))


def _files(spark, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _move(spark, source: str, target: str) -> None:
    fs, path = _files(spark, source)
    if not fs.rename(path, _files(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def _swap(spark, fresh: str, path: str) -> None:
    """fresh in the place of path. The old table stands beside it until the new one is in place, so a crash loses neither."""
    fs, old = _files(spark, path)
    fs.delete(_files(spark, path + ".old")[1], True)
    if fs.exists(old):
        _move(spark, path, path + ".old")
    _move(spark, fresh, path)
    fs.delete(_files(spark, path + ".old")[1], True)


def rewrite(df: DataFrame, path: str) -> None:
    """Replace what df may have been read from: write beside it, then swap."""
    df.write.mode("overwrite").parquet(path + ".new")
    _swap(df.sparkSession, path + ".new", path)


def rewrite_csv(df: DataFrame, path: str) -> None:
    """Replace one CSV file, which df may have been read from, by one file: for tables that a single task can write."""
    spark = df.sparkSession
    export_csv(df.coalesce(1), path + ".parts")
    fs, parts = _files(spark, path + ".parts")
    (part,) = [str(s.getPath()) for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-")]
    _move(spark, part, path + ".new")
    _swap(spark, path + ".new", path)
    fs.delete(parts, True)


def isolated_audit(df: DataFrame, path: str, preferred: Sequence[str] = ("doc_id", "route")) -> DataFrame:
    """The audit of isolated filings alone."""
    return audit(df.filter(F.startswith("route", F.lit("isolated/"))), path, preferred)


def mention_files(raw: DataFrame, unique: DataFrame, surplus: DataFrame, path: str, year: str = "") -> dict[str, str]:
    """The three mention tables of a run; year, if given, stands before their names."""
    tag, written = f"{year}_" if year else "", {}
    for name, df in (("mentions_raw", raw), ("mentions_nonraw", unique), ("org_diff", surplus)):
        written[name] = f"{path}/{tag}{name}"
        export_csv(df, written[name])
    return written


def backup(spark, paths: Sequence[str], folder: str, stamp: str) -> list[str]:
    """Move outputs that exist to folder/stamp; paths of what was moved."""
    moved = []
    for p in paths:
        fs, path = _files(spark, p)
        if fs.exists(path):
            fs.mkdirs(_files(spark, f"{folder}/{stamp}")[1])
            _move(spark, p, f"{folder}/{stamp}/{path.getName()}")
            moved.append(f"{folder}/{stamp}/{path.getName()}")
    return moved


def node_files(nodes: DataFrame, issues: DataFrame, excluded: DataFrame, path: str) -> None:
    """Nodes, and beside them issues and excluded names; of the latter two an older file goes where there is nothing to tell."""
    export_csv(nodes, f"{path}/nodes")
    for name, df in (("parse_issues", issues), ("excluded_companies", excluded.distinct())):
        fs, old = _files(df.sparkSession, f"{path}/{name}")
        if df.isEmpty():
            fs.delete(old, True)
        else:
            export_csv(df, f"{path}/{name}")


def bundle(requests: DataFrame, path: str) -> None:
    """Requests as CSV of one column, items_json, a batch a row."""
    export_csv(requests.select(F.col("request").alias("items_json")), path)


def merge_cache(cache: DataFrame | None, fresh: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Label cache with the new rows in place of old ones of the same key."""
    if cache is None:
        return fresh.dropDuplicates([key])
    both = cache.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.desc("__new"), order if order is not None else F.lit(0))
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__new", "__n")


def ordered_columns(columns: Sequence[str], leading: Sequence[str], tail: Sequence[str], minimal: bool = False) -> list[str]:
    """Leading columns, the others by name, long text columns last; minimal: the leading ones only."""
    first = [c for c in leading if c in columns]
    if minimal:
        return first
    last = [c for c in tail if c in columns and c not in first]
    return [*first, *sorted(c for c in columns if c not in first and c not in last), *last]


def label_requests(rows: DataFrame, fields: Sequence[str], batch: int) -> DataFrame:
    """batch_no and the request body of every `batch` rows, by a row_index column."""
    keyed = rows.withColumn("batch_no", F.floor(F.col("row_index") / batch).cast("long"))
    items = F.array_sort(F.collect_list(F.struct("row_index", *fields)))
    return keyed.groupBy("batch_no").agg(F.to_json(F.struct(items.alias("items"))).alias("request"))
