"""Shared plumbing of the training-data operators: staging in the shared folder, skew-proof key joins, Arrow helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: At most this many keys are broadcast by join_unique; a key counts as hot from one part in HOT_KEYS of all rows.
HOT_KEYS = 1000
#: Of staged tables: a task holds a row group in memory until it is whole.
ROW_GROUP_BYTES = 32 << 20


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset (local runs)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. It is removed when the session's process ends, like a checkpoint."""
    path = f"{work_dir(spark)}/ledgerlens-{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
        except Exception:  # noqa: BLE001  the session may be gone; the cluster's own clean-up takes the folder
            pass

    atexit.register(remove)
    return path


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def arrow_bounds(spark: SparkSession, rows: int = 2000, size: str = "16m") -> None:
    """Bound the Arrow batches by rows and bytes, so that batches of very long texts stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Each batch as Arrow arrays of the named columns."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(batch.column(batch.schema.get_field_index(n)) for n in names)


def record_batch(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def join_unique(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of rows with table, which has one row per key and in count the number of rows with that key.

    Keys that hold at least one part in HOT_KEYS of all rows number HOT_KEYS at most; only those are broadcast, so that a key
    with a third of all rows isn't dealt to one task. All other keys take an ordinary shuffled join. No row is lost.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    least = max(64, -(-total // HOT_KEYS))
    hot = table.filter(F.col(count) >= least)
    cold = table.filter(F.col(count) < least)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def join_hot_left(rows: DataFrame, table: DataFrame, key: str, count: str, spread: Column) -> DataFrame:
    """Left join of rows with table in one pass over rows; table as for join_unique, without rows for keys that have none.

    Hot keys are broadcast; rows that found theirs go on through the shuffle spread by `spread`, so no task gets a hot key.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    least = max(64, -(-total // HOT_KEYS))
    values = [c for c in table.columns if c not in (key, count)]
    hot = table.filter(F.col(count) >= least).select(key, F.struct(*values).alias("__hot"))
    cold = table.filter(F.col(count) < least).select(key, F.lit(0).alias("__salt"), F.struct(*values).alias("__cold"))
    first = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", F.when(F.col("__hot").isNull(), 0).otherwise(F.pmod(spread, F.lit(1 << 20)).cast("int") + 1))
    second = first.join(cold, [key, "__salt"], "left")
    return second.select(*rows.columns, *[F.coalesce(F.col(f"__hot.{v}"), F.col(f"__cold.{v}")).alias(v) for v in values])


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    arrow_bounds(df.sparkSession)
    return df.mapInArrow(function, schema)
