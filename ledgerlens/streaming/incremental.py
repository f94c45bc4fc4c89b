"""Incremental arrival of filings: the batch operators on micro-batches, with an idempotent sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import candidate_windows


def windows_of_arrivals(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Reads new Parquet files of (doc_id, text) below source and writes their windows below sink, one folder per batch.

    A batch that is run again after a failure writes its folder again, so no window comes twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        candidate_windows(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
