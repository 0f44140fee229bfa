"""Keeping the object table current from arriving approach files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from perigee.operators.objects import BUCKET_ROWS, drop_unreferenced, upsert_snapshot


def upsert_stream(
    spark: SparkSession,
    input_path: str,
    schema: T.StructType,
    table_root: str,
    seq: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
    keep_versions: int = 2,
) -> StreamingQuery:
    """Each batch turns the latest version into the next one by rewriting the buckets it touches.

    Batches are applied in arrival order, and inside a batch the row with the largest ``seq`` wins. The table notes
    the last batch of each checkpoint in the same commit, so a repeated batch changes nothing and any stream goes on
    from the latest version. Older versions than ``keep_versions`` are dropped. One stream writes a table at a time.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_snapshot(batch, seq, table_root, source=checkpoint, number=batch_id, bucket_rows=bucket_rows)
        drop_unreferenced(batch.sparkSession, table_root, keep_versions)

    return (
        reader.load(input_path).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
