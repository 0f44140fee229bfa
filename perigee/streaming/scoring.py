"""Scoring arriving approach files with the batch scorer."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from perigee.operators.quality import accepted, quarantine, validate_inputs
from perigee.plans.scoring import Scorer


def score_stream(
    spark: SparkSession,
    input_path: str,
    schema: T.StructType,
    scorer: Scorer,
    scored_path: str,
    quarantine_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """Score every new file once; rows that break an input rule go to the quarantine table.

    Each micro-batch writes its own folder in overwrite mode, so a repeated batch replaces itself.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    checked = validate_inputs(reader.load(input_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scorer.score(accepted(batch)).write.mode("overwrite").parquet(f"{scored_path}/batch={batch_id}")
            quarantine(batch).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        checked.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
