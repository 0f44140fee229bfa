"""Corpus pipeline: stages that take documents one after the other, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from perigee.llm.bpe import digest_documents
from perigee.llm.common import table
from perigee.llm.decontaminate import drop_contaminated
from perigee.llm.neardup import keep_one
from perigee.llm.quality import keep_good
from perigee.llm.secrets import redact
from perigee.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    # rejected documents go
    ("quality_rules", lambda spark, docs, sf_dir: keep_good(docs)),
    # one document of each group of near copies stays
    ("near_duplicates", lambda spark, docs, sf_dir: keep_one(docs)),
    # documents that hold a benchmark item go
    ("decontamination", lambda spark, docs, sf_dir: drop_contaminated(docs, table(spark, sf_dir, "benchmark"))),
    # secrets are replaced by marks
    ("secret_scans", lambda spark, docs, sf_dir: redact(docs)),
    # counts and digests of what is left
    ("bpe_encode_decode", lambda spark, docs, sf_dir: digest_documents(docs)),
]

#: No SQL expresses boosted, hashed and byte-pair stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage works on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
