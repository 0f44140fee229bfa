"""Helpers the operators share: tables, batch mapping, model fitting with MLlib, small trees as SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.session import fresh_path

#: Rows handed to Python code at a time inside an Arrow batch.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, task: Callable[[], Callable[[list[list]], dict[str, list]]], schema: str) -> DataFrame:
    """Apply a function on column lists to blocks of rows.

    task() runs once per Spark task and returns the function, so that models are loaded once. Strings
    arrive as str, and only ROWS_AT_ONCE rows are Python objects at any time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = task()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                columns = work([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fit_boosted(samples: DataFrame, features: list[str], trees: int, depth: int, seed: int = 7) -> list[tuple]:
    """Gradient-boosted trees on a bounded table of labelled rows (columns features and label), as plain tuples.

    A tree is ("leaf", value) or ("split", feature index, threshold, left, right); left is taken where the
    feature is at most the threshold. The margin is the weighted sum of the trees.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=features, outputCol="features").transform(samples).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, minInstancesPerNode=5).fit(rows)

    def plain(node) -> tuple:
        if node.subtreeDepth() == 0:
            return ("leaf", float(node.prediction()))
        split = node.split()
        return ("split", int(split.featureIndex()), float(split.threshold()), plain(node.leftChild()), plain(node.rightChild()))

    return [(float(w), plain(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True)]


def boosted_margin(model: list[tuple], features: list[Column]) -> Column:
    """The margin of fit_boosted's trees as one SQL expression."""

    def expression(node: tuple) -> Column:
        if node[0] == "leaf":
            return F.lit(node[1])
        return F.when(features[node[1]] <= F.lit(node[2]), expression(node[3])).otherwise(expression(node[4]))

    total = F.lit(0.0)
    for weight, tree in model:
        total = total + F.lit(weight) * expression(tree)
    return total


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once for a row.

    A lambda variable can't be inlined again by the optimizer, and the expression stays out of whole-stage code,
    whose methods would grow too long for the JIT compiler here.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def packed(df: DataFrame, *needed: Column) -> DataFrame:
    """Whole rows as the struct `row`, beside the needed columns: helper columns can't clash with the rows' own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *needed)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written table in the shared folder: read again without its lineage, a column at a time."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
