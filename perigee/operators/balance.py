"""Class balancing: weights and synthetic minority rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.functions.columns import hash_text, hash_uniform, hash_word
from perigee.operators.neighbours import LEAF_ROWS, nearest_neighbours
from perigee.operators.scaling import fit_scaler
from perigee.operators.splits import SEED, cut_by_hash
from perigee.session import stable


def class_weights(df: DataFrame, label: str = "hazardous") -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    classes = W.partitionBy()  # over the class rows only
    return counts.withColumn(
        "weight", F.sum("rows").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("rows")))


def weight_column(df: DataFrame, label: str) -> Column:
    """The balanced weights as a column over a 0/1 label."""
    weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    return F.when(F.col(label).cast("int") == 1, F.lit(weights.get(1, 1.0))).otherwise(F.lit(weights.get(0, 1.0)))


# Copies of one row that a task makes at a time.
COPIES_AT_ONCE = 1_000


def smote_demand(train: DataFrame, label: str = "hazardous") -> tuple[int, int, int]:
    """The minority class (1 if both are equally large), its rows and the number of synthetic rows it lacks."""
    row = train.agg(
        F.count_if(F.col(label).cast("int") == 1).alias("pos"),
        F.count_if(F.col(label).cast("int") == 0).alias("neg"),
    ).first()
    minority = 1 if row["pos"] <= row["neg"] else 0
    few, many = sorted((row["pos"], row["neg"]))
    return minority, few, many - few


def synthetic_rows(
    train: DataFrame,
    features: list[str],
    label: str = "hazardous",
    key: str = "approach_id",
    k: int = 5,
    seed: int = SEED,
    scale_first: bool = False,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """New minority rows on the lines between minority rows and their nearest neighbours.

    The wanted number is spread evenly over the minority rows; the rows that take one more are
    chosen by seeded hash. Neighbour and position on the line come from a hash of (row, copy).
    """
    return _grown(train, smote_demand(train, label), features, label, key, k, seed, scale_first, leaf_rows)


def _grown(
    train: DataFrame, demand: tuple[int, int, int], features: list[str], label: str, key: str, k: int, seed: int,
    scale_first: bool, leaf_rows: int,
) -> DataFrame:
    minority_class, minority_rows, wanted = demand
    if wanted and minority_rows < 2:
        raise ValueError("at least two minority rows are needed")
    each, extra = divmod(wanted, max(minority_rows, 1))
    minority = stable(train.where(F.col(label).cast("int") == minority_class).select(key, *features))
    base = cut_by_hash(
        minority, key, lambda n: [F.lit(extra)], [each + 1, each], seed=f"{seed}:extra", out="copies")
    scaler = fit_scaler(minority, features) if scale_first else None
    if scaler:
        base = scaler.transform(base)
    neighbours = nearest_neighbours(base, key, features, k, leaf_rows, keep=["copies"])
    copies = neighbours.where(F.col("copies") > 0).withColumn(
        "_first", F.explode(F.sequence(F.lit(1), F.col("copies"), F.lit(COPIES_AT_ONCE))))
    if each >= COPIES_AT_ONCE:
        copies = copies.repartition(key, "_first")
    digest = hash_text(f"{seed}:smote", key, "copy")
    grown = (
        copies.withColumn("copy", F.explode(F.sequence(
            F.col("_first"), F.least(F.col("copies"), F.col("_first") + F.lit(COPIES_AT_ONCE - 1)))))
        .withColumn("_d", digest)
        .withColumn("_nn", F.col("neighbours")[
            F.pmod(hash_word(F.col("_d"), 0), F.size("neighbours")).cast("int")])
        .withColumn("_u", hash_uniform(F.col("_d"), 1))
    )
    values = [
        (F.col("x")[i] + F.col("_u") * (F.col("_nn.x")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(features)
    ]
    if scaler:
        values = [
            (v * F.lit(scaler.stds[c] or 1.0) + F.lit(scaler.means[c])).alias(c) for v, c in zip(values, features)
        ]
    return grown.select(
        F.concat_ws("#", key, "copy").alias("row_key"),
        F.col(key).alias("base_key"),
        F.col("_nn.key").alias("neighbour_key"),
        "copy",
        *values,
    )


def synthetic_training_rows(
    train: DataFrame,
    features: list[str],
    label: str = "hazardous",
    key: str = "approach_id",
    k: int = 5,
    seed: int = SEED,
    scale_first: bool = False,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The synthetic rows with row_key, features, label and the synthetic flag.

    They are checkpointed, so reading them again does not repeat the neighbour search.
    """
    demand = smote_demand(train, label)
    return stable(_grown(train, demand, features, label, key, k, seed, scale_first, leaf_rows).select(
        "row_key", *features, F.lit(demand[0]).alias(label), F.lit(True).alias("synthetic")
    ))


def with_synthetic(train: DataFrame, new: DataFrame, features: list[str], label: str, key: str) -> DataFrame:
    """Training rows and synthetic rows in one table: row_key, key (NULL if synthetic), features, label, flag."""
    original = train.select(
        F.col(key).cast("string").alias("row_key"), key, *features,
        F.col(label).cast("int").alias(label), F.lit(False).alias("synthetic"),
    )
    return original.unionByName(new, allowMissingColumns=True)


def smote(
    train: DataFrame,
    features: list[str],
    label: str = "hazardous",
    key: str = "approach_id",
    k: int = 5,
    seed: int = SEED,
    scale_first: bool = False,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Training rows plus synthetic minority rows, so that both classes are equally large."""
    new = synthetic_training_rows(train, features, label, key, k, seed, scale_first, leaf_rows)
    return with_synthetic(train, new, features, label, key)
