"""Key joins that stay balanced when one key, or a missing key, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.session import stable

ROWS_PER_SALT = 1_000_000
# Hot keys that are broadcast; there are fewer than a millionth of the rows of them.
BROADCAST_KEYS = 100_000
NULL_SALTS = 256


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "left",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """left/inner equi-join on ``keys`` where ``right`` holds each key once.

    Hot left keys (more than ``rows_per_salt`` rows) are looked for first, with a pre-aggregated count. Where there are none this is a
    plain join. Otherwise each hot key is cut into salts of about ``rows_per_salt`` rows and only its
    right row is repeated. Rows with a missing key match nothing and are spread over fixed salts.
    """
    present = left.where(~_missing(keys))
    hot = stable(
        present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > rows_per_salt)
        .select(*keys, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_salts"))
    )
    if how == "inner":
        left = present
    n_hot = hot.limit(BROADCAST_KEYS + 1).count()
    if not n_hot:
        salts, right = F.lit(1), right.withColumn("_salt", F.lit(0))
    else:
        salts = F.coalesce(F.col("_salts"), F.lit(1))
        side = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
        left = left.join(side, keys, "left")
        right = (
            right.join(side, keys, "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
            .drop("_salts")
        )
    spread_over = F.when(_missing(keys), F.lit(NULL_SALTS)).otherwise(salts)
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), spread_over).cast("int")).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _missing(keys: list[str]) -> Column:
    condition = F.col(keys[0]).isNull()
    for k in keys[1:]:
        condition = condition | F.col(k).isNull()
    return condition


def features_with_source(features: DataFrame, objects: DataFrame, spread: Column) -> DataFrame:
    """Feature rows with the name and body of their object; rows without a source keep NULLs.

    ``objects`` is the upserted table (one row per id).
    """
    source = objects.select(
        F.col("id").alias("sourceNeoId"),
        F.col("name").alias("source_name"),
        F.col("orbiting_body").alias("source_orbiting_body"),
    )
    return salted_join(features, source, ["sourceNeoId"], spread)


def orphan_features(features: DataFrame, objects: DataFrame, spread: Column) -> DataFrame:
    """Feature rows whose source id is not in the object table (a missing id is not an orphan)."""
    known = objects.select(F.col("id").alias("sourceNeoId"), F.lit(True).alias("_known"))
    linked = features.where(F.col("sourceNeoId").isNotNull())
    return salted_join(linked, known, ["sourceNeoId"], spread).where(F.col("_known").isNull()).drop("_known")


def align_rows(left: DataFrame, right: DataFrame, key: str = "approach_id") -> DataFrame:
    """Rows of two tables that belong together, by their unique row key."""
    return left.join(right, key, "inner")
