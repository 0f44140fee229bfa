"""Exact seeded splits and folds without ordering the table.

Rows are ordered by a seeded hash inside each class. A histogram over the first four hex digits
(at most 65,536 bins per class) locates the bin of every cut. Where such a bin holds too many rows to
be ordered in one task, the next digits divide it again, until it doesn't; only rows of those bins are ranked.
What comes back is the (hash, key) of one row per class and cut. Labelling is then a plain column
expression: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.functions.columns import hash_text

SEED = 42
SPLIT_NAMES = ["train", "val", "test"]
#: Hex digits that a round adds to a bin's prefix, and digits of a hash.
STEP, HASH_DIGITS = 4, 32
#: Rows of a bin that one task may rank.
RANK_ROWS = 1_000_000
_WANTED = "s int, cut int, prefix string, rank long"

Cuts = Callable[[Column], list[Column]]


def _stratum(label: str | None) -> Column:
    """1, 0 or -1 (missing); any other label is an error, as it would be mixed into one of these classes."""
    if label is None:
        return F.lit(0)
    value = F.col(label).cast("int")
    other = F.raise_error(F.concat(F.lit("labels must be 0 or 1, found "), value.cast("string"))).cast("int")
    return F.when(value.isNull(), -1).when(value.isin(0, 1), value).otherwise(other)


def _position(seed: int | str, key: str) -> Column:
    return F.struct(hash_text(seed, key).alias("h"), F.col(key).alias("k"))


def _bins_of_cuts(keyed: DataFrame, wanted: DataFrame, digits: int) -> DataFrame:
    """Narrow every wanted rank, counted inside its prefix, to a prefix of `digits` digits; one row per class and cut."""
    inside = keyed.withColumn("prefix", F.substring("p.h", 1, digits - STEP)).join(
        F.broadcast(wanted.select("s", "prefix").distinct()), ["s", "prefix"], "left_semi")
    bins = (
        inside.groupBy("s", "prefix", F.substring("p.h", 1, digits).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(
            W.partitionBy("s", "prefix").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))
    )
    return _hit(bins.join(F.broadcast(wanted), ["s", "prefix"])).select("s", "cut", F.col("bin").alias("prefix"), "rank", "rows")


def _hit(bins: DataFrame) -> DataFrame:
    """The bin that holds each rank, with the rank counted inside it."""
    before = F.col("upto") - F.col("rows")
    return bins.where((F.col("rank") > before) & (F.col("rank") <= F.col("upto"))).withColumn("rank", F.col("rank") - before)


def find_cuts(
    df: DataFrame, key: str, cuts: Cuts, label: str | None, seed: int | str, rank_rows: int = RANK_ROWS
) -> dict[int, dict[int, tuple]]:
    """Per class and cut, the (hash, key) of the row at the cut's rank. A rank of zero has no row.

    Rows that share a key count one by one and have one place. Only one row per class and cut reaches the driver in
    each round; a round more is one scan more and divides the rows of a bin by 65,536.
    """
    spark = df.sparkSession
    keyed = df.select(_stratum(label).alias("s"), _position(seed, key).alias("p"))
    by_class = W.partitionBy("s")
    bins = (
        keyed.groupBy("s", F.substring("p.h", 1, STEP).alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(by_class.orderBy("prefix").rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("n", F.sum("rows").over(by_class))
    )
    ranks = F.array(*[
        F.struct(F.lit(i).alias("cut"), r.cast("long").alias("rank")) for i, r in enumerate(cuts(F.col("n")))
    ])
    exploded = bins.withColumn("c", F.explode(ranks)).select("s", "prefix", "rows", "upto", "c.cut", "c.rank")
    found = _hit(exploded).select("s", "cut", "prefix", "rank", "rows").collect()
    digits, done = STEP, []
    while found:
        small = digits >= HASH_DIGITS
        done += [(r, digits) for r in found if small or r["rows"] <= rank_rows]
        found = [r for r in found if not small and r["rows"] > rank_rows]
        if found:
            digits += STEP
            wanted = spark.createDataFrame([tuple(r)[:4] for r in found], _WANTED)
            found = _bins_of_cuts(keyed, wanted, digits).collect()
    marks: dict[int, dict[int, tuple]] = {}
    for length in sorted({d for _, d in done}):
        wanted = spark.createDataFrame([tuple(r)[:4] for r, d in done if d == length], _WANTED)
        # equal keys are one place, so what is ordered is at most rank_rows places of each bin
        places = (
            keyed.withColumn("prefix", F.substring("p.h", 1, length))
            .join(F.broadcast(wanted.select("s", "prefix").distinct()), ["s", "prefix"], "left_semi")
            .groupBy("s", "prefix", "p").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("upto", F.sum("rows").over(
                W.partitionBy("s", "prefix").orderBy("p").rowsBetween(W.unboundedPreceding, 0)))
        )
        for r in _hit(places.join(F.broadcast(wanted), ["s", "prefix"])).select("s", "cut", "p.h", "p.k").collect():
            marks.setdefault(r["s"], {})[r["cut"]] = (r["h"], r["k"])
    return marks


def cut_by_hash(
    df: DataFrame,
    key: str,
    cuts: Cuts,
    names: list,
    label: str | None = None,
    seed: int | str = SEED,
    out: str = "split",
) -> DataFrame:
    """Label rows by where their hash rank falls between the cut ranks.

    ``cuts`` maps the class row count to increasing ranks; a row belongs to the first name whose
    cut it does not exceed. ``label`` is read as a yes/no flag.
    """
    found = find_cuts(df, key, cuts, label, seed)
    last = len(names) - 1
    choice = F.lit(names[last])
    for stratum, marks in found.items():
        chain = F.lit(names[last])
        for i in sorted(marks, reverse=True):
            h, k = marks[i]
            reached = F.col("_p") <= F.struct(F.lit(h).alias("h"), F.lit(k).alias("k"))
            chain = F.when(reached, F.lit(names[i])).otherwise(chain)
        choice = F.when(_stratum(label) == stratum, chain).otherwise(choice)
    return df.withColumn("_p", _position(seed, key)).withColumn(out, choice).drop("_p")


def _share(n: Column, numerator: int, denominator: int) -> Column:
    """floor(n * numerator / denominator) in whole numbers."""
    return F.floor(((n * numerator) - (n * numerator) % denominator) / denominator)


def stratified_split(
    df: DataFrame, label: str = "hazardous", key: str = "approach_id", percents: tuple[int, int] = (70, 15),
    seed: int = SEED,
) -> DataFrame:
    """train/val/test with the exact share of each class; every row lands in one split."""
    first, second = percents[0], percents[0] + percents[1]
    return cut_by_hash(
        df, key, lambda n: [_share(n, first, 100), _share(n, second, 100)], SPLIT_NAMES, label, seed
    )


def _folds(df: DataFrame, key: str, k: int, label: str | None, seed: int | str) -> DataFrame:
    return cut_by_hash(
        df, key, lambda n: [_share(n, i, k) for i in range(1, k)], list(range(k)), label, f"{seed}:fold", "fold"
    )


def stratified_kfold(
    df: DataFrame, k: int = 5, label: str = "hazardous", key: str = "approach_id", seed: int = SEED
) -> DataFrame:
    """Fold 0..k-1 per row; sizes within a class differ by at most one."""
    return _folds(df, key, k, label, seed)


def kfold(df: DataFrame, k: int = 5, key: str = "approach_id", seed: int = SEED) -> DataFrame:
    return _folds(df, key, k, None, seed)
