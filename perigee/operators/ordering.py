"""Exact answers that need a global order, without sorting the table in one task.

``select_ranks`` finds values at given ranks by narrowing brackets; ``running_sums`` makes
cumulative totals from ranges, their totals and totals of these. Only bracket ends and counts reach
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.session import stable

BRACKET_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
#: Rows of a range of running sums, and ranges of a section.
BUCKET_ROWS, SECTION_BUCKETS = 250_000, 1_000


@dataclass
class _Target:
    column: str
    rank: int
    low: Any
    high: Any
    below: int
    inside: int
    slack: float = 2.0 / SKETCH_ACCURACY
    settled: bool = False

    @property
    def open(self) -> bool:
        return not self.settled and self.low != self.high

    def member(self) -> Column:
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    """One round: sketch inside each bracket, then count exactly what the new bracket holds."""
    sketches = []
    for i, t in enumerate(targets):
        position = (t.rank - t.below) / max(t.inside - 1, 1)
        ends = [max(0.0, position - t.slack), min(1.0, position + t.slack)]
        sketches.append(
            F.percentile_approx(F.when(t.member(), F.col(t.column)), ends, SKETCH_ACCURACY).alias(f"b{i}")
        )
    row = df.agg(*sketches).first()
    proposed = [(row[f"b{i}"][0], row[f"b{i}"][1]) for i in range(len(targets))]
    counts = []
    for i, (t, (low, high)) in enumerate(zip(targets, proposed)):
        c = F.col(t.column)
        counts.append(F.count_if(c < F.lit(low)).alias(f"below{i}"))
        counts.append(F.count_if(c.between(F.lit(low), F.lit(high))).alias(f"inside{i}"))
    found = df.agg(*counts).first()
    for i, (t, (low, high)) in enumerate(zip(targets, proposed)):
        below, inside = found[f"below{i}"], found[f"inside{i}"]
        if below <= t.rank < below + inside and inside < t.inside:
            t.low, t.high, t.below, t.inside = low, high, below, inside
        elif t.slack < 1.0:
            t.slack *= 4
        else:
            t.settled = True


def select_ranks(
    df: DataFrame, columns: list[str], ranks: Callable[[int], list[int]], bracket_rows: int = BRACKET_ROWS
) -> tuple[DataFrame, dict[str, int]]:
    """Exact order statistics: one row with column "<column>__<rank>" per zero-based rank.

    ``ranks`` maps a column's value count to the wanted ranks. The counts are returned as well.

    NULL and NaN values are left out of the order. Each round scans the table twice and shrinks a
    bracket about 2,500-fold, so a trillion rows need two rounds; the last step groups the few
    values left in each bracket.
    """
    df = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if t in ("double", "float") else F.col(c)
                     for c, t in df.select(*columns).dtypes])
    head = df.agg(*[
        e for c in columns for e in (F.count(c).alias(f"n__{c}"), F.min(c).alias(f"lo__{c}"), F.max(c).alias(f"hi__{c}"))
    ]).first()
    sizes = {c: head[f"n__{c}"] for c in columns}
    targets = [
        _Target(c, r, head[f"lo__{c}"], head[f"hi__{c}"], 0, n)
        for c, n in sizes.items() for r in sorted(set(ranks(n))) if 0 <= r < n
    ]
    while wide := [t for t in targets if t.open and t.inside > bracket_rows]:
        _narrow(df, wide)

    brackets = sorted({(t.column, t.low, t.high) for t in targets if t.low != t.high}, key=str)
    names = {b: i for i, b in enumerate(brackets)}
    values: list[Column] = []
    source = None
    if brackets:
        # a bracket is (column, low, high); rows outside every bracket stop here
        hits = F.array(*[
            F.when(F.col(c).between(F.lit(low), F.lit(high)),
                   F.struct(F.lit(i).alias("b"), F.col(c).alias("value")))
            for (c, low, high), i in names.items()
        ])
        grouped = (
            df.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
            .groupBy("h.b", "h.value").count()
        )
        upto = F.sum("count").over(W.partitionBy("b").orderBy("value").rowsBetween(W.unboundedPreceding, 0))
        source = grouped.withColumn("upto", upto)
    for t in targets:
        name = f"{t.column}__{t.rank}"
        if t.low == t.high:
            values.append(F.lit(t.low).alias(name))
        else:
            b = names[(t.column, t.low, t.high)]
            reached = (F.col("b") == b) & (F.col("upto") > F.lit(t.rank - t.below))
            values.append(F.min(F.when(reached, F.col("value"))).alias(name))
    if source is None:
        return df.sparkSession.range(1).select(*values), sizes
    return source.agg(*[F.max(v).alias(f"{t.column}__{t.rank}") if t.low == t.high else v
                        for t, v in zip(targets, values)]), sizes


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """One row per column with q1..qn: exact quantiles, linear between neighbouring ranks."""
    def place(n: int, p: float) -> tuple[int, int, float]:
        position = p * (n - 1)
        low = math.floor(position)
        return low, min(low + 1, n - 1), position - low

    row, sizes = select_ranks(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns,
        lambda n: [r for p in probs for r in place(n, p)[:2]] if n else [], bracket_rows,
    )
    items = []
    for c in columns:
        fields = [F.lit(c).alias("column")]
        for i, p in enumerate(probs, 1):
            if sizes[c] == 0:
                fields.append(F.lit(None).cast("double").alias(f"q{i}"))
                continue
            low, high, fraction = place(sizes[c], p)
            a, b = F.col(f"{c}__{low}"), F.col(f"{c}__{high}")
            fields.append((a + (b - a) * F.lit(fraction)).alias(f"q{i}"))
        items.append(F.struct(*fields))
    return row.select(F.explode(F.array(*items)).alias("q")).select("q.*")


def running_sums(
    grouped: DataFrame, key: str, sums: dict[str, str], by: Sequence[str] = (), descending: bool = False,
    bucket_rows: int = BUCKET_ROWS, section: int = SECTION_BUCKETS,
) -> DataFrame:
    """Add the sums of ``sums`` (output name -> input column) over all rows up to and including ``key``.

    ``grouped`` has one row per key and ``by`` columns, which are never NULL; every combination of these has sums of
    its own, all found in the same pass. Rows are dealt into ranges whose number follows from the counted rows, so a
    range stays small enough to be ordered in one task. What came before a range is found from the totals of the
    ranges in its section and of the sections before it: no window holds the rows or ranges of everything.
    """
    by = list(by)
    order = F.col(key).desc() if descending else F.col(key).asc()
    buckets = max(1, math.ceil(grouped.count() / bucket_rows))
    if buckets == 1:
        one = W.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
        return grouped.withColumns({n: F.sum(c).over(one) for n, c in sums.items()})
    # range borders come from a sample, so they are drawn once and saved
    placed = stable(grouped.repartitionByRange(buckets, *by, order).withColumn("_bucket", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_in_{n}") for n, c in sums.items()]).withColumn(
        "_section", F.floor(F.col("_bucket") / F.lit(section)))

    def before(partition: list[str], place: str) -> list[Column]:
        earlier = W.partitionBy(*(partition or [F.lit(0)])).orderBy(place).rowsBetween(W.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"_in_{n}").over(earlier), F.lit(0)).alias(f"_{place}_{n}") for n in sums]

    sections = totals.groupBy(*by, "_section").agg(*[F.sum(f"_in_{n}").alias(f"_in_{n}") for n in sums])
    starts = totals.select(*by, "_bucket", "_section", *before([*by, "_section"], "_bucket")).join(
        sections.select(*by, "_section", *before(by, "_section")), [*by, "_section"]
    ).select(*by, "_bucket", *[(F.col(f"__bucket_{n}") + F.col(f"__section_{n}")).alias(f"_before_{n}") for n in sums])
    inside = W.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.join(starts, [*by, "_bucket"])
        .withColumns({n: F.col(f"_before_{n}") + F.sum(c).over(inside) for n, c in sums.items()})
        .drop("_bucket", *[f"_before_{n}" for n in sums])
    )
