"""Filters, lookups, search and paging over approach tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.operators.ordering import select_ranks
from perigee.schema import NON_PREDICTIVE, RAW_COLUMNS, SUPERSEDED

# Paging limits of the browse interface.
PAGE_LIMIT_MAX = 1000
PAGE_LIMIT_DEFAULT = 100
SEARCH_LIMIT_MAX = 500
SEARCH_LIMIT_DEFAULT = 50


def _bounded(name: str, value: int, low: int, high: int | None = None) -> int:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be at least {low}" + (f" and at most {high}" if high else ""))
    return value


def drop_non_predictive(df: DataFrame) -> DataFrame:
    """Without identifiers, the constant body and the flag that leaks the label."""
    return df.drop(*NON_PREDICTIVE)


def drop_superseded(df: DataFrame) -> DataFrame:
    """Without the raw columns the engineered ones replace."""
    return df.drop(*SUPERSEDED)


def hazardous(df: DataFrame) -> DataFrame:
    return df.where(F.col("hazardous"))


def safe(df: DataFrame) -> DataFrame:
    return df.where(~F.col("hazardous"))


def first_per_id(df: DataFrame, key: str = "approach_id") -> DataFrame:
    """First row of each id in table order. Every task keeps one row per id before the shuffle."""
    first = W.partitionBy("id").orderBy(key)
    return df.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")


def by_id(df: DataFrame, wanted: int, key: str = "approach_id") -> DataFrame:
    return df.where(F.col("id") == wanted).orderBy(key).limit(1)


def first_of_each(df: DataFrame, wanted: DataFrame, key: str = "approach_id") -> DataFrame:
    """Lookup of many ids held in a table; an id without rows is simply absent.

    Both sides are down to one row per id before they are joined, so a frequent id costs nothing.
    """
    return first_per_id(df, key).join(wanted.select("id").distinct(), "id", "left_semi")


def search_name(df: DataFrame, query: str, literal: bool = False) -> DataFrame:
    """Case-insensitive match anywhere in the name; the query is a pattern unless ``literal``.

    NULL names never match.
    """
    query = query.strip()
    _bounded("query length", len(query), 1)
    if literal:
        hit = F.contains(F.lower("name"), F.lit(query.lower()))
    else:
        hit = F.col("name").rlike(f"(?iu){query}")
    return df.where(F.coalesce(hit, F.lit(False)))


def search(
    df: DataFrame, query: str, limit: int = SEARCH_LIMIT_DEFAULT, literal: bool = False, key: str = "approach_id"
) -> DataFrame:
    """First matches in table order, each with the total number of matches before the limit."""
    _bounded("limit", limit, 1, SEARCH_LIMIT_MAX)
    matches = search_name(df, query, literal)
    total = matches.agg(F.count(F.lit(1)).alias("total")).scalar()
    return matches.orderBy(key).limit(limit).withColumn("total", total)


def page(
    df: DataFrame,
    limit: int = PAGE_LIMIT_DEFAULT,
    offset: int = 0,
    key: str = "approach_id",
    tie: str | None = None,
) -> DataFrame:
    """Rows [offset, offset + limit) in the order of key, then tie, NULL first, with the table's row count.

    The page starts at the row of rank ``offset``, found without a global sort: the key of that rank, then among
    the rows of that key the tie-breaker of the remaining rank. Only rows from there on are sorted, as a top-n.
    key and tie together should be unique; rows that agree in both may come in any order among themselves.
    """
    _bounded("limit", limit, 1, PAGE_LIMIT_MAX)
    _bounded("offset", offset, 0)
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    rest, skip = _from_rank(df, offset, [key, *([tie] if tie else [])])
    order = [F.asc_nulls_first(c) for c in ([key, tie] if tie else [key])]
    return rest.orderBy(*order).offset(skip).limit(limit).withColumn("total", total)


def _from_rank(df: DataFrame, rank: int, keys: list[str]) -> tuple[DataFrame, int]:
    """Rows from the one of this rank on (and those that tie with it), and how many of them come before the rank."""
    if rank == 0:
        return df, 0
    key, after = keys[0], keys[1:]
    column = F.col(key)
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(column.isNull())).first()
    if rank >= n:
        return df.limit(0), 0
    if rank < nulls:
        same, later, before = column.isNull(), column.isNotNull(), 0
    else:
        found, _ = select_ranks(df.where(column.isNotNull()), [key], lambda _: [rank - nulls])
        start = found.first()[0]
        same, later = column == F.lit(start), column > F.lit(start)
        before = nulls + df.where(column < F.lit(start)).count()
    if not after:
        return df.where(same | later), rank - before
    inside, skip = _from_rank(df.where(same), rank - before, after)
    return inside.unionByName(df.where(later)), skip


def search_envelope(
    df: DataFrame, query: str, limit: int = SEARCH_LIMIT_DEFAULT, literal: bool = False, key: str = "approach_id"
) -> DataFrame:
    """The search as one row: query, total, count and the records (at most ``limit``), also where nothing matches."""
    _bounded("limit", limit, 1, SEARCH_LIMIT_MAX)
    matches = search_name(df, query, literal)
    total = matches.agg(F.count(F.lit(1)).alias("total")).scalar()
    record = F.struct(key, *[c for c in df.columns if c != key])
    found = matches.orderBy(key).limit(limit).agg(
        F.count(F.lit(1)).alias("count"), F.sort_array(F.collect_list(record)).alias("data"))
    return found.select(F.lit(query).alias("query"), total.alias("total"), "count", "data")


def page_after(df: DataFrame, last_key: int | None, limit: int = PAGE_LIMIT_DEFAULT, key: str = "approach_id") -> DataFrame:
    """Next page after a key; the bound reaches the scan as a pushed filter."""
    _bounded("limit", limit, 1, PAGE_LIMIT_MAX)
    rows = df if last_key is None else df.where(F.col(key) > last_key)
    return rows.orderBy(key).limit(limit)


def page_envelope(df: DataFrame, limit: int = PAGE_LIMIT_DEFAULT, offset: int = 0, key: str = "approach_id") -> DataFrame:
    """The page as one row: total, offset, limit, count and the records (at most ``limit``)."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    record = F.struct(key, *[c for c in RAW_COLUMNS if c in df.columns])
    records = page(df, limit, offset, key).agg(
        F.count(F.lit(1)).alias("count"), F.sort_array(F.collect_list(record)).alias("data")
    )
    return records.select(
        total.alias("total"), F.lit(offset).alias("offset"), F.lit(limit).alias("limit"), "count", "data"
    )


def head(df: DataFrame, n: int = 5, key: str = "approach_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def tail(df: DataFrame, n: int = 5, key: str = "approach_id") -> DataFrame:
    """Last rows in table order."""
    return df.orderBy(F.desc(key)).limit(n).orderBy(key)


def top_hazardous(df: DataFrame, n: int = 5, key: str = "approach_id") -> DataFrame:
    return head(hazardous(df), n, key)


def card_view(df: DataFrame, n: int = 5, key: str = "approach_id") -> DataFrame:
    """Short records for a card list."""
    return df.orderBy(key).limit(n).select(
        "id",
        "name",
        F.col("relative_velocity").alias("velocity"),
        F.col("miss_distance").alias("missDistance"),
        F.col("absolute_magnitude").alias("magnitude"),
    )
