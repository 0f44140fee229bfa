"""Column-level building blocks. Everything here stays inside JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_bool(value: Column | str) -> Column:
    """Text or boolean to boolean; only "true" and "false" count, any case, all else is NULL."""
    text = F.lower(F.col(value).cast("string") if isinstance(value, str) else value.cast("string"))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def flag_to_int(value: Column | str) -> Column:
    """True/False (boolean or text) to 1/0; anything else stops the job."""
    column = F.col(value) if isinstance(value, str) else value
    flag = parse_bool(column)
    problem = F.concat(F.lit("not a true/false value: "), F.coalesce(column.cast("string"), F.lit("NULL")))
    return F.when(flag, 1).when(~flag, 0).otherwise(F.raise_error(problem).cast("int"))


def with_features(df: DataFrame) -> DataFrame:
    """Add the six engineered columns. A zero minimum diameter gives a NULL ratio, which the gate reports."""
    low, high = F.col("est_diameter_min"), F.col("est_diameter_max")
    return (
        df.withColumns({
            "diameter_avg": (low + high) / 2,
            "diameter_ratio": F.try_divide(high, low),
        })
        .withColumns({
            "log_diameter_avg": F.log1p("diameter_avg"),
            "log_diameter_ratio": F.log1p("diameter_ratio"),
            "log_relative_velocity": F.log1p("relative_velocity"),
            "log_miss_distance": F.log1p("miss_distance"),
        })
    )


def log_to_km(value: Column | str) -> Column:
    """Inverse of the log1p distance target."""
    return F.expm1(value)


def humanise(value: Column | str) -> Column:
    """1.2M / 3.4K for large numbers, grouped digits with up to three decimals below a thousand."""
    n = F.col(value) if isinstance(value, str) else value
    return (
        F.when(n >= 1e6, F.format_string("%.1fM", n / 1e6))
        .when(n >= 1e3, F.format_string("%.1fK", n / 1e3))
        .otherwise(F.call_function("format_number", n, F.lit("#,##0.###")))
    )


def percent(probability: Column | str) -> Column:
    """Whole percent, halves rounded up."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.floor(p * 100 + 0.5).cast("int")


def probability_band(probability: Column | str) -> Column:
    """high from 70 percent, medium from 40, else low."""
    pct = percent(probability)
    return F.when(pct >= 70, "high").when(pct >= 40, "medium").otherwise("low")


def hash_text(seed: int | str, *parts: Column | str) -> Column:
    """md5 of "seed:part:part": the same text in every engine, so splits can be replayed elsewhere."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[
        (F.col(p) if isinstance(p, str) else p).cast("string") for p in parts
    ]))


def hash_word(digest: Column, word: int) -> Column:
    """The word-th group of eight hex digits of a digest, as an unsigned 32-bit number."""
    return F.conv(F.substring(digest, 1 + 8 * word, 8), 16, 10).cast("long")


def hash_uniform(digest: Column, word: int) -> Column:
    """Uniform value in [0, 1) from one word of a digest."""
    return hash_word(digest, word) / F.lit(4294967296.0)
