"""Spans of texts with very many matches."""

import re
import time

from pyspark.sql import functions as F

from perigee.llm import spans


def test_running_sums_of_any_length(spark):
    sizes = [0, 1, 2, 255, 256, 257, 511, 512, 513, 70_000]
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    steps = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: (i % 7).cast("int"))).otherwise(F.array().cast("array<int>"))
    for r in df.select("n", spans.running_sums(steps).alias("s")).collect():
        total, want = 0, []
        for i in range(1, r["n"] + 1):
            total += i % 7
            want.append(total)
        assert r["s"] == want


def test_time_grows_with_the_matches(spark):
    pattern = r"[a-z]+@[a-z]+"
    took = {}
    for n in (40_000, 80_000, 160_000):
        text = "xé " + "ab@cde \U0001f916 " * n
        df = spark.createDataFrame([(text,)], "text string").select(spans.found(F.col("text"), 0, pattern).alias("s"))
        began = time.perf_counter()
        got = df.select(F.size("s").alias("n"), F.transform("s", lambda s: s["start"]).alias("start")).first()
        took[n] = time.perf_counter() - began
        assert got["n"] == n and got["start"] == [m.start() for m in re.finditer(pattern, text)]
    assert took[160_000] < 4 * took[80_000] + 2 and took[160_000] < 60
