import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.operators.ordering import exact_quantiles, running_sums, select_ranks
from perigee.operators.stats import describe


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, a third sit in a tiny range, some are missing."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full(1000, 5.0), 5.0 + rng.random(1000) * 1e-6, rng.normal(0, 100, 1000)])
    rows = [(float(v), float(-v)) for v in x] + [(None, float("nan"))] * 5
    return spark.createDataFrame(rows, "x double, y double").repartition(4).persist(), x


@pytest.mark.parametrize("bracket_rows", [1_000_000, 40])
def test_quantiles_are_exact(skewed, bracket_rows):
    df, x = skewed
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    rows = {r["column"]: r for r in exact_quantiles(df, ["x", "y"], probs, bracket_rows).collect()}
    for name, data in (("x", x), ("y", -x)):
        got = [rows[name][f"q{i + 1}"] for i in range(len(probs))]
        assert got == pytest.approx(np.quantile(data, probs).tolist(), rel=1e-12)


def test_ranks_keep_integer_keys(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    found, sizes = select_ranks(df, ["k"], lambda n: [0, 17, n - 1, n], bracket_rows=10)
    assert found.first().asDict() == {"k__0": 0, "k__17": 17, "k__4999": 4999}
    assert sizes == {"k": 5000}


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first()["q1"] is None


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("bucket_rows", [250_000, 60])
def test_running_sums(skewed, descending, bucket_rows):
    """One window, or ranges in sections of three: the same sums."""
    df, x = skewed
    grouped = df.where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    got = {r["x"]: r["upto"] for r in running_sums(
        grouped, "x", {"upto": "n"}, descending=descending, bucket_rows=bucket_rows, section=3).collect()}
    values, counts = np.unique(x, return_counts=True)
    if descending:
        values, counts = values[::-1], counts[::-1]
    assert got == dict(zip(values.tolist(), np.cumsum(counts).tolist()))


@pytest.mark.parametrize("bucket_rows", [250_000, 40])
def test_running_sums_of_several_groups(spark, bucket_rows):
    """Groups from one row to most rows are summed side by side; no range is much above the limit."""
    df = spark.range(1000).select(
        F.when(F.col("id") < 700, "big").when(F.col("id") < 999, "small").otherwise("one").alias("g"),
        ((F.col("id") * 7919) % 1000).alias("k"), F.lit(1).alias("n"), (F.col("id") % 3).alias("m"))
    got = running_sums(df, "k", {"n_upto": "n", "m_upto": "m"}, ["g"], bucket_rows=bucket_rows, section=2).toPandas()
    assert len(got) == 1000
    for _, part in got.sort_values("k").groupby("g"):
        assert part["n_upto"].tolist() == part["n"].cumsum().tolist() and part["m_upto"].tolist() == part["m"].cumsum().tolist()


def test_describe_matches_pandas(approaches):
    got = describe(approaches, ["relative_velocity"]).first()
    want = approaches.select("relative_velocity").toPandas()["relative_velocity"].describe()
    for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert got[mine] == pytest.approx(want[theirs])
