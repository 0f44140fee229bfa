from pyspark.sql import functions as F

from perigee.operators.joins import orphan_features, salted_join
from perigee.operators.objects import read_snapshot, upsert, write_snapshot


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_salted_join_with_hot_and_missing_keys(spark):
    left = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        got = salted_join(left, right, ["k"], F.col("row"), how, rows_per_salt=100)
        assert rows(got.select("row", "k", "v")) == rows(left.join(right, "k", how).select("row", "k", "v"))
    orphans = orphan_features(left.withColumnRenamed("k", "sourceNeoId"), right.withColumnRenamed("k", "id"), F.col("row"))
    want = left.where("k is not null").join(right, "k", "left_anti")
    assert rows(orphans.select("row")) == rows(want.select("row"))


def test_upsert_last_row_wins_and_repeats_change_nothing(spark, tmp_path):
    schema = "seq int, id int, name string"
    target = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], schema)
    batch = spark.createDataFrame([(1, 2, "old"), (3, 2, "new"), (2, 3, "c")], schema)
    once = upsert(target, batch, "seq")
    assert rows(once.select("id", "name")) == [(1, "a"), (2, "new"), (3, "c")]
    write_snapshot(once, str(tmp_path), 1)
    again = upsert(read_snapshot(spark, str(tmp_path), 1), batch, "seq")
    assert rows(again) == rows(once)


def test_hot_id_is_cut_before_the_shuffle(spark):
    batch = spark.range(10_000).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("id"))
    target = spark.createDataFrame([(0, 5)], "seq long, id long")
    merged = upsert(target, batch, "seq")
    assert rows(merged.select("seq", "id")) == [(0, 5), (9998, 0), (9999, 1)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
