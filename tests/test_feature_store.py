"""Appending batches to the feature store exactly once."""

import pytest
from pyspark.sql import functions as F

from perigee.session import fresh_path
from perigee.sources import tables


def test_a_batch_is_stored_once(spark, approaches):
    path = fresh_path(spark, "features")
    rows = tables.feature_rows(approaches, "approach_id")
    first, second = rows.where("approach_id % 2 = 0"), rows.where("approach_id % 2 = 1")
    assert tables.read_features(spark, path, rows.schema).count() == 0
    assert tables.append_features(first, path, "day=1/a b")
    assert not tables.append_features(first, path, "day=1/a b")
    assert tables.append_features(second, path, "day=2")
    assert not tables.append_features(first, path, "day=1/a b")
    stored = tables.read_features(spark, path, rows.schema)
    assert stored.columns == rows.columns
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    assert stored.agg(F.count_distinct("approach_id")).first()[0] == approaches.count()


@pytest.mark.parametrize("written", [False, True])
def test_a_crash_before_the_commit_leaves_nothing_visible(spark, approaches, monkeypatch, written):
    path = fresh_path(spark, "features")
    rows = tables.feature_rows(approaches, "approach_id")
    tables.append_features(rows.limit(10), path, "old")
    if written:  # files of the batch are there, its ledger row is not
        rows.limit(7).write.parquet(f"{path}/data/batch={tables._folder('new')}")
    else:
        broken = rows.withColumn("hazardous", F.raise_error(F.lit("lost")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            tables.append_features(broken, path, "new")
    assert tables.read_features(spark, path, rows.schema).count() == 10
    assert tables.append_features(rows, path, "new")
    assert tables.read_features(spark, path, rows.schema).count() == 10 + rows.count()


def test_an_empty_batch_is_committed(spark, approaches):
    path = fresh_path(spark, "features")
    rows = tables.feature_rows(approaches)
    assert tables.append_features(rows.limit(0), path, "none")
    assert not tables.append_features(rows, path, "none")
    assert tables.read_features(spark, path, rows.schema).isEmpty()
