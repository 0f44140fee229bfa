import os

import pytest
from pyspark.sql import functions as F

from perigee.operators import objects as o

SCHEMA = "seq long, id long, name string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folders(spark, root, version):
    return {b: f for b, (f, _) in o.read_manifest(spark, root, version).files.items()}


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


@pytest.fixture()
def table(spark, tmp_path):
    """A table of 4,000 objects in 32 buckets or so."""
    root = str(tmp_path / "table")
    first = spark.range(4000).select(F.lit(0).cast("long").alias("seq"), "id", F.md5(F.col("id").cast("string")).alias("name"))
    assert o.upsert_snapshot(first, "seq", root, bucket_rows=100) == 1
    return root


def test_a_batch_rewrites_only_its_buckets(spark, table):
    before, bytes_before = folders(spark, table, 1), size(f"{table}/data")
    assert len(before) == 32
    batch = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (1, 9_000, "new")], SCHEMA)
    assert o.upsert_snapshot(batch, "seq", table, bucket_rows=100) == 2
    after = folders(spark, table, 2)
    touched = {r[0] for r in batch.select(o.bucket_of("id", 32)).distinct().collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched
    assert size(f"{table}/data") - bytes_before < bytes_before * (len(touched) + 1) / 32
    want = o.upsert(o.read_snapshot(spark, table, 1), batch, "seq")
    got = o.read_snapshot(spark, table, 2)
    assert rows(got) == rows(want) and got.count() == o.read_manifest(spark, table, 2).rows == 4001


def test_buckets_grow_with_the_table(spark, table):
    more = spark.range(3000, 40_000).select(F.lit(1).cast("long").alias("seq"), "id", F.lit("x").alias("name"))
    want = o.upsert(o.read_snapshot(spark, table, 1), more, "seq")
    o.upsert_snapshot(more, "seq", table, bucket_rows=100)
    manifest = o.read_manifest(spark, table, 2)
    assert manifest.buckets == 256 and max(n for _, n in manifest.files.values()) < 400
    assert rows(o.read_snapshot(spark, table, 2)) == rows(want)


def test_crash_between_write_and_commit(spark, table, monkeypatch):
    batch = spark.createDataFrame([(1, 7, "late")], SCHEMA)
    before = rows(o.read_snapshot(spark, table, 1))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(o, "_commit", crash)
        with pytest.raises(RuntimeError):
            o.upsert_snapshot(batch, "seq", table, source="s", number=0, bucket_rows=100)
    assert o.latest_version(spark, table) == 1 and rows(o.read_snapshot(spark, table, 1)) == before
    assert o.drop_unreferenced(spark, table) == 1  # the bucket that no version holds
    assert o.upsert_snapshot(batch, "seq", table, source="s", number=0, bucket_rows=100) == 2
    # the same batch again, as a stream would bring it after a crash behind the commit
    assert o.upsert_snapshot(batch, "seq", table, source="s", number=0, bucket_rows=100) == 2
    assert o.read_snapshot(spark, table, 2).where("name = 'late'").count() == 1
    assert o.upsert_snapshot(batch, "seq", table, source="other", number=0, bucket_rows=100) == 3


def test_only_files_of_kept_versions_stay(spark, table):
    for i in range(3):
        o.upsert_snapshot(spark.createDataFrame([(i + 1, i, f"v{i}")], SCHEMA), "seq", table, bucket_rows=100)
    last = rows(o.read_snapshot(spark, table, 4))
    assert o.drop_unreferenced(spark, table, keep=1) >= 1
    assert o._versions(spark, table) == [4] and rows(o.read_snapshot(spark, table, 4)) == last
    there = {f"data/{c}/{b}" for c in os.listdir(f"{table}/data") for b in os.listdir(f"{table}/data/{c}") if b.startswith("_bucket")}
    assert there == set(folders(spark, table, 4).values())
    with pytest.raises(ValueError):
        o.drop_unreferenced(spark, table, keep=0)


def test_missing_ids_empty_batches_and_other_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    empty = spark.createDataFrame([], SCHEMA)
    assert o.upsert_snapshot(empty, "seq", root) == 1 and rows(o.read_snapshot(spark, root, 1)) == []
    for seq, name in ((1, "a"), (2, "b")):
        o.upsert_snapshot(spark.createDataFrame([(seq, None, name), (seq, 1, name)], SCHEMA), "seq", root)
    assert rows(o.read_snapshot(spark, root, 3)) == [(2, 1, "b"), (2, None, "b")]
    with pytest.raises(ValueError):
        o.upsert_snapshot(empty, "seq", root, key="seq")
