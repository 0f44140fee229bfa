import hashlib

from pyspark.sql import functions as F

from perigee.operators.scaling import Scaler, fit_scaler
from perigee.operators import splits
from perigee.operators.splits import cut_by_hash, find_cuts, kfold, stratified_kfold, stratified_split


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_split_equals_sorting_by_hash(approaches):
    rows = stratified_split(approaches).select("approach_id", "hazardous", "split").collect()
    got = {r["approach_id"]: r["split"] for r in rows}
    for flag in (True, False):
        ids = [r["approach_id"] for r in rows if r["hazardous"] == flag]
        ids.sort(key=lambda i: (digest(f"42:{i}"), i))
        first, second = len(ids) * 70 // 100, len(ids) * 85 // 100
        want = {i: "train" if n < first else "val" if n < second else "test" for n, i in enumerate(ids)}
        assert {i: got[i] for i in ids} == want


def test_split_is_repeatable_and_seeded(approaches):
    again = stratified_split(approaches.repartition(7)).select("approach_id", "split")
    assert again.exceptAll(stratified_split(approaches).select("approach_id", "split")).isEmpty()
    other = stratified_split(approaches, seed=7).select("approach_id", "split")
    assert not other.exceptAll(again).isEmpty()


def test_folds_are_even(approaches):
    sizes = [r["count"] for r in kfold(approaches, 7).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    strat = stratified_kfold(approaches).groupBy("hazardous", "fold").count().collect()
    for flag in (True, False):
        sizes = [r["count"] for r in strat if r["hazardous"] == flag]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_tiny_classes_and_zero_ranks(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "approach_id long, hazardous boolean")
    got = {r["approach_id"]: r["split"] for r in stratified_split(df).collect()}
    assert set(got.values()) == {"test"}
    none = cut_by_hash(df, "approach_id", lambda n: [F.lit(0)], ["a", "b"])
    assert {r["split"] for r in none.collect()} == {"b"}
    every = cut_by_hash(df, "approach_id", lambda n: [n], ["a", "b"])
    assert {r["split"] for r in every.collect()} == {"a"}


def test_scaler_uses_population_deviation(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "x double, c double")
    scaler = fit_scaler(df, ["x", "c"])
    assert scaler.stds == {"x": 1.0, "c": 0.0}
    assert [tuple(r) for r in scaler.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    scaler.save(spark, str(tmp_path / "s"))
    assert Scaler.load(spark, str(tmp_path / "s"), ["x", "c"]) == scaler
    sql = df.selectExpr(*scaler.sql_expressions().values())
    assert [tuple(r) for r in sql.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_other_labels_are_refused(spark):
    import pytest

    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "approach_id long, hazardous int")
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        stratified_split(df).collect()


def test_published_split_sizes(spark):
    from pyspark.sql import functions as F

    df = spark.range(90_836).select(F.col("id").alias("approach_id"), (F.col("id") < 8_840).alias("hazardous"))
    got = {(r["split"], r["hazardous"]): r["count"] for r in stratified_split(df).groupBy("split", "hazardous").count().collect()}
    rows = {s: got[s, True] + got[s, False] for s in ("train", "val", "test")}
    assert sum(rows.values()) == 90_836
    assert all(abs(rows[s] - n) <= 1 for s, n in {"train": 63_585, "val": 13_625, "test": 13_626}.items())
    assert got["val", True] == 1_326 and got["test", True] == 1_326


def test_bins_are_divided_until_one_task_can_rank_them(spark, approaches, monkeypatch):
    """With a small limit the cuts are the same, and no bin above the limit is ranked."""
    def halves(n):
        return [F.floor(n / 2), F.floor(n * 3 / 4), n]

    want = find_cuts(approaches, "approach_id", halves, "hazardous", 42)
    sizes = []
    narrow = splits._bins_of_cuts

    def seen(keyed, wanted, digits):
        out = narrow(keyed, wanted, digits)
        sizes.append((digits, [r["rows"] for r in out.collect()]))
        return out

    monkeypatch.setattr(splits, "_bins_of_cuts", seen)
    monkeypatch.setattr(splits, "STEP", 1)
    assert find_cuts(approaches, "approach_id", halves, "hazardous", 42, rank_rows=3) == want
    assert [d for d, _ in sizes] == list(range(2, 2 + len(sizes))) and len(sizes) >= 2
    assert max(sizes[-1][1]) <= 3 < max(sizes[0][1])


def test_repeated_keys_share_a_place(spark, monkeypatch):
    """A key that a third of the rows share can't be divided; it is one place however many rows it has."""
    df = spark.createDataFrame([(i if i % 3 else 7,) for i in range(300)], "k long")
    order = sorted((digest(f"1:{k}"), k) for k in [r["k"] for r in df.collect()])
    monkeypatch.setattr(splits, "STEP", 8)
    got = find_cuts(df, "k", lambda n: [F.floor(n / 4), F.floor(n / 2), F.floor(n * 3 / 4)], None, 1, rank_rows=2)
    assert got == {0: {i: order[r - 1] for i, r in enumerate((75, 150, 225))}}
