import pytest
from pyspark.sql import functions as F

from perigee.operators import quality as q
from perigee.plans.preprocess import check_table

SCHEMA = "i int, est_diameter_min double, est_diameter_max double, relative_velocity double, absolute_magnitude double, miss_distance double"


def test_input_rules(spark):
    rows = [
        (0, 0.12, 0.27, 48000.0, 22.1, 14500000.0),
        (1, 0.0, 0.27, 48000.0, 22.1, 14500000.0),
        (2, 0.3, 0.27, 48000.0, 22.1, 14500000.0),
        (3, 0.1, 0.27, -1.0, 22.1, 0.0),
        (4, None, 0.27, 1.0, float("nan"), 1.0),
    ]
    checked = q.validate_inputs(spark.createDataFrame(rows, SCHEMA))
    errors = {r["i"]: r["errors"] for r in checked.collect()}
    assert errors[0] == []
    assert errors[1] == ["est_diameter_min must be greater than 0"]
    assert errors[2] == ["est_diameter_max must be greater than or equal to est_diameter_min"]
    assert len(errors[3]) == 2 and len(errors[4]) == 2
    assert [r["i"] for r in q.accepted(checked).collect()] == [0]
    assert q.quarantine(checked).count() == 4


def test_gate_passes_and_stops(approaches):
    check_table(approaches)
    with pytest.raises(q.QualityError):
        check_table(approaches.withColumn("est_diameter_min", F.col("est_diameter_min") - 0.01))
    with pytest.raises(q.QualityError):
        check_table(approaches.withColumn("name", F.lit(None).cast("string")))


def test_shape_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    assert q.expect_shape(df, 2, 2).first()["ok"]
    assert not q.expect_shape(df, 3, 2).first()["ok"]
    assert {r["column"]: r["nulls"] for r in q.null_counts(df).collect()} == {"a": 0, "b": 1}


def test_manifest_lists_missing_names(spark):
    required = spark.createDataFrame([("a",), ("b",)], "name string")
    present = spark.createDataFrame([("b",), ("b",), ("c",)], "name string")
    assert [r["name"] for r in q.check_manifest(required, present).collect()] == ["a"]
