import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.columns import flag_to_int, humanise, parse_bool, probability_band, with_features
from perigee.schema import RAW_COLUMNS
from perigee.sources.approaches import normalize_columns, read_raw


def values(df, column):
    return [r[column] for r in df.collect()]


def test_parse_bool_takes_only_true_and_false(spark):
    df = spark.createDataFrame([("TRUE",), ("false",), ("yes",), ("1",), ("t",), (None,)], "v string")
    assert values(df.select(parse_bool("v").alias("b")), "b") == [True, False, None, None, None, None]


def test_flag_to_int_refuses_other_text(spark):
    good = spark.createDataFrame([("True",), ("FALSE",)], "v string")
    assert values(good.select(flag_to_int("v").alias("b")), "b") == [1, 0]
    for bad in ("maybe", None):
        with pytest.raises(Exception, match="not a true/false value"):
            spark.createDataFrame([(bad,)], "v string").select(flag_to_int("v")).collect()


def test_features_match_numpy(spark):
    row = (0.12, 0.27, 48000.0, 14500000.0)
    df = spark.createDataFrame([row], "est_diameter_min double, est_diameter_max double, relative_velocity double, miss_distance double")
    got = with_features(df).first()
    assert got["diameter_avg"] == pytest.approx((0.12 + 0.27) / 2)
    assert got["diameter_ratio"] == pytest.approx(0.27 / 0.12)
    assert got["log_diameter_avg"] == pytest.approx(np.log1p(0.195))
    assert got["log_miss_distance"] == pytest.approx(np.log1p(14500000.0))


def test_zero_diameter_gives_null_ratio(spark):
    df = spark.createDataFrame([(0.0, 0.2, 1.0, 1.0)], "est_diameter_min double, est_diameter_max double, relative_velocity double, miss_distance double")
    assert with_features(df).first()["diameter_ratio"] is None


def test_humanise(spark):
    df = spark.createDataFrame([(1234567.0,), (2500.0,), (999.0,), (12.34567,), (0.0,)], "n double")
    assert values(df.select(humanise("n").alias("s")), "s") == ["1.2M", "2.5K", "999", "12.346", "0"]


def test_probability_band(spark):
    df = spark.createDataFrame([(0.695,), (0.694,), (0.395,), (0.39,), (1.0,)], "p double")
    assert values(df.select(probability_band("p").alias("b")), "b") == ["high", "medium", "medium", "low", "high"]


def test_csv_with_padded_header_and_text_flags(spark, tmp_path):
    path = tmp_path / "neo.csv"
    path.write_text(
        " ID ,Name,est_diameter_min,est_diameter_max,relative_velocity,miss_distance,orbiting_body,sentry_object,absolute_magnitude,hazardous\n"
        "7,(2000 SS1),0.1,0.2,100.5,2000.25,Earth,False,20.1,TRUE\n"
    )
    row = read_raw(spark, str(path)).first()
    assert (row["id"], row["name"], row["sentry_object"], row["hazardous"]) == (7, "(2000 SS1)", False, True)


def test_csv_with_a_further_column(spark, approaches, tmp_path):
    key = T.StructType([T.StructField("approach_id", T.LongType())])
    approaches.select(*RAW_COLUMNS, "approach_id").write.option("header", True).csv(str(tmp_path / "a"))
    back = read_raw(spark, str(tmp_path / "a"), extra=key)
    assert back.exceptAll(approaches.select(*RAW_COLUMNS, "approach_id")).isEmpty() and back.count() == 1000


def test_malformed_csv_stops_the_job(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,name,a,b,c,d,e,f,g,h\nx,(2000 SS1),0.1,0.2,100.5,2000.25,Earth,False,20.1,TRUE\n")
    with pytest.raises(Exception):
        read_raw(spark, str(path)).collect()


def test_normalize_columns(spark):
    assert normalize_columns(spark.range(1).select(F.lit(1).alias("  Ab_C "))).columns == ["ab_c"]


HEADER = "name,id,est_diameter_min,est_diameter_max,miss_distance,relative_velocity,orbiting_body,sentry_object,absolute_magnitude,hazardous"
LINE = " (2000 SS1) ,2,0.1,0.2,14500000,48000,Earth,False,20.1,TRUE"


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER.upper()}\n{LINE}\n")
    row = read_raw(spark, str(tmp_path / "a.csv")).first()
    assert (row["id"], row["name"], row["relative_velocity"], row["miss_distance"]) == (2, " (2000 SS1) ", 48000.0, 14500000.0)


@pytest.mark.parametrize("header", [HEADER.replace("name", "label"), HEADER.replace("name", "id"), HEADER.replace(",hazardous", "")], ids=["unknown", "doubled", "missing"])
def test_csv_with_wrong_names(spark, tmp_path, header):
    (tmp_path / "a.csv").write_text(f"{header}\n{LINE}\n")
    with pytest.raises(ValueError, match="columns must be"):
        read_raw(spark, str(tmp_path / "a.csv"))


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{LINE}\n")
    (tmp_path / "b.csv").write_text(f"{HEADER.replace('miss_distance,relative_velocity', 'relative_velocity,miss_distance')}\n{LINE}\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path)).collect()
