from perigee.operators.objects import latest_version, read_snapshot
from perigee.plans.scoring import Scorer
from perigee.streaming.scoring import score_stream
from perigee.streaming.upsert import upsert_stream
from test_models import SMALL
from perigee.plans import training
from perigee.plans.preprocess import prepare
from perigee.session import fresh_path

SCHEMA = "seq long, id long, name string"


def test_upsert_stream_applies_batches_in_order(spark, tmp_path):
    landed, root, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], SCHEMA).coalesce(1).write.parquet(landed)
    schema = spark.read.parquet(landed).schema
    upsert_stream(spark, landed, schema, root, "seq", state).awaitTermination()
    spark.createDataFrame([(4, 2, "d"), (5, 3, "e")], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
    upsert_stream(spark, landed, schema, root, "seq", state).awaitTermination()
    table = sorted(map(tuple, read_snapshot(spark, root, 2).select("id", "name").collect()))
    assert table == [(1, "b"), (2, "d"), (3, "e")]
    upsert_stream(spark, landed, schema, root, "seq", state).awaitTermination()
    assert sorted(map(tuple, read_snapshot(spark, root, 2).select("id", "name").collect())) == table
    # another stream with a checkpoint of its own goes on from the same table
    again, other = str(tmp_path / "in2"), str(tmp_path / "state2")
    spark.createDataFrame([(9, 3, "z"), (10, 4, "y")], SCHEMA).coalesce(1).write.parquet(again)
    for _ in range(2):
        upsert_stream(spark, again, schema, root, "seq", other).awaitTermination()
    assert latest_version(spark, root) == 3
    assert sorted(map(tuple, read_snapshot(spark, root, 3).select("id", "name").collect())) == [(1, "b"), (2, "d"), (3, "z"), (4, "y")]


def test_score_stream_matches_the_batch_scorer(spark, approaches, tmp_path):
    prepared = prepare(approaches, fresh_path(spark, "splits"))
    clf = training.fit("LogisticRegression", "clf", prepared.load("clf", "train"), SMALL)
    reg = training.fit("LinearRegression", "reg", prepared.load("reg", "train"), SMALL)
    scorer = Scorer.build(clf, reg, prepared.scaler_clf, prepared.scaler_reg)
    rows = approaches.selectExpr(
        "approach_id", "if(approach_id % 50 = 0, 0D, est_diameter_min) AS est_diameter_min", "est_diameter_max",
        "relative_velocity", "absolute_magnitude", "miss_distance")
    landed, out, refused, state = (str(tmp_path / n) for n in ("in", "out", "refused", "state"))
    rows.repartition(3).write.parquet(landed)
    score_stream(spark, landed, rows.schema, scorer, out, refused, state, max_files=1).awaitTermination()
    scored = spark.read.parquet(out)
    assert spark.read.parquet(refused).count() == rows.where("est_diameter_min = 0").count() == 20
    want = scorer.score(rows.where("est_diameter_min > 0"))
    assert scored.select(*want.columns).exceptAll(want).isEmpty() and scored.count() == want.count() == 980
