import pytest
from conftest import rows, ts
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickwork.operators import apply_null_policy, select_features, split_counts, time_split
from tickwork.plans import accuracy, auc_roc, make_classifier, metrics_frame
from tickwork.plans.model import assembler, scaler
from tickwork.sinks import load_model, read_metrics_csv, save_model, scratch_path, write_metrics_csv


def test_g10_split_leaves_the_last_day_gap(spark):
    data = [(ts(f"2021-12-31 {h:02d}:00:00"),) for h in range(24)] + [(ts("2022-01-01 00:00:00"),)]
    df = spark.createDataFrame(data, "ts_hour timestamp_ntz")
    train, test = time_split(df, "2021-12-31", "2022-01-01")
    assert (train.count(), test.count()) == (1, 1)
    (r,) = split_counts(df, "2021-12-31", "2022-01-01").collect()
    assert (r["n_train"], r["n_test"], r["n_gap"]) == (1, 1, 23)


def test_g15_null_policy(spark):
    df = spark.createDataFrame([(1.0, None, 1), (2.0, float("nan"), 0), (None, 1.0, 1), (float("nan"), 1.0, 0),
                                (3.0, 2.0, None)], "ret_1h double, tx_count_hour double, label_up int")
    out = rows(apply_null_policy(df, ["ret_1h", "tx_count_hour"]).orderBy("ret_1h"))
    assert out == [(1.0, 0.0, 1), (2.0, 0.0, 0)]


def test_g20_missing_features_are_ignored(caplog):
    feats = select_features(["ret_1h", "vol_1h"], ["ret_1h", "nope", "vol_1h"], ["tx_count_hour"])
    assert feats == ["ret_1h", "vol_1h"]
    assert select_features(["a", "tx_count_hour"], ["a"], ["tx_count_hour"], use_activity=False) == ["a"]


def test_g16_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    model = Pipeline(stages=[assembler(["a", "b"]), scaler()]).fit(df)
    out = sorted(rows(model.transform(df).select(vector_to_array("features").alias("z")), "z"))
    assert [round(z[0][0], 4) for z in out] == [-0.8729, -0.2182, 1.0911]
    assert all(z[0][1] == 0.0 for z in out)


def test_g21_unknown_model():
    with pytest.raises(ValueError, match="svm"):
        make_classifier("svm")


def test_model_defaults_and_overrides():
    rf = make_classifier("random_forest", {"numTrees": 150, "maxDepth": 7})
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed()) == (150, 7, 42)
    assert make_classifier("gbt").getMaxIter() == 50
    assert make_classifier("logistic_regression").getRegParam() == 0.0


def test_exact_auc_and_accuracy(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.35, 0), (0.8, 1), (0.35, 1)], "score double, label_up int")
    # pairs: positives 0.4, 0.8, 0.35 vs negatives 0.1, 0.35 -> 5 wins + 1 tie (0.5) of 6
    assert auc_roc(df, raw="score") == pytest.approx(5.5 / 6, abs=1e-12)
    pred = df.withColumn("prediction", (F.col("score") > 0.3).cast("double"))
    assert accuracy(pred) == pytest.approx(4 / 5)


def test_metrics_csv_and_model_roundtrip(spark):
    m = metrics_frame(spark, 0.5681432903382537, 0.6150412087912088, 34919, 8736)
    path = scratch_path(spark, "test_metrics")
    assert write_metrics_csv(m, path)
    (r,) = read_metrics_csv(spark, path).collect()
    assert (r["auc_roc"], r["accuracy"], r["n_train"], r["n_test"]) == (0.5681432903382537, 0.6150412087912088,
                                                                        34919, 8736)
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, label_up int")
    model = Pipeline(stages=[assembler(["x"]), scaler(), make_classifier("logistic_regression")]).fit(df)
    mpath = scratch_path(spark, "test_model")
    assert save_model(model, mpath)
    a = rows(model.transform(df), "prediction")
    assert rows(load_model(mpath).transform(df), "prediction") == a


def test_split_sets_are_disjoint_and_ordered(spark):
    data = [(ts("2024-01-01 00:00:00") + __import__("datetime").timedelta(hours=h),) for h in range(24 * 10)]
    df = spark.createDataFrame(data, "ts_hour timestamp_ntz")
    train, test = time_split(df, "2024-01-05", "2024-01-06")
    assert train.join(test, "ts_hour").count() == 0
    assert train.agg({"ts_hour": "max"}).first()[0] < test.agg({"ts_hour": "min"}).first()[0]


def test_k3_k4_sink_failures_are_logged_not_raised(spark, tmp_path, caplog):
    blocker = tmp_path / "file"
    blocker.write_text("x")  # a file where a folder is needed
    m = metrics_frame(spark, 0.5, 0.5, 1, 1)
    assert write_metrics_csv(m, f"file://{blocker}/metrics") is False
    df = spark.createDataFrame([(float(i), i % 2) for i in range(6)], "x double, label_up int")
    model = Pipeline(stages=[assembler(["x"]), scaler(), make_classifier("logistic_regression")]).fit(df)
    assert save_model(model, f"file://{blocker}/model") is False
