"""The source pipeline's configuration mapping drives a full run (sources -> features -> model -> sinks)."""

from conftest import SF_MID
from pyspark.sql import functions as F

from tickwork import tables
from tickwork.plans import params_from_config, run_config
from tickwork.sinks import load_model, read_metrics_csv, scratch_path


def test_run_from_config(spark):
    ev = tables.table(spark, SF_MID, "events")
    v = F.col("value").cast("string")
    csv = scratch_path(spark, "cfg_csv")
    ev.select(F.col("ts").cast("string").alias("Open time"), v.alias("Open"), v.alias("High"), v.alias("Low"),
              v.alias("Close"), v.alias("Volume")).write.option("header", True).csv(csv)
    act = scratch_path(spark, "cfg_act")
    tables.activity(spark, SF_MID, "view").drop("ts_hour").write.parquet(act)
    out = scratch_path(spark, "cfg_out")
    cfg = {
        "data": {"price_path": csv, "blockchain_path": act, "price_timestamp_col": "Open time",
                 "price_open_col": "Open", "price_high_col": "High", "price_low_col": "Low",
                 "price_close_col": "Close", "price_volume_col": "Volume",
                 "start_date": "2024-01-01", "end_date": "2024-01-30"},
        "etl": {"label_horizon_hours": 1},
        "features": {"use_blockchain": True,
                     "price_features": ["ret_1h", "vol_1h", "volatility_1h", "high_low_ratio", "ma_close_3h",
                                        "ma_close_12h"],
                     "blockchain_features": ["tx_count_hour"]},
        "label_col": "label_up",
        "model": {"type": "random_forest", "params": {"numTrees": 20, "maxDepth": 4, "seed": 42}},
        "train": {"train_end_date": "2024-01-24", "test_start_date": "2024-01-25"},
        "output": {"metrics_csv": f"{out}/metrics.csv", "models_dir": f"{out}/models"},
    }
    p = params_from_config(cfg)
    assert (p.model_type, p.use_activity, p.train_end, p.horizon) == ("random_forest", True, "2024-01-24", 1)
    metrics, _ = run_config(spark, cfg)
    (m,) = metrics.collect()
    assert (m["n_train"], m["n_test"]) == (552, 119)  # end_date bound at midnight of 01-30 trims the test set
    assert 0.0 <= m["auc_roc"] <= 1.0
    (back,) = read_metrics_csv(spark, f"{out}/metrics.csv").collect()
    assert back["n_train"] == 552
    model = load_model(f"{out}/models/random_forest_pipeline")
    assert [type(st).__name__ for st in model.stages] == ["VectorAssembler", "StandardScalerModel",
                                                          "RandomForestClassificationModel"]


def test_run_without_activity_uses_price_features_only(spark):
    from tickwork.plans import RunParams, run

    ticks = tables.ticks(spark, SF_MID)
    params = RunParams("2024-01-24", "2024-01-25", "logistic_regression", use_activity=False)
    metrics, model = run(spark, ticks, tables.activity(spark, SF_MID, "view"), params)
    (m,) = metrics.collect()
    assert (m["n_train"], m["n_test"]) == (552, 143)
    assert model.stages[0].getInputCols() == ["ret_1h", "vol_1h", "volatility_1h", "high_low_ratio",
                                              "ma_close_3h", "ma_close_12h"]


def test_run_raises_when_a_sink_fails(spark, monkeypatch, tmp_path):
    """Both sinks are tried; the run then says which output is missing."""
    import sys

    import pytest

    plan = sys.modules["tickwork.plans.run"]
    monkeypatch.setattr(plan, "sources_from_config", lambda *_: (None, None))
    monkeypatch.setattr(plan, "run", lambda *_: (spark.range(0), None))
    cfg = {"train": {"train_end_date": "2024-01-24", "test_start_date": "2024-01-25"},
           "output": {"metrics_csv": str(tmp_path / "m"), "models_dir": str(tmp_path / "models")}}
    with pytest.raises(RuntimeError, match="m and .*random_forest_pipeline"):
        run_config(spark, cfg)


def test_landed_dates_go_to_few_files(spark, tmp_path):
    from tickwork.sources import land_candles

    land_candles(tables.ticks(spark, SF_MID).repartition(40), str(tmp_path / "landed"))
    files = list((tmp_path / "landed").glob("date=*/*.parquet"))
    assert len(files) <= 2 * len(list((tmp_path / "landed").glob("date=*")))
