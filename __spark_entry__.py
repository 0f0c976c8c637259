"""

Each query reads the given tables (``/root/testdata/sf*/``) through the
adapters of :mod:`tickwork.tables` and runs library operators over the whole
tables. Output columns are aliased identically in Spark and SQL.

Rounding for the comparison: columns whose value depends on the order in which
Spark and DuckDB add doubles (sums of non-integers, averages, deviations,
logarithms) are rounded to 6 decimals on both sides. Columns that both engines
compute with identical IEEE operations on identical inputs (selected prices,
ratios, forward returns, exact decimal sums) are left unrounded: rounding those
could split a value that lies exactly on a decimal tie.

Rounded oracle values get ``+ 0.0``: DuckDB rounds a tiny negative to -0.0,
Spark to 0.0.

Integer columns that the left join can leave NULL (``block_count``) are
reported as double on both sides: through pandas, Spark turns a nullable
bigint into float64 and DuckDB into Int64, which would hash differently.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork import tables
from tickwork.functions.time import epoch_seconds_ntz, truncate_hour
from tickwork.operators import (
    Layout,
    add_indicators,
    add_labels,
    append_state,
    apply_null_policy,
    auc_by_ranks,
    bar_state,
    bars_from_state,
    daily_to_hourly_proxy,
    file_positions,
    high_low_ratio,
    hourly_block_stats,
    join_activity,
    lagged_returns,
    log_returns,
    long_frames,
    moving_averages,
    ohlcv_bars,
    read_state,
    resample_ffill,
    rolling_volatility,
    select_features,
    split_counts,
    time_split,
    total_blocks,
    with_running_totals,
)
from tickwork.operators.series import materialize
from tickwork.plans import RunParams, build_features, class_share, features_step, metrics_frame, run_config, train_and_evaluate
from tickwork.plans.evaluate import accuracy, auc_roc
from tickwork.plans.model import classifier_pipeline
from tickwork.sinks import (
    PublishedTable,
    load_model,
    read_metrics_csv,
    save_model,
    scratch_path,
    write_features,
    write_hourly_stats,
    write_metrics_csv,
    write_proxy,
)
from tickwork.sinks.blockfiles import write_block_files
from tickwork.sinks.buckets import join_buckets, write_buckets
from tickwork.sources import (
    land_candles,
    load_activity,
    load_candles_csv,
    load_candles_parquet,
    normalize_candles,
    read_block_files,
    read_reconciled,
    scan_new,
)

SF_SMOKE = "/root/testdata/sf0.001"

# Split dates inside the one month that ``events`` covers.
TRAIN_END, TEST_START = "2024-01-24", "2024-01-25"
BAR_COLS = ["open_1h", "close_1h", "high_1h", "low_1h", "vol_1h", "volatility_1h"]
NOISY_BAR = ["vol_1h", "volatility_1h"]
NOISY_IND = ["ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3h", "ma_close_12h", "vol_24h"]
DAY = {"size": "1 day"}
ZERO = {"on_zero": "null"}  # a price of zero gives no return and no ratio; SQL says nullif


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _int_as_double(df: DataFrame, cols=("block_count",)) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _bars(spark, d, keyed=False):
    return ohlcv_bars(tables.ticks(spark, d, keyed), keys=["event_type"] if keyed else [])


def _large_bars(spark, d):
    return ohlcv_bars(tables.lineitem_ticks(spark, d), keys=["l_suppkey"], size="1 day", out_ts="ts_day", suffix="_1d")


def _activity(spark, d):
    """One event type, where the query is about hours without activity."""
    return tables.activity(spark, d, "view")


def _features(spark, d, keyed=False, size="1 hour", event_type=None):
    """The feature table with the activity of all events, or of one type: the join then meets hours without activity."""
    keys = ["event_type"] if keyed else []
    return build_features(tables.ticks(spark, d, keyed), tables.activity(spark, d, event_type), keys=keys, size=size, **ZERO)


# ---------------------------------------------------------------- bars (A1)
def q_hourly_bars(spark, d):
    return _round(_bars(spark, d), NOISY_BAR)


def q_hourly_bars_keyed(spark, d):
    return _round(_bars(spark, d, keyed=True), NOISY_BAR)


def q_daily_bars_large(spark, d):
    return _round(_large_bars(spark, d), ["vol_1d", "volatility_1d"])


def q_bars_15min(spark, d):
    """Q9: the bar size is a parameter."""
    out = ohlcv_bars(tables.ticks(spark, d), size="15 minutes", out_ts="ts_bar", suffix="_15m")
    return _round(out, ["vol_15m", "volatility_15m"])


def q_bars_tied_ticks(spark, d):
    """Ticks of whole minutes, many with equal times: the smallest opens, the largest closes."""
    tied = tables.ticks(spark, d).withColumn("ts_raw", F.date_trunc("minute", "ts_raw").cast("timestamp_ntz"))
    return _round(ohlcv_bars(tied), NOISY_BAR)


def q_bars_from_state(spark, d):
    """15-minute states of two loads, the second with late ticks for buckets of the first, merged to hours and days."""
    path = scratch_path(spark, "bar_state")
    ticks = tables.ticks(spark, d, keyed=True)
    late = F.col("event_type") == "purchase"
    for load in (~late, late):
        append_state(bar_state(ticks.where(F.coalesce(load, F.lit(False))), size="15 minutes"), path)
    states = read_state(spark, path)
    sizes = [bars_from_state(states, size=size, out_ts="ts_bar", suffix="").withColumn("size", F.lit(size)) for size in ("1 hour", "1 day")]
    return _round(sizes[0].unionByName(sizes[1]), ["vol", "volatility"])


def q_truncated_hours(spark, d):
    """calendar truncation, counted."""
    hour = truncate_hour("ts").cast("timestamp_ntz").alias("ts_hour")
    return tables.table(spark, d, "events").groupBy(hour).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- indicators
def q_prev_close_log_return(spark, d):
    return _round(log_returns(_bars(spark, d), **ZERO).select("ts_hour", "close_1h", "ret_1h"), ["ret_1h"])


def q_lagged_returns(spark, d):
    out = lagged_returns(_bars(spark, d), **ZERO).select("ts_hour", "ret_1h", "ret_1h_lag1", "ret_1h_lag2")
    return _round(out, ["ret_1h", "ret_1h_lag1", "ret_1h_lag2"])


def q_moving_averages(spark, d):
    out = moving_averages(_bars(spark, d)).select("ts_hour", "close_1h", "ma_close_3h", "ma_close_12h")
    return _round(out, ["ma_close_3h", "ma_close_12h"])


def q_time_frames_keyed(spark, d):
    """Q4 option: time-range frames (3 h / 12 h averages, 24 h deviation) on keyed bars that have gaps."""
    bars = _bars(spark, d, keyed=True)
    out = rolling_volatility(moving_averages(bars, keys=["event_type"], frame="time"), keys=["event_type"],
                             frame="time")
    return _round(out.select("event_type", "ts_hour", "ma_close_3h", "ma_close_12h", "vol_24h"),
                  ["ma_close_3h", "ma_close_12h", "vol_24h"])


def q_rolling_volatility(spark, d):
    return _round(rolling_volatility(_bars(spark, d)).select("ts_hour", "vol_24h"), ["vol_24h"])


def q_long_frames(spark, d):
    """Frames of 1,000 and 100,000 ticks, in blocks of 256: each reaches over many blocks."""
    ev = tables.table(spark, d, "events").select("event_id", "ts", "value")
    out = long_frames(ev, (1_000, 100_000), value="value", order="ts", tiebreak=["event_id"], name="v", size="1 minute", block_rows=256)
    return _round(out.drop("value"), [c for c in out.columns if "avg" in c or "stddev" in c])


def q_long_frames_keyed(spark, d):
    """Frames of 500 bars of each supplier's daily bars; of logarithms, whose averages don't end in a decimal tie."""
    bars = _large_bars(spark, d).select("l_suppkey", "ts_day", F.ln("close_1d").alias("log_close"))
    out = long_frames(bars, (500,), value="log_close", keys=["l_suppkey"], order="ts_day", name="log", **DAY)
    return _round(out, [c for c in out.columns if c.startswith("log")])


def q_high_low_ratio(spark, d):
    return high_low_ratio(_bars(spark, d), **ZERO).select("ts_hour", "high_1h", "low_1h", "high_low_ratio")


def q_indicators(spark, d):
    return _round(add_indicators(_bars(spark, d), **ZERO), NOISY_BAR + NOISY_IND)


def q_indicators_custom(spark, d):
    """Q9: window lengths and lags are parameters (5/24-bar averages, 12-bar deviation, three lags)."""
    out = add_indicators(_bars(spark, d), ma=(5, 24), vol_window=12, lags=(1, 2, 3), **ZERO)
    return _round(out.select("ts_hour", "ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ret_1h_lag3", "ma_close_5h",
                             "ma_close_24h", "vol_12h"),
                  ["ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ret_1h_lag3", "ma_close_5h", "ma_close_24h", "vol_12h"])


def q_indicators_keyed(spark, d):
    return _round(add_indicators(_bars(spark, d, keyed=True), keys=["event_type"], **ZERO), NOISY_BAR + NOISY_IND)


def q_indicators_blocked(spark, d):
    """Block + halo layout with small blocks (100 bars) so series span many blocks."""
    out = add_indicators(_bars(spark, d), layout=Layout(block_rows=100, chunk="day"), **ZERO)
    return _round(out, NOISY_BAR + NOISY_IND)


def q_indicators_partitioned(spark, d):
    """The plain ``partitionBy(keys)`` layout, for comparison with the blocked default."""
    out = add_indicators(_bars(spark, d, keyed=True), keys=["event_type"], layout=Layout(blocked=False), **ZERO)
    return _round(out, NOISY_BAR + NOISY_IND)


def q_indicators_large_keyed(spark, d):
    out = add_indicators(_large_bars(spark, d), keys=["l_suppkey"], ts="ts_day", close="close_1d",
                         high="high_1d", low="low_1d", unit="d", **DAY)
    return _round(out, ["vol_1d", "volatility_1d", "ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3d",
                        "ma_close_12d", "vol_24d"])


def q_indicators_keyed_blocked(spark, d):
    """The same over blocks of 128 bars, several to each series."""
    out = add_indicators(_large_bars(spark, d), keys=["l_suppkey"], ts="ts_day", close="close_1d",
                         high="high_1d", low="low_1d", unit="d", layout=Layout(block_rows=128, chunk="month"))
    return _round(out, ["vol_1d", "volatility_1d", "ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3d",
                        "ma_close_12d", "vol_24d"])


def q_time_frames_15min_blocked(spark, d):
    """Frames of hours over 15-minute bars, in blocks that are shorter than a day."""
    bars = ohlcv_bars(tables.ticks(spark, d, keyed=True), keys=["event_type"], size="15 minutes")
    small = Layout(block_rows=96, chunk="hour")
    out = moving_averages(bars, keys=["event_type"], frame="time", layout=small)
    out = rolling_volatility(out, keys=["event_type"], frame="time", layout=small)
    return _round(out.select("event_type", "ts_hour", "ma_close_3h", "ma_close_12h", "vol_24h"),
                  ["ma_close_3h", "ma_close_12h", "vol_24h"], 9)  # averages of 32 prices often end in a tie at 6 digits


# ---------------------------------------------------------------- labels
def q_labels(spark, d):
    out = add_labels(_bars(spark, d), **ZERO).select("ts_hour", "close_1h", "close_future", "return_future", "label_up")
    return out


def q_labels_horizon_3(spark, d):
    out = add_labels(_bars(spark, d), horizon=3, **ZERO)
    return out.select("ts_hour", "close_1h", "close_future", "return_future", "label_up")


def q_labels_threshold(spark, d):
    """Q8/Q9: the label threshold is a parameter (0.5 % here, still strict)."""
    out = add_labels(_bars(spark, d), threshold=0.005, **ZERO)
    return out.select("ts_hour", "close_1h", "close_future", "return_future", "label_up")


def q_labels_large_keyed(spark, d):
    out = add_labels(_large_bars(spark, d), keys=["l_suppkey"], ts="ts_day", close="close_1d", **DAY)
    return out.select("l_suppkey", "ts_day", "close_1d", "close_future", "return_future", "label_up")


# ---------------------------------------------------------------- activity, joins
def q_activity_hourly(spark, d):
    return tables.activity(spark, d)


def q_activity_total_blocks(spark, d):
    return total_blocks(tables.activity(spark, d))


def q_price_activity_left_join(spark, d):
    act = _activity(spark, d).select("ts_hour", "block_count", "tx_count_hour")
    return _int_as_double(_round(join_activity(_bars(spark, d), act), NOISY_BAR))


def q_price_activity_buckets(spark, d):
    """J1 over tables that are stored by the hash of the join key: no side is shuffled or broadcast."""
    act = _activity(spark, d).select("ts_hour", "block_count", "tx_count_hour")
    stored = [write_buckets(df, scratch_path(spark, name), ["ts_hour"], 8) for name, df in (("bars", _bars(spark, d)), ("activity", act))]
    return _int_as_double(_round(join_buckets(spark, *stored), NOISY_BAR))


def q_price_without_activity(spark, d):
    return _round(join_activity(_bars(spark, d), None), NOISY_BAR)


# ---------------------------------------------------------------- feature table
def q_feature_dataset(spark, d):
    return _int_as_double(_round(_features(spark, d, event_type="view"), NOISY_BAR + NOISY_IND))


def q_feature_dataset_15min(spark, d):
    noisy = ["vol_15m", "volatility_15m", "ret_15m", "ret_15m_lag1", "ret_15m_lag2", "ma_close_3x15m", "ma_close_12x15m",
             "vol_24x15m"]
    return _int_as_double(_round(_features(spark, d, size="15 minutes", event_type="view"), noisy))


def q_feature_dataset_keyed(spark, d):
    return _int_as_double(_round(_features(spark, d, keyed=True, event_type="view"), NOISY_BAR + NOISY_IND))


def q_features_incremental(spark, d):
    """The keyed feature table in two runs: half a month of ticks, then the rest and what the first run has left."""
    ticks, cut = tables.ticks(spark, d, keyed=True), "2024-01-16"
    kw = {"keys": ["event_type"], "activity": _activity(spark, d), **ZERO}
    first, carry = features_step(ticks.where(F.col("ts_raw") < F.lit(cut)), **kw)
    second, _ = features_step(ticks.where(F.col("ts_raw") >= F.lit(cut)), carry, **kw)
    return _int_as_double(_round(first.unionByName(second), NOISY_BAR + NOISY_IND))


# ---------------------------------------------------------------- sources
def q_csv_candles(spark, d):
    """Ticks written as a candle CSV (padded time text, source column names, an extra column), read back."""
    ev = tables.table(spark, d, "events")
    v = F.col("value").cast("string")
    raw = ev.select(
        F.concat(F.lit("  "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" ")).alias("Open time"),
        v.alias("Open"), v.alias("High"), v.alias("Low"), v.alias("Close"), v.alias("Volume"),
        F.col("event_type").alias("Ignore"),
    )
    path = scratch_path(spark, "candles_csv")
    raw.write.mode("overwrite").option("header", True).csv(path)
    out = load_candles_csv(spark, path)
    return out.withColumn("ts_raw", F.col("ts_raw").cast("timestamp_ntz"))


def q_activity_detect_ts(spark, d):
    """Activity Parquet with ``Date`` and ``Timestamp`` text columns: ``Timestamp`` is detected and bucketed."""
    act = tables.activity(spark, d)
    path = scratch_path(spark, "activity_parquet")
    act.select(F.col("timestamp").alias("Timestamp"), F.substring("timestamp", 1, 10).alias("Date"),
               "block_count", "tx_count_hour").write.mode("overwrite").parquet(path)
    loaded = load_activity(spark, path)
    return loaded.select(F.col("ts_hour").cast("timestamp_ntz").alias("ts_hour"), "block_count", "tx_count_hour")


def q_activity_mixed_files(spark, d):
    """One folder with files of two producers, transactions as integers in one and doubles in the other; ``Timestamp`` in one more column order."""
    act, path = tables.activity(spark, d).drop("ts_hour"), scratch_path(spark, "activity_mixed")
    early = F.col("timestamp") < F.lit("2024-01-16")
    act.where(early).withColumn("tx_count_hour", F.col("tx_count_hour").cast("bigint")).write.parquet(f"{path}/a")
    act.where(~early).select("block_count", "tx_count_hour", "total_value_hour", "timestamp").write.parquet(f"{path}/b")
    loaded = load_activity(spark, path, mixed=True)
    return loaded.select("timestamp", "total_value_hour", "tx_count_hour", "block_count", F.col("ts_hour").cast("timestamp_ntz").alias("ts_hour"))


def q_activity_new_files(spark, d):
    """Two scans of a growing folder by its ledger: the second reads only the files that came since, all rows come once."""
    act, path = tables.activity(spark, d), scratch_path(spark, "activity_growing")
    folder, ledger, store = f"{path}/in", f"{path}/ledger", f"{path}/store"
    early = F.col("timestamp") < F.lit("2024-01-16")
    for part in (early, ~early):
        act.where(part).drop("ts_hour").write.mode("append").parquet(folder)
        rows, files = scan_new(spark, folder, ledger, lambda paths: read_reconciled(spark, paths))
        rows.write.mode("append").parquet(store)
        files.commit()
    return load_activity(spark, store).select("timestamp", "total_value_hour", "tx_count_hour", "block_count", F.col("ts_hour").cast("timestamp_ntz").alias("ts_hour"))


def q_date_range_filter(spark, d):
    ev = tables.table(spark, d, "events")
    v = F.col("value").cast("string")
    raw = ev.select(F.col("ts").cast("string").alias("Open time"), v.alias("Open"), v.alias("High"),
                    v.alias("Low"), v.alias("Close"), v.alias("Volume"))
    out = normalize_candles(raw, start="2024-01-05", end="2024-01-20")
    return out.withColumn("ts_raw", F.col("ts_raw").cast("timestamp_ntz"))


def q_candles_parquet_pruned(spark, d):
    """Ticks landed as date-partitioned Parquet, read back with date bounds (partition pruning)."""
    path = scratch_path(spark, "candles_parquet")
    land_candles(tables.ticks(spark, d), path)
    out = load_candles_parquet(spark, path, start="2024-01-05", end="2024-01-20")
    return out.withColumn("ts_raw", F.col("ts_raw").cast("timestamp_ntz"))


# ---------------------------------------------------------------- resampling
def q_daily_to_hourly_ffill(spark, d):
    return resample_ffill(tables.daily(spark, d), ts="Date")


def q_ffill_offgrid(spark, d):
    """Observations at any time, several in one step or none, filled onto 15 minutes."""
    seen = tables.table(spark, d, "events").select("event_type", F.col("ts"), "value")
    return resample_ffill(seen, ts="ts", keys=["event_type"], step="15 minutes")


def q_daily_proxy(spark, d):
    return daily_to_hourly_proxy(tables.daily(spark, d), ts="Date")


# ---------------------------------------------------------------- preparation
def _prepared(spark, d, event_type=None):
    feats = _features(spark, d, event_type=event_type)
    cols = select_features(feats.columns)
    return apply_null_policy(feats, cols), cols


def q_null_policy(spark, d):
    prep, cols = _prepared(spark, d, "view")
    return _round(prep.select("ts_hour", *cols, "label_up"), [c for c in cols if c in NOISY_BAR + NOISY_IND])


def q_time_split_counts(spark, d):
    prep, _ = _prepared(spark, d)
    return split_counts(prep, TRAIN_END, TEST_START)


def q_time_split_counts_raw(spark, d):
    """A4 before the null policy: split sizes of the labelled table as built."""
    return split_counts(_features(spark, d), TRAIN_END, TEST_START)


def q_time_split_train(spark, d):
    prep, _ = _prepared(spark, d)
    train, _ = time_split(prep, TRAIN_END, TEST_START)
    return train.select("ts_hour", "label_up")


def q_time_split_test(spark, d):
    prep, _ = _prepared(spark, d)
    _, test = time_split(prep, TRAIN_END, TEST_START)
    return test.select("ts_hour", "label_up")


# ---------------------------------------------------------------- ML
def q_standardised_features(spark, d):
    prep, cols = _prepared(spark, d)
    fitted = classifier_pipeline(cols).getStages()[:2]
    from pyspark.ml import Pipeline

    model = Pipeline(stages=fitted).fit(prep)
    arr = vector_to_array(F.col("features"))
    out = model.transform(prep).select("ts_hour", *[arr[i].alias(f"z_{c}") for i, c in enumerate(cols)])
    return _round(out, [f"z_{c}" for c in cols])


def _scored_events(spark, d):
    ev = tables.table(spark, d, "events")
    return ev.select(
        F.col("value").alias("score"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label_up"),
        F.when(F.col("value") > 100, 1.0).otherwise(0.0).alias("prediction"),
        F.col("ts"),
    )


def q_auc_fixed_score(spark, d):
    auc = auc_roc(_scored_events(spark, d), raw="score")
    return spark.createDataFrame([(auc,)], "auc_roc double").select(F.round("auc_roc", 9).alias("auc_roc"))


def q_auc_by_ranks(spark, d):
    """M8 by its definition, over running totals of distinct scores."""
    return auc_by_ranks(_scored_events(spark, d), label="label_up", score="score").select(F.round("auc_roc", 9).alias("auc_roc"))


def q_running_totals(spark, d):
    """All ticks in order of time and id: their position, and the value and the users before each."""
    ev = tables.table(spark, d, "events").select("event_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"), "user_id")
    out = with_running_totals(ev, ["ts", "event_id"], {"value_before": F.col("value"), "users_before": F.col("user_id")}, position="position")
    return out.select("event_id", "ts", F.col("value_before").cast("double").alias("value_before"), "users_before", "position")


def q_accuracy_fixed_score(spark, d):
    acc = accuracy(_scored_events(spark, d))
    return spark.createDataFrame([(acc,)], "accuracy double").select(F.round("accuracy", 9).alias("accuracy"))


def _train(spark, d, model_type, params, keyed=False):
    """Ticks + activity -> features -> split -> fit -> metrics, and what must hold for any trained model.

    The metrics are compared with rank and share formulas over the same scores; probabilities must add up to 1. A
    linear model without a penalty must meet its first-order condition, trees their number and depth.
    """
    run_params = RunParams(TRAIN_END, TEST_START, model_type, params, keys=("event_type",) if keyed else (), **ZERO)
    features = materialize(_features(spark, d, keyed), "prepared")
    train, test = time_split(features, TRAIN_END, TEST_START)
    metrics, model = train_and_evaluate(train, test, run_params)
    m = metrics.first()
    cols = select_features(features.columns)
    p = vector_to_array("probability")
    scored = model.transform(apply_null_policy(test, cols)).select("label_up", "prediction", p[1].alias("score"), (p[0] + p[1]).alias("total")).persist()
    share = scored.agg(F.avg((F.col("label_up") == F.col("prediction")).cast("double")).alias("a"), F.max(F.abs(F.col("total") - 1)).alias("t")).first()
    checks = {"n_train": m["n_train"], "n_test": m["n_test"], "accuracy_is_share": abs(m["accuracy"] - share["a"]) < 1e-9,
              "auc_is_by_ranks": abs(m["auc_roc"] - auc_by_ranks(scored, label="label_up", score="score").first()[0]) < 1e-9, "probabilities_add_up": share["t"] < 1e-9}
    scored.unpersist()
    fitted = model.stages[-1]
    if model_type == "logistic_regression":
        seen = model.transform(apply_null_policy(train, cols)).select((vector_to_array("probability")[1] - F.col("label_up")).alias("e"), vector_to_array("features").alias("x"))
        slopes = seen.agg(F.avg("e").alias("c"), *[F.avg(F.col("e") * F.col("x")[i]).alias(f"g{i}") for i in range(len(cols))]).first()
        checks["at_optimum"] = max(map(abs, slopes)) < 1e-3
    else:
        checks |= {"n_trees": fitted.getNumTrees, "depth_kept": max(t.depth for t in fitted.trees) <= fitted.getOrDefault("maxDepth")}
    return spark.createDataFrame([tuple(checks.values())], list(checks))


def q_train_logistic_keyed(spark, d):
    """C3 over keyed series: bars, indicators and labels per event type, one model across all of them."""
    return _train(spark, d, "logistic_regression", {}, keyed=True)


def q_run_config(spark, d):
    """C3 from a configuration: candle CSV and activity Parquet to metrics CSV and model, read back from there."""
    path, v = scratch_path(spark, "configured"), F.col("value").cast("string")
    tables.table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Open time"), v.alias("Open"), v.alias("High"),
                                            v.alias("Low"), v.alias("Close"), v.alias("Volume")).write.option("header", True).csv(f"{path}/candles")
    tables.activity(spark, d).drop("ts_hour").write.parquet(f"{path}/activity")
    cfg = {"data": {"price_path": f"{path}/candles", "blockchain_path": f"{path}/activity"}, "features": {"use_blockchain": True},
           "model": {"type": "logistic_regression"}, "train": {"train_end_date": TRAIN_END, "test_start_date": TEST_START},
           "output": {"metrics_csv": f"{path}/metrics", "models_dir": f"{path}/models"}}
    run_config(spark, cfg, **ZERO)
    stages = len(load_model(f"{path}/models/logistic_regression_pipeline").stages)
    between = F.col("auc_roc").between(0, 1) & F.col("accuracy").between(0, 1)
    return read_metrics_csv(spark, f"{path}/metrics").select("n_train", "n_test", between.alias("metrics_valid"), F.lit(stages).alias("n_stages"))


def q_class_share(spark, d):
    """Majority-class baseline of the test split, to read next to an accuracy."""
    _, test = time_split(_features(spark, d), TRAIN_END, TEST_START)
    return class_share(test).select(F.round("positive_share", 9).alias("positive_share"))


def q_train_logistic(spark, d):
    return _train(spark, d, "logistic_regression", {})


def q_train_gbt(spark, d):
    return _train(spark, d, "gbt", {})  # defaults of the source pipeline: depth 5, 50 iterations


def q_train_forest(spark, d):
    # The recorded configuration of the source pipeline: 150 trees, depth 7, seed 42.
    return _train(spark, d, "random_forest", {"numTrees": 150, "maxDepth": 7, "seed": 42})


# ---------------------------------------------------------------- sinks (K1-K4)
def q_metrics_csv_roundtrip(spark, d):
    scored = _scored_events(spark, d)
    counts = scored.agg(F.count_if(F.col("ts") < F.lit(TEST_START)).alias("a"),
                        F.count_if(F.col("ts") >= F.lit(TEST_START)).alias("b")).first()
    metrics = metrics_frame(spark, auc_roc(scored, raw="score"), accuracy(scored), counts["a"], counts["b"])
    path = scratch_path(spark, "metrics_csv")
    write_metrics_csv(metrics, path)
    back = read_metrics_csv(spark, path)
    return back.select(F.round("auc_roc", 9).alias("auc_roc"), F.round("accuracy", 9).alias("accuracy"),
                       "n_train", "n_test")


def q_feature_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "features")
    write_features(_features(spark, d, event_type="view"), path)
    return _int_as_double(_round(spark.read.parquet(path), NOISY_BAR + NOISY_IND))


def q_features_published(spark, d):
    """The feature table published by date, and its second half again: dates are replaced, every row is there once."""
    features, table = materialize(_features(spark, d, event_type="view"), "features"), PublishedTable(spark, scratch_path(spark, "published"))
    table.write(features, F.to_date("ts_hour"), sort_by=("ts_hour",))
    table.write(features.where(F.col("ts_hour") >= F.lit("2024-01-16")), F.to_date("ts_hour"), sort_by=("ts_hour",))
    return _int_as_double(_round(table.read(), NOISY_BAR + NOISY_IND))


def q_published_counts(spark, d):
    """A3, A4: blocks, and sizes of the splits, from the files that a publication has written: tables aren't computed again."""
    root = scratch_path(spark, "counted")
    stats = PublishedTable(spark, f"{root}/stats").write(tables.activity(spark, d), F.to_date("ts_hour"), counts={"n_blocks": F.sum("block_count")})
    at, early, late = F.col("ts_hour"), F.lit(TRAIN_END).cast("timestamp_ntz"), F.lit(TEST_START).cast("timestamp_ntz")
    split = {"n_train": F.count_if(at <= early), "n_test": F.count_if(at >= late), "n_gap": F.count_if((at > early) & (at < late))}
    sizes = PublishedTable(spark, f"{root}/features").write(_features(spark, d), F.to_date("ts_hour"), counts=split)
    return spark.createDataFrame([(stats["n_blocks"], sizes["n_train"], sizes["n_test"], sizes["n_gap"])], "n_blocks long, n_train long, n_test long, n_gap long")


def q_features_file_order(spark, d):
    """O1: the feature table is in order of time and series over all its files."""
    path = scratch_path(spark, "features")
    write_features(_features(spark, d, keyed=True), path, keys=["event_type"])
    return file_positions(spark, path, "ts_hour", "event_type")


def q_stats_file_order(spark, d):
    """O2: the hourly statistics are in order of time."""
    path = scratch_path(spark, "hourly_stats")
    write_hourly_stats(tables.activity(spark, d), path)
    return file_positions(spark, path, "timestamp")


def q_stats_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "hourly_stats")
    write_hourly_stats(tables.activity(spark, d), path)
    return spark.read.parquet(path)


def q_proxy_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "proxy")
    write_proxy(daily_to_hourly_proxy(tables.daily(spark, d), ts="Date"), path)
    return spark.read.parquet(path)


def q_model_roundtrip(spark, d):
    """K4: how many test rows the loaded model scores, and how many just as the fitted one did."""
    features = materialize(_features(spark, d), "prepared")
    train, test = time_split(features, TRAIN_END, TEST_START)
    _, model = train_and_evaluate(train, test, RunParams(TRAIN_END, TEST_START, "logistic_regression"))
    path = scratch_path(spark, "model")
    save_model(model, path)
    prepared = apply_null_policy(test, select_features(test.columns))
    score = lambda m, name: m.transform(prepared).select("ts_hour", vector_to_array("probability").alias(name))
    both = score(model, "fitted").join(score(load_model(path), "loaded"), "ts_hour")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("fitted") == F.col("loaded")).alias("n_equal"))


# ---------------------------------------------------------------- raw block files
def _block_stats(spark, d, method="stream"):
    ev = tables.table(spark, d, "events")
    rows = ev.select(epoch_seconds_ntz("ts").alias("block_time"), F.col("user_id").alias("tx_count"))
    path = scratch_path(spark, "blocks")
    write_block_files(rows, path)
    return hourly_block_stats(read_block_files(spark, path, method=method))


def q_block_files_hourly(spark, d):
    return _block_stats(spark, d)


def q_block_files_hourly_binary(spark, d):
    """The same, read by Spark's ``binaryFile`` source instead of the Python data source."""
    return _block_stats(spark, d, method="binaryFile")


def q_block_files_split(spark, d):
    """Files cut into ranges of 16 KiB: many tasks read one file."""
    ev = tables.table(spark, d, "events")
    path = scratch_path(spark, "blocks")
    write_block_files(ev.select(epoch_seconds_ntz("ts").alias("block_time"), F.col("user_id").alias("tx_count")), path)
    return hourly_block_stats(read_block_files(spark, path, split_bytes=16 << 10))


def q_block_files_total(spark, d):
    return total_blocks(_block_stats(spark, d))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_bars": q_hourly_bars,
    "hourly_bars_keyed": q_hourly_bars_keyed,
    "daily_bars_large": q_daily_bars_large,
    "bars_15min": q_bars_15min,
    "truncated_hours": q_truncated_hours,
    "bars_tied_ticks": q_bars_tied_ticks,
    "bars_from_state": q_bars_from_state,
    "prev_close_log_return": q_prev_close_log_return,
    "lagged_returns": q_lagged_returns,
    "moving_averages": q_moving_averages,
    "rolling_volatility": q_rolling_volatility,
    "time_frames_keyed": q_time_frames_keyed,
    "time_frames_15min_blocked": q_time_frames_15min_blocked,
    "long_frames": q_long_frames,
    "long_frames_keyed": q_long_frames_keyed,
    "high_low_ratio": q_high_low_ratio,
    "indicators": q_indicators,
    "indicators_custom": q_indicators_custom,
    "indicators_keyed": q_indicators_keyed,
    "indicators_blocked": q_indicators_blocked,
    "indicators_partitioned": q_indicators_partitioned,
    "indicators_large_keyed": q_indicators_large_keyed,
    "indicators_keyed_blocked": q_indicators_keyed_blocked,
    "labels": q_labels,
    "labels_horizon_3": q_labels_horizon_3,
    "labels_threshold": q_labels_threshold,
    "labels_large_keyed": q_labels_large_keyed,
    "activity_hourly": q_activity_hourly,
    "activity_total_blocks": q_activity_total_blocks,
    "price_activity_left_join": q_price_activity_left_join,
    "price_activity_buckets": q_price_activity_buckets,
    "price_without_activity": q_price_without_activity,
    "feature_dataset": q_feature_dataset,
    "feature_dataset_15min": q_feature_dataset_15min,
    "feature_dataset_keyed": q_feature_dataset_keyed,
    "features_incremental": q_features_incremental,
    "csv_candles": q_csv_candles,
    "activity_detect_ts": q_activity_detect_ts,
    "activity_mixed_files": q_activity_mixed_files,
    "activity_new_files": q_activity_new_files,
    "date_range_filter": q_date_range_filter,
    "candles_parquet_pruned": q_candles_parquet_pruned,
    "daily_to_hourly_ffill": q_daily_to_hourly_ffill,
    "daily_proxy": q_daily_proxy,
    "ffill_offgrid": q_ffill_offgrid,
    "null_policy": q_null_policy,
    "time_split_counts": q_time_split_counts,
    "time_split_counts_raw": q_time_split_counts_raw,
    "time_split_train": q_time_split_train,
    "time_split_test": q_time_split_test,
    "standardised_features": q_standardised_features,
    "auc_fixed_score": q_auc_fixed_score,
    "auc_by_ranks": q_auc_by_ranks,
    "running_totals": q_running_totals,
    "accuracy_fixed_score": q_accuracy_fixed_score,
    "class_share": q_class_share,
    "train_logistic": q_train_logistic,
    "train_logistic_keyed": q_train_logistic_keyed,
    "train_gbt": q_train_gbt,
    "train_forest": q_train_forest,
    "run_config": q_run_config,
    "metrics_csv_roundtrip": q_metrics_csv_roundtrip,
    "feature_parquet_roundtrip": q_feature_parquet_roundtrip,
    "features_file_order": q_features_file_order,
    "features_published": q_features_published,
    "published_counts": q_published_counts,
    "stats_parquet_roundtrip": q_stats_parquet_roundtrip,
    "stats_file_order": q_stats_file_order,
    "proxy_parquet_roundtrip": q_proxy_parquet_roundtrip,
    "model_roundtrip": q_model_roundtrip,
    "block_files_hourly": q_block_files_hourly,
    "block_files_hourly_stream": q_block_files_hourly,
    "block_files_hourly_binary": q_block_files_hourly_binary,
    "block_files_total": q_block_files_total,
    "block_files_split": q_block_files_split,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the labelled feature table (bars, indicators, activity join, labels) on sf0.001."""
    return q_feature_dataset(spark, SF_SMOKE)


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and oracles of the training-data subpackage and its pipeline; none where those aren't installed."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracles: dict[str, str] = {}
    if find_spec("tickwork.llm") and find_spec("tickwork.llm.queries"):  # an error in what is there isn't an absence
        from tickwork.llm import queries as llm

        found, oracles = dict(llm.QUERIES), dict(llm.ORACLES)
        if find_spec("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _llm()[0]


# ====================================================================== oracle SQL (DuckDB)
def _ratio(a: str, b: str) -> str:
    return f"({a} / nullif({b}, 0))"


def _ln(a: str, b: str) -> str:
    return f"ln(CASE WHEN {_ratio(a, b)} > 0 THEN {_ratio(a, b)} END)"


_BARS_BODY = """
  SELECT date_trunc('hour', ts) AS ts_hour,
         arg_min(value, (ts, value)) AS open_1h, arg_max(value, (ts, value)) AS close_1h,
         max(value) AS high_1h, min(value) AS low_1h,
         sum(value) AS vol_1h, stddev_pop(value) AS volatility_1h
  FROM events GROUP BY date_trunc('hour', ts)"""
_BARS_KEYED_BODY = """
  SELECT event_type, date_trunc('hour', ts) AS ts_hour,
         arg_min(value, (ts, value)) AS open_1h, arg_max(value, (ts, value)) AS close_1h,
         max(value) AS high_1h, min(value) AS low_1h,
         sum(value) AS vol_1h, stddev_pop(value) AS volatility_1h
  FROM events GROUP BY event_type, date_trunc('hour', ts)"""
_LARGE_BODY = """
  SELECT l_suppkey, date_trunc('day', l_shipdate) AS ts_day,
         arg_min(l_extendedprice, (l_shipdate, l_extendedprice)) AS open_1d,
         arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) AS close_1d,
         max(l_extendedprice) AS high_1d, min(l_extendedprice) AS low_1d,
         sum(l_quantity) AS vol_1d, stddev_pop(l_extendedprice) AS volatility_1d
  FROM lineitem GROUP BY l_suppkey, date_trunc('day', l_shipdate)"""
_ACT_BODY = """
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS timestamp,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value_hour,
         CAST(sum(user_id) AS DOUBLE) AS tx_count_hour,
         count(*) AS block_count,
         date_trunc('hour', ts) AS ts_hour
  FROM events WHERE event_type = 'view' GROUP BY date_trunc('hour', ts)"""
_ACT_ALL = _ACT_BODY.replace(" WHERE event_type = 'view'", "")
_DAILY_BODY = """
  SELECT o_orderdate AS Date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS Volume
  FROM orders GROUP BY o_orderdate"""
_FFILL_BODY = f"""
  SELECT unnest(generate_series(Date, COALESCE(nx - INTERVAL 1 HOUR, Date), INTERVAL 1 HOUR)) AS Date, Volume
  FROM (SELECT Date, Volume, lead(Date) OVER (ORDER BY Date) AS nx FROM ({_DAILY_BODY}) d) n"""


def _ind_body(bars: str, part: str = "", ts: str = "ts_hour", s: str = "1h", u: str = "h") -> str:
    """Indicator set over a bars CTE (``part`` = PARTITION BY clause or empty)."""
    w = f"({part} ORDER BY {ts})"
    return f"""
  SELECT *, lag(ret_1h, 1) OVER {w} AS ret_1h_lag1, lag(ret_1h, 2) OVER {w} AS ret_1h_lag2,
         avg(close_{s}) OVER ({part} ORDER BY {ts} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ma_close_3{u},
         avg(close_{s}) OVER ({part} ORDER BY {ts} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma_close_12{u},
         stddev_samp(close_{s}) OVER ({part} ORDER BY {ts} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS vol_24{u}
  FROM (SELECT *, {_ln(f'close_{s}', f'lag(close_{s}, 1) OVER {w}')} AS ret_1h, {_ratio(f'high_{s}', f'low_{s}')} AS high_low_ratio
        FROM {bars}) r"""


def _r(c: str, n: int = 6) -> str:
    return f"(round({c}, {n}) + 0.0) AS {c}"  # + 0.0 maps DuckDB's -0.0 to Spark's 0.0


_BAR_SEL = "open_1h, close_1h, high_1h, low_1h, " + ", ".join(_r(c) for c in NOISY_BAR)
def _ind_select(prefix: str = "") -> str:
    return (f"{prefix}ts_hour, {_BAR_SEL}, {_r('ret_1h')}, high_low_ratio, {_r('ret_1h_lag1')}, "
            f"{_r('ret_1h_lag2')}, {_r('ma_close_3h')}, {_r('ma_close_12h')}, {_r('vol_24h')}")


def _features_sql(keyed: bool, rounded: bool = True, activity: str = _ACT_BODY) -> str:
    part = "PARTITION BY event_type" if keyed else ""
    bars = f"({_BARS_KEYED_BODY if keyed else _BARS_BODY}) b"
    prefix = "event_type, " if keyed else ""
    head = _ind_select(prefix) if rounded else f"{prefix}ts_hour, {', '.join(BAR_COLS)}, " + ", ".join(
        ["ret_1h", "high_low_ratio", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3h", "ma_close_12h", "vol_24h"])
    return f"""
WITH f AS ({_ind_body(bars, part)}),
     l AS (SELECT *, lead(close_1h, 1) OVER ({part} ORDER BY ts_hour) AS close_future FROM f),
     a AS ({activity}),
     j AS (SELECT l.*, a.timestamp, a.total_value_hour, a.tx_count_hour,
                  CAST(a.block_count AS DOUBLE) AS block_count
           FROM l LEFT JOIN a USING (ts_hour)),
     y AS (SELECT *, (close_future - close_1h) / nullif(close_1h, 0) AS return_future FROM j)
SELECT {head}, timestamp, total_value_hour, tx_count_hour, block_count,
       close_future, return_future, CAST(CASE WHEN return_future > 0.001 THEN 1 ELSE 0 END AS INTEGER) AS label_up
FROM y WHERE close_future IS NOT NULL AND NOT isnan(close_future)
         AND return_future IS NOT NULL AND NOT isnan(return_future)"""


def _prepared_sql(keyed: bool = False, activity: str = _ACT_ALL) -> str:
    feats = ["ret_1h", "vol_1h", "volatility_1h", "high_low_ratio", "ma_close_3h", "ma_close_12h"]
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in feats)
    return f"""
SELECT ts_hour, {', '.join(feats)}, COALESCE(tx_count_hour, 0.0) AS tx_count_hour, label_up
FROM ({_features_sql(keyed, rounded=False, activity=activity)}) x
WHERE {cond} AND label_up IS NOT NULL"""


def _label_sql(h: int, threshold: float = 0.001) -> str:
    return f"""
SELECT ts_hour, close_1h, close_future, return_future,
       CAST(CASE WHEN return_future > {threshold} THEN 1 ELSE 0 END AS INTEGER) AS label_up
FROM (SELECT *, (close_future - close_1h) / nullif(close_1h, 0) AS return_future
      FROM (SELECT ts_hour, close_1h, lead(close_1h, {h}) OVER (ORDER BY ts_hour) AS close_future
            FROM ({_BARS_BODY}) b) x) y
WHERE close_future IS NOT NULL AND return_future IS NOT NULL"""


_SCORED = """
SELECT value AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label_up,
       CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END AS prediction, ts
FROM events"""
_AUC = f"""
WITH s AS ({_SCORED}),
     r AS (SELECT label_up, rank() OVER (ORDER BY score) AS rk, count(*) OVER (PARTITION BY score) AS c FROM s),
     t AS (SELECT sum(label_up) AS p, count(*) - sum(label_up) AS n,
                  sum(CASE WHEN label_up = 1 THEN CAST(rk AS DOUBLE) + (c - 1) / 2.0 ELSE 0.0 END) AS rs FROM r)
SELECT round(CAST((rs - CAST(p AS DOUBLE) * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n) AS DOUBLE), 9) AS auc_roc
FROM t"""
_ACC = f"""SELECT round(CAST(avg(CASE WHEN prediction = label_up THEN 1.0 ELSE 0.0 END) AS DOUBLE), 9) AS accuracy
FROM ({_SCORED}) s"""

_BLOCK_STATS_SQL = """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS timestamp,
        count(*) AS block_count, CAST(sum(user_id) AS BIGINT) AS tx_count_hour,
        CAST(0.0 AS DOUBLE) AS total_value_hour
        FROM events GROUP BY date_trunc('hour', ts)"""

_LARGE_INDICATORS = f"""SELECT l_suppkey, ts_day, open_1d, close_1d, high_1d, low_1d,
        {_r('vol_1d')}, {_r('volatility_1d')}, {_r('ret_1h')}, high_low_ratio, {_r('ret_1h_lag1')},
        {_r('ret_1h_lag2')}, {_r('ma_close_3d')}, {_r('ma_close_12d')}, {_r('vol_24d')}
        FROM ({_ind_body(f'({_LARGE_BODY}) b', 'PARTITION BY l_suppkey', 'ts_day', '1d', 'd')}) i"""
_QUARTER = "date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) * 15 AS BIGINT))"
_FRAMES_SQL = """SELECT event_type, ts_hour,
        round(avg(close) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW), 9) AS ma_close_3h,
        round(avg(close) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 11 HOURS PRECEDING AND CURRENT ROW), 9) AS ma_close_12h,
        round(stddev_samp(close) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW), 9) AS vol_24h
        FROM ({bars}) b"""
_QUARTER_BARS = f"""SELECT {_QUARTER} AS ts_hour, arg_min(value, (ts, value)) AS open_15m, arg_max(value, (ts, value)) AS close_15m,
        max(value) AS high_15m, min(value) AS low_15m, sum(value) AS vol_15m, stddev_pop(value) AS volatility_15m
        FROM events GROUP BY 1"""
_QUARTER_FEATURES = f"""
WITH i AS ({_ind_body(f'({_QUARTER_BARS}) b', s='15m', u='x15m')}),
     l AS (SELECT *, lead(close_15m, 1) OVER (ORDER BY ts_hour) AS close_future FROM i),
     y AS (SELECT l.*, a.timestamp, a.total_value_hour, a.tx_count_hour, CAST(a.block_count AS DOUBLE) AS block_count,
                  (close_future - close_15m) / nullif(close_15m, 0) AS return_future
           FROM l LEFT JOIN ({_ACT_BODY}) a ON a.ts_hour = date_trunc('hour', l.ts_hour))
SELECT ts_hour, open_15m, close_15m, high_15m, low_15m, {_r('vol_15m')}, {_r('volatility_15m')},
       (round(ret_1h, 6) + 0.0) AS ret_15m, high_low_ratio, (round(ret_1h_lag1, 6) + 0.0) AS ret_15m_lag1,
       (round(ret_1h_lag2, 6) + 0.0) AS ret_15m_lag2, {_r('ma_close_3x15m')}, {_r('ma_close_12x15m')}, {_r('vol_24x15m')},
       timestamp, total_value_hour, tx_count_hour, block_count, close_future, return_future,
       CAST(CASE WHEN return_future > 0.001 THEN 1 ELSE 0 END AS INTEGER) AS label_up
FROM y WHERE close_future IS NOT NULL AND return_future IS NOT NULL"""


def _prepared_counts(body: str) -> str:
    return f"""SELECT CAST(count_if(ts_hour <= TIMESTAMP '{TRAIN_END}') AS INTEGER) AS n_train,
        CAST(count_if(ts_hour >= TIMESTAMP '{TEST_START}') AS INTEGER) AS n_test FROM ({body}) p"""


def _trained_sql(keyed: bool = False, trees: int | None = None) -> str:
    """Sizes of both sets from the tables; everything else must hold for any trained model."""
    model = "TRUE AS at_optimum" if trees is None else f"CAST({trees} AS BIGINT) AS n_trees, TRUE AS depth_kept"
    return f"""SELECT CAST(n_train AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test, TRUE AS accuracy_is_share,
        TRUE AS auc_is_by_ranks, TRUE AS probabilities_add_up, {model} FROM ({_prepared_counts(_prepared_sql(keyed))}) c"""


def _frame_figures(value: str, name: str, n: int, order: str) -> str:
    over = f"OVER ({order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (f"round(avg({value}) {over}, 6) + 0.0 AS {name}_avg_{n}, round(stddev_samp({value}) {over}, 6) + 0.0 AS {name}_stddev_{n}, "
            f"min({value}) {over} AS {name}_min_{n}, max({value}) {over} AS {name}_max_{n}")


_ORACLE: dict[str, str] = {
    "bars_tied_ticks": f"SELECT ts_hour, {_BAR_SEL} FROM ({_BARS_BODY.replace('events', "(SELECT date_trunc('minute', ts) AS ts, value FROM events) e")}) b",
    "truncated_hours": "SELECT date_trunc('hour', ts) AS ts_hour, count(*) AS n FROM events GROUP BY 1",
    "indicators_keyed_blocked": _LARGE_INDICATORS,
    "time_frames_15min_blocked": _FRAMES_SQL.format(bars=f"SELECT event_type, {_QUARTER} AS ts_hour, arg_max(value, (ts, value)) AS close FROM events GROUP BY 1, 2"),
    "feature_dataset_15min": _QUARTER_FEATURES,
    "ffill_offgrid": f"""SELECT event_type, unnest(generate_series(step, coalesce(nx - INTERVAL 15 MINUTE, step), INTERVAL 15 MINUTE)) AS ts, value
        FROM (SELECT *, lead(step) OVER (PARTITION BY event_type ORDER BY step) AS nx
              FROM (SELECT event_type, {_QUARTER} AS step, arg_max(value, (ts, value)) AS value FROM events GROUP BY 1, 2) s) n""",
    "time_split_test": f"""SELECT ts_hour, label_up FROM ({_prepared_sql()}) p
        WHERE ts_hour >= TIMESTAMP '{TEST_START}'""",
    "train_logistic": _trained_sql(),
    "train_logistic_keyed": _trained_sql(keyed=True),
    "train_gbt": _trained_sql(trees=50),
    "train_forest": _trained_sql(trees=150),
    "run_config": f"SELECT n_train, n_test, TRUE AS metrics_valid, CAST(3 AS INTEGER) AS n_stages FROM ({_prepared_counts(_prepared_sql())}) c",
    "model_roundtrip": f"SELECT CAST(n_test AS BIGINT) AS n_rows, CAST(n_test AS BIGINT) AS n_equal FROM ({_prepared_counts(_prepared_sql())}) c",
    "features_file_order": f"SELECT ts_hour, event_type, row_number() OVER (ORDER BY ts_hour, event_type) AS position FROM ({_features_sql(True, rounded=False)}) f",
    "stats_file_order": f"SELECT timestamp, row_number() OVER (ORDER BY timestamp) AS position FROM ({_ACT_ALL}) a",
    "bars_from_state": " UNION ALL ".join(f"""SELECT date_trunc('{unit}', ts) AS ts_bar, arg_min(value, (ts, value)) AS open, arg_max(value, (ts, value)) AS close,
        max(value) AS high, min(value) AS low, round(sum(value), 6) AS vol, round(stddev_pop(value), 6) AS volatility, '1 {unit}' AS size
        FROM events GROUP BY 1""" for unit in ("hour", "day")),
    "long_frames": "SELECT event_id, ts, " + ", ".join(_frame_figures("value", "v", n, "ORDER BY ts, event_id") for n in (1_000, 100_000)) + " FROM events",
    "long_frames_keyed": "SELECT l_suppkey, ts_day, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("log_close", *(f"log_{f}_500" for f in ("avg", "stddev", "min", "max")))) + f"""
        FROM (SELECT l_suppkey, ts_day, log_close, {_frame_figures("log_close", "log", 500, "PARTITION BY l_suppkey ORDER BY ts_day")}
              FROM (SELECT *, ln(close_1d) AS log_close FROM ({_LARGE_BODY}) b) l) f""",
    "hourly_bars": f"SELECT ts_hour, {_BAR_SEL} FROM ({_BARS_BODY}) b",
    "hourly_bars_keyed": f"SELECT event_type, ts_hour, {_BAR_SEL} FROM ({_BARS_KEYED_BODY}) b",
    "bars_15min": f"""SELECT ts_bar, open_15m, close_15m, high_15m, low_15m, {_r('vol_15m')}, {_r('volatility_15m')}
        FROM (SELECT date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) * 15 AS BIGINT)) AS ts_bar,
                     arg_min(value, (ts, value)) AS open_15m, arg_max(value, (ts, value)) AS close_15m, max(value) AS high_15m,
                     min(value) AS low_15m, sum(value) AS vol_15m, stddev_pop(value) AS volatility_15m
              FROM events GROUP BY 1) b""",
    "daily_bars_large": f"""SELECT l_suppkey, ts_day, open_1d, close_1d, high_1d, low_1d,
        {_r('vol_1d')}, {_r('volatility_1d')} FROM ({_LARGE_BODY}) b""",
    "prev_close_log_return": f"""SELECT ts_hour, close_1h,
        round({_ln('close_1h', 'lag(close_1h, 1) OVER (ORDER BY ts_hour)')}, 6) + 0.0 AS ret_1h FROM ({_BARS_BODY}) b""",
    "lagged_returns": f"""SELECT ts_hour, {_r('ret_1h')}, {_r('ret_1h_lag1')}, {_r('ret_1h_lag2')}
        FROM ({_ind_body(f'({_BARS_BODY}) b')}) i""",
    "moving_averages": f"""SELECT ts_hour, close_1h, {_r('ma_close_3h')}, {_r('ma_close_12h')}
        FROM ({_ind_body(f'({_BARS_BODY}) b')}) i""",
    "rolling_volatility": f"SELECT ts_hour, {_r('vol_24h')} FROM ({_ind_body(f'({_BARS_BODY}) b')}) i",
    "high_low_ratio": f"SELECT ts_hour, high_1h, low_1h, {_ratio('high_1h', 'low_1h')} AS high_low_ratio FROM ({_BARS_BODY}) b",
    "time_frames_keyed": f"""SELECT event_type, ts_hour,
        round(avg(close_1h) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW), 6) AS ma_close_3h,
        round(avg(close_1h) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 11 HOURS PRECEDING AND CURRENT ROW), 6) AS ma_close_12h,
        round(stddev_samp(close_1h) OVER (PARTITION BY event_type ORDER BY ts_hour
              RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW), 6) AS vol_24h
        FROM ({_BARS_KEYED_BODY}) b""",
    "indicators": f"SELECT {_ind_select()} FROM ({_ind_body(f'({_BARS_BODY}) b')}) i",
    "indicators_custom": f"""
SELECT ts_hour, {_r('ret_1h')}, {_r('ret_1h_lag1')}, {_r('ret_1h_lag2')}, {_r('ret_1h_lag3')},
       {_r('ma_close_5h')}, {_r('ma_close_24h')}, {_r('vol_12h')}
FROM (SELECT *, lag(ret_1h, 1) OVER w AS ret_1h_lag1, lag(ret_1h, 2) OVER w AS ret_1h_lag2,
             lag(ret_1h, 3) OVER w AS ret_1h_lag3,
             avg(close_1h) OVER (ORDER BY ts_hour ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_close_5h,
             avg(close_1h) OVER (ORDER BY ts_hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS ma_close_24h,
             stddev_samp(close_1h) OVER (ORDER BY ts_hour ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS vol_12h
      FROM (SELECT *, {_ln('close_1h', 'lag(close_1h, 1) OVER (ORDER BY ts_hour)')} AS ret_1h FROM ({_BARS_BODY}) b) r
      WINDOW w AS (ORDER BY ts_hour)) i""",
    "indicators_keyed": f"""SELECT {_ind_select('event_type, ')}
        FROM ({_ind_body(f'({_BARS_KEYED_BODY}) b', 'PARTITION BY event_type')}) i""",
    "indicators_blocked": f"SELECT {_ind_select()} FROM ({_ind_body(f'({_BARS_BODY}) b')}) i",
    "indicators_partitioned": f"""SELECT {_ind_select('event_type, ')}
        FROM ({_ind_body(f'({_BARS_KEYED_BODY}) b', 'PARTITION BY event_type')}) i""",
    "indicators_large_keyed": _LARGE_INDICATORS,
    "labels": _label_sql(1),
    "labels_horizon_3": _label_sql(3),
    "labels_threshold": _label_sql(1, 0.005),
    "labels_large_keyed": f"""
SELECT l_suppkey, ts_day, close_1d, close_future, return_future,
       CAST(CASE WHEN return_future > 0.001 THEN 1 ELSE 0 END AS INTEGER) AS label_up
FROM (SELECT *, (close_future - close_1d) / nullif(close_1d, 0) AS return_future
      FROM (SELECT l_suppkey, ts_day, close_1d,
                   lead(close_1d, 1) OVER (PARTITION BY l_suppkey ORDER BY ts_day) AS close_future
            FROM ({_LARGE_BODY}) b) x) y
WHERE close_future IS NOT NULL AND return_future IS NOT NULL""",
    "activity_hourly": _ACT_ALL,
    "activity_total_blocks": "SELECT count(*) AS n_blocks FROM events",
    "price_activity_left_join": f"""SELECT ts_hour, {_BAR_SEL}, CAST(a.block_count AS DOUBLE) AS block_count,
        a.tx_count_hour
        FROM ({_BARS_BODY}) b LEFT JOIN ({_ACT_BODY}) a USING (ts_hour)""",
    "price_activity_buckets": f"""SELECT ts_hour, {_BAR_SEL}, CAST(a.block_count AS DOUBLE) AS block_count,
        a.tx_count_hour
        FROM ({_BARS_BODY}) b LEFT JOIN ({_ACT_BODY}) a USING (ts_hour)""",
    "activity_mixed_files": _ACT_ALL,
    "activity_new_files": _ACT_ALL,
    "features_published": _features_sql(False),
    "published_counts": f"""SELECT (SELECT count(*) FROM events) AS n_blocks, CAST(count_if(ts_hour <= TIMESTAMP '{TRAIN_END}') AS BIGINT) AS n_train,
        CAST(count_if(ts_hour >= TIMESTAMP '{TEST_START}') AS BIGINT) AS n_test,
        CAST(count_if(ts_hour > TIMESTAMP '{TRAIN_END}' AND ts_hour < TIMESTAMP '{TEST_START}') AS BIGINT) AS n_gap
        FROM ({_features_sql(False, rounded=False)}) f""",
    "price_without_activity": f"SELECT ts_hour, {_BAR_SEL} FROM ({_BARS_BODY}) b",
    "feature_dataset": _features_sql(False),
    "feature_dataset_keyed": _features_sql(True),
    "features_incremental": _features_sql(True),
    "csv_candles": """SELECT ts AS ts_raw, value AS open, value AS high, value AS low, value AS close,
        value AS volume FROM events""",
    "activity_detect_ts": """SELECT date_trunc('hour', ts) AS ts_hour, count(*) AS block_count,
        CAST(sum(user_id) AS DOUBLE) AS tx_count_hour FROM events GROUP BY date_trunc('hour', ts)""",
    "date_range_filter": """SELECT ts AS ts_raw, value AS open, value AS high, value AS low, value AS close,
        value AS volume FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""",
    "candles_parquet_pruned": """SELECT ts AS ts_raw, value AS open, value AS high, value AS low, value AS close,
        value AS volume FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""",
    "daily_to_hourly_ffill": _FFILL_BODY,
    "daily_proxy": f"""SELECT strftime(Date, '%Y-%m-%d %H:%M:%S') AS timestamp,
        Volume / 24.0 AS total_value_hour, Volume / 24.0 / 10000.0 AS tx_count_hour,
        CAST(6 AS BIGINT) AS block_count FROM ({_FFILL_BODY}) f""",
    "null_policy": f"""SELECT ts_hour, {_r('ret_1h')}, {_r('vol_1h')}, {_r('volatility_1h')}, high_low_ratio,
        {_r('ma_close_3h')}, {_r('ma_close_12h')}, tx_count_hour, label_up FROM ({_prepared_sql(activity=_ACT_BODY)}) p""",
    "time_split_counts": f"""SELECT CAST(count_if(ts_hour <= TIMESTAMP '{TRAIN_END}') AS BIGINT) AS n_train,
        CAST(count_if(ts_hour >= TIMESTAMP '{TEST_START}') AS BIGINT) AS n_test,
        CAST(count_if(ts_hour > TIMESTAMP '{TRAIN_END}' AND ts_hour < TIMESTAMP '{TEST_START}') AS BIGINT) AS n_gap
        FROM ({_prepared_sql()}) p""",
    "time_split_counts_raw": f"""SELECT CAST(count_if(ts_hour <= TIMESTAMP '{TRAIN_END}') AS BIGINT) AS n_train,
        CAST(count_if(ts_hour >= TIMESTAMP '{TEST_START}') AS BIGINT) AS n_test,
        CAST(count_if(ts_hour > TIMESTAMP '{TRAIN_END}' AND ts_hour < TIMESTAMP '{TEST_START}') AS BIGINT) AS n_gap
        FROM ({_features_sql(False, rounded=False)}) f""",
    "time_split_train": f"""SELECT ts_hour, label_up FROM ({_prepared_sql()}) p
        WHERE ts_hour <= TIMESTAMP '{TRAIN_END}'""",
    "standardised_features": f"""SELECT ts_hour, {', '.join(
        f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS z_{c}"
        for c in ['ret_1h', 'vol_1h', 'volatility_1h', 'high_low_ratio', 'ma_close_3h', 'ma_close_12h',
                  'tx_count_hour'])} FROM ({_prepared_sql()}) p""",
    "class_share": f"""SELECT round(CAST(avg(CAST(label_up AS DOUBLE)) AS DOUBLE), 9) AS positive_share
        FROM ({_features_sql(False, rounded=False)}) f WHERE ts_hour >= TIMESTAMP '{TEST_START}'""",
    "auc_fixed_score": _AUC,
    "auc_by_ranks": _AUC,
    "running_totals": """SELECT event_id, ts, CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) OVER w, 0) AS DOUBLE) AS value_before,
        CAST(coalesce(sum(user_id) OVER w, 0) AS BIGINT) AS users_before, row_number() OVER (ORDER BY ts, event_id) AS position
        FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "accuracy_fixed_score": _ACC,
    "metrics_csv_roundtrip": f"""SELECT a.auc_roc, b.accuracy, c.n_train, c.n_test FROM ({_AUC}) a, ({_ACC}) b,
        (SELECT CAST(count_if(ts < TIMESTAMP '{TEST_START}') AS INTEGER) AS n_train,
                CAST(count_if(ts >= TIMESTAMP '{TEST_START}') AS INTEGER) AS n_test FROM events) c""",
    "feature_parquet_roundtrip": _features_sql(False),
    "stats_parquet_roundtrip": f"""SELECT timestamp, block_count, CAST(tx_count_hour AS BIGINT) AS tx_count_hour,
        total_value_hour FROM ({_ACT_ALL}) a""",
    "proxy_parquet_roundtrip": f"""SELECT strftime(Date, '%Y-%m-%d %H:%M:%S') AS timestamp,
        Volume / 24.0 AS total_value_hour, Volume / 24.0 / 10000.0 AS tx_count_hour,
        CAST(6 AS BIGINT) AS block_count FROM ({_FFILL_BODY}) f""",
    "block_files_hourly": _BLOCK_STATS_SQL,
    "block_files_hourly_stream": _BLOCK_STATS_SQL,
    "block_files_hourly_binary": _BLOCK_STATS_SQL,
    "block_files_total": "SELECT count(*) AS n_blocks FROM events",
    "block_files_split": _BLOCK_STATS_SQL,
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    return _ORACLE | _llm()[1]
