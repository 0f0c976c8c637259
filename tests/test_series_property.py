"""Property: the block + halo layout returns exactly what the plain window returns."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickwork.operators import PARTITIONED, Layout, add_indicators, add_labels

BASE = dt.datetime(2024, 1, 1)


@st.composite
def series(draw):
    n_keys = draw(st.integers(1, 3))
    rows = []
    for k in range(n_keys):
        n = draw(st.integers(1, 60))
        gaps = draw(st.lists(st.integers(1, 40), min_size=n, max_size=n))
        closes = draw(st.lists(st.integers(1, 500), min_size=n, max_size=n))
        t = 0
        for g, c in zip(gaps, closes):
            t += g
            rows.append((f"k{k}", BASE + dt.timedelta(hours=t), float(c), float(c) + 1.0, float(c) / 2))
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(data=series(), block_rows=st.integers(1, 40), chunk=st.sampled_from(["day", "week", "month"]),
       horizon=st.integers(1, 4))
def test_blocked_equals_plain(spark, data, block_rows, chunk, horizon):
    bars = spark.createDataFrame(data, "k string, ts_hour timestamp_ntz, close_1h double, high_1h double, low_1h double")
    lay = Layout(block_rows=block_rows, chunk=chunk)
    cols = ["k", "ts_hour", "ret_1h", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3h", "ma_close_12h", "vol_24h",
            "close_future", "label_up"]

    def run(layout):
        out = add_labels(add_indicators(bars, keys=["k"], layout=layout), keys=["k"], horizon=horizon, layout=layout)
        return sorted(tuple(r[c] for c in cols) for r in out.collect())

    a, b = run(lay), run(PARTITIONED)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:2] == y[:2]
        for u, v in zip(x[2:], y[2:]):
            assert (u is None and v is None) or abs(u - v) <= 1e-9 * max(1.0, abs(v))
