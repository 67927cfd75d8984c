"""Running aggregates of many series at once, and the state of a group of series over several batches."""

import datetime

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from helpers import MIN, T0
from test_streaming import FAR, Feed, run

from pointloom.plans.queries import ALL
from pointloom.streaming.snapshots import stream_snapshots, stream_ticks
from pointloom.streaming.state import running, stream_device_state


def test_running_over_many_runs():
    rng = np.random.default_rng(3)
    value = rng.normal(size=2000)
    value[rng.random(2000) < 0.05], value[rng.random(2000) < 0.05], value[rng.random(2000) < 0.02] = np.nan, np.inf, -np.inf
    number = np.cumsum(rng.random(2000) < 0.2)
    got = pd.DataFrame(running(value, number))
    with np.errstate(invalid="ignore"):
        for r in np.unique(number):
            v, made = value[number == r], got[number == r]
            want = {"first": np.full(len(v), v[0]), "max": np.maximum.accumulate(v), "min": np.fmin.accumulate(v), "sum": np.cumsum(v)}
            for a, w in want.items():
                np.testing.assert_allclose(made[a], w, atol=1e-12)
            assert made["count"].tolist() == list(range(1, len(v) + 1))


def test_series_of_a_group_are_independent_over_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pointloom.streaming.state.GROUPS", 2)  # many series in a group
    feed = Feed(spark, tmp_path / "in")
    rows = [(f"D{i}", p, 10 * i + k, k * 25 * MIN, 100 * i + k) for i in range(6) for k, p in enumerate("abaaba") if (i + k) % 4]
    for k in range(6):  # a batch for each time, some series silent in each
        feed.add([r for r in rows if r[3] == k * 25 * MIN] + [("S", "s", 0, k * 25 * MIN + 20 * MIN, 10_000 + k)])
    feed.add([("S", "s", 0, FAR, 20_000)])
    ticks = stream_device_state(stream_ticks(stream_snapshots(feed.stream())))
    run(ticks.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("tick_ms")
    got = got[got["device_id"] != "S"]
    assert got["tick_ms"].min() > T0 and len(got) == 15 * len(rows)
    for _, g in got.groupby(["device_id", "property_name"]):
        value = g["value"].to_numpy()
        for unit, period in (("hour", g["snapshot_ms"] // 3_600_000), ("total", g["snapshot_ms"] * 0)):
            for p in period.unique():
                at, v = (period == p).to_numpy(), value[(period == p).to_numpy()]
                assert (g[f"{unit}_first"][at] == v[0]).all() and (g[f"{unit}_sum"][at] == np.cumsum(v)).all()
                assert (g[f"{unit}_max"][at] == np.maximum.accumulate(v)).all() and g[f"{unit}_count"][at].tolist() == list(range(1, len(v) + 1))


def test_query_writes_only_its_columns(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(hours=12 * i), i % 2, "click", float(i), "{}") for i in range(8)]  # 3.6 minutes apart in the stream
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING").write.parquet(str(tmp_path / "events.parquet"))
    got = ALL["stream_device_state"](spark, str(tmp_path))
    want = ["tick_ms", "snapshot_ms", "company_id", "device_id", "property_name", "day_diff", "day_avg"]
    assert got.columns == want and got.count() > 0
    assert all(pq.read_schema(f.removeprefix("file://")).names == want for f in got.inputFiles())
