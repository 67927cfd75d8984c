"""Stream against batch, late rows, restart from the checkpoint."""

import json
import random
import time

from helpers import MIN, T0, readings, results, rule, rules
from pyspark.sql import functions as F

from pointloom.operators.snapshot import latest_snapshot, snapshot_ticks
from pointloom.plans.engine import derive
from pointloom.schemas import READING
from pointloom.sources.telemetry import decode, to_readings
from pointloom.streaming.job import derive_stream, telemetry_stream
from pointloom.streaming.snapshots import stream_snapshots

FAR = 10 * 24 * 60 * MIN


class Feed:
    """A folder of reading files; each `add` is one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0

    def add(self, rows):
        self.n += 1
        readings(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)
        time.sleep(0.05)

    def stream(self):
        return self.spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(self.path)


def run(writer):
    q = writer.trigger(availableNow=True).start()
    assert q.awaitTermination(300) and q.exception() is None
    return q


def test_snapshots_and_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    first = [("D0", "a", 1, 0, 0), ("D0", "a", 2, 3 * MIN, 1), ("D1", "a", 5, 2 * MIN, 2), ("D0", "b", 7, 20 * MIN, 3)]
    feed.add(first)

    def job():
        return (
            stream_snapshots(feed.stream()).writeStream.outputMode("append").format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        )

    run(job())
    # the watermark stands at 19.5 min: windows up to minute 19 are closed, those from minute 20 on are open
    feed.add([("D1", "a", 6, 6 * MIN, 4), ("D1", "a", 9, 1 * MIN, 5)])
    feed.add([("S", "s", 0, FAR, 6)])
    q = run(job())
    got = {
        ((r.tick_ms - T0) // MIN, r.device_id, r.property_name): r.value
        for r in spark.read.parquet(str(tmp_path / "out")).withColumn("tick_ms", F.unix_millis("window.end")).collect()
    }
    want = results(latest_snapshot(readings(spark, first)))
    # of the late rows, one has open windows left (minutes 20 and 21), the other has none
    want.update({(20, "D1", "a"): 6.0, (21, "D1", "a"): 6.0})
    assert got == want
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped > 0


def test_job_equals_batch_over_a_restart(spark, tmp_path):
    rows = [
        ("D0", "a", 1, 0), ("D1", "a", 10, 30_000), ("D0", "b", 2, 2 * MIN), ("D0", "a", 4, 5 * MIN),
        ("D0", "b", 3, 58 * MIN), ("D0", "a", 9, 59 * MIN), ("D0", "a", 6, 61 * MIN), ("D1", "a", 20, 62 * MIN),
    ]
    rows = [(*r, i) for i, r in enumerate(rows)]
    base = [
        rule("sum", "a+b", [("a", "D0", "a"), ("b", "D0", "b")]),
        rule("k", "2", expr_type=2),
        rule("scaled", "a*k", [("a", "D0", "a"), ("k", "D0", "k")]),
        rule("across", "x-y", [("x", "D0", "a"), ("y", "D1", "a")]),
        rule("hour", "HOUR_DIFF", [("a", "D0", "a")], 1),
        rule("mean", "DAILY_STATS", [("a", "D0", "a")], 1, [("type", "avg")]),
        rule("bit", "DEC_TO_BIN", [("a", "D0", "a")], 1, [("bit", "1")]),
        rule("chain", "s*10", [("s", "D0", "sum")]),
        rule("chainhour", "HOUR_DIFF", [("", "D0", "sum")], 1),
    ]
    table = rules(spark, *base)
    feed = Feed(spark, tmp_path / "in")

    def job():
        return derive_stream(feed.stream(), lambda s: table, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"))

    feed.add(rows[:5])
    run(job())
    feed.add(rows[5:])
    feed.add([("S", "s", 0, FAR, 99)])
    run(job())
    got = results(spark.read.parquet(str(tmp_path / "out")))
    want = results(derive(readings(spark, rows), table))
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_changed_rule_counts_from_the_next_batch(spark, tmp_path):
    tables = [rules(spark, rule("x", "a+1", [("a", "D0", "a")])), rules(spark, rule("x", "a+100", [("a", "D0", "a")]))]
    feed = Feed(spark, tmp_path / "in")
    feed.add([("D0", "a", 1, 0, 0), ("S", "s", 0, 30 * MIN, 1)])

    def job(table):
        return derive_stream(feed.stream(), lambda s: table, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"))

    run(job(tables[0]))
    feed.add([("D0", "a", 1, 40 * MIN, 2), ("S", "s", 0, FAR, 3)])
    run(job(tables[1]))
    got = results(spark.read.parquet(str(tmp_path / "out")), "x")
    assert {v for (t, _, _), v in got.items() if t < 20} == {2.0}
    assert {v for (t, _, _), v in got.items() if t > 40} == {101.0}


def test_from_messages_to_messages(spark, tmp_path):
    """Readings of one millisecond are ordered by offset; results come out as messages of all devices and function rules."""
    def message(device, name, value, ms):
        body = {"meter": device, "datas": [{"nm": name, "v": value, "ts": (T0 + ms) // 1000}]}
        return json.dumps({"topic": "/data/x/y/gw/396/161", "payload": json.dumps(body)})

    sent = [("D0", "a", 1, 0), ("D0", "a", 5, 0), ("D1", "b", 2, 30_000), ("D0", "a", 7, 20 * MIN), ("D1", "b", 4, 21 * MIN), ("D0", "a", 8, 40 * MIN), ("S", "s", 0, FAR)]
    rows = [(message(*m), 0, i) for i, m in enumerate(sent)]
    spark.createDataFrame(rows, "value STRING, partition INT, offset BIGINT").coalesce(1).write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema("value STRING, partition INT, offset BIGINT").parquet(str(tmp_path / "in"))
    table = rules(
        spark, rule("x", "a+b", [("a", "D0", "a"), ("b", "D1", "b")]), rule("h", "HOUR_DIFF", [("a", "D0", "a"), ("b", "D1", "b")], 1),
        rule("up", "b*2", [("b", "D1", "b")], device="P"),  # a device that sends nothing
    )
    out: list = []
    job = telemetry_stream(
        raw, lambda s: table, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"), lambda m, i: out.extend(r.value for r in m.collect())
    )
    run(job)
    got = {}
    for text in out:
        payload = json.loads(json.loads(text)["payload"])
        assert json.loads(text)["topic"] == "/data/derived/calc/tcp/396/161"  # also of P, by its operand's device
        for d in payload["datas"]:
            got[(int(payload["mid"].split("-")[1]), payload["meter"], d["nm"])] = d["v"]
    readings_of = to_readings(decode(spark.createDataFrame(rows, "value STRING, partition INT, offset BIGINT")))
    want = {(r.tick_ms, r.device_id, r.property_name): r.value for r in derive(readings_of, table).collect()}
    assert got == want and got[(T0 + MIN, "D0", "x")] == 7.0
    assert {v for (_, _, p), v in got.items() if p == "h"} == {0.0, 2.0, 3.0}
    assert {d for _, d, _ in got} == {"D0", "P"}
    stored = spark.read.parquet(str(tmp_path / "out")).select("project_id", "gateway_code", "data_type", "property_value", "value", "data_date", "snapshot_ms").collect()
    assert len(stored) == len(got)
    for r in stored:
        assert (r.project_id, r.gateway_code, r.data_type) == ("161", "gw", "calc") and float(r.property_value) == r.value and r.data_date == r.snapshot_ms


def test_ticks_of_stream_and_batch_share_the_function(spark):
    r = readings(spark, [("D0", "a", 1, 0)])
    assert snapshot_ticks(r).columns == ["tick_ms", "snapshot_ms", "company_id", "device_id", "property_name", "value"]


def test_snapshots_keep_readings_not_windows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pointloom.streaming.snapshots.GROUPS", 3)  # many series in a group
    monkeypatch.setattr("pointloom.streaming.snapshots.PART", 7)
    rng, rows = random.Random(5), []
    for i in range(400):  # in order but for 20 s, several a slot, some without value or not a number
        at = i * 9_000 + rng.randrange(20_000)
        rows.append((f"D{rng.randrange(4)}", rng.choice("ab"), rng.choice([None, float("nan"), 1.5, float(i)]), at, i))
    feed = Feed(spark, tmp_path / "in")
    feed.add(rows[:150])
    feed.add([*rows[150:300], ("S", "s", 0, 50 * MIN + 30_000, 1000)])  # then the watermark stands at the end of a window
    feed.add([r for r in rows[300:] if r[3] > 50 * MIN])
    out = stream_snapshots(feed.stream()).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
    q = run(out.option("checkpointLocation", str(tmp_path / "cp")))
    known = readings(spark, [*rows[:300], ("S", "s", 0, 50 * MIN + 30_000, 1000), *[r for r in rows[300:] if r[3] > 50 * MIN]])
    passed = int(max(known.agg(F.max("ts_ms")).first())) - 30_000
    want = latest_snapshot(known).where(f"tick_ms <= {passed}")
    columns = ["tick_ms", "company_id", "device_id", "property_name", "ts_ms", F.col("value").cast("string").alias("value")]
    got = spark.read.parquet(str(tmp_path / "out")).withColumn("tick_ms", F.unix_millis("window.end"))
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    kept = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert kept and max(kept) < 40  # some rows a group and its timer, none a window
