"""A calculation and a formula function of one's own, from the formula text to results, in batch and live."""

import json

import pytest
from helpers import MIN, readings, results
from pyspark.sql import functions as F
from test_streaming import FAR, Feed, run

from pointloom.plans import compile as compiler
from pointloom.plans import registry
from pointloom.plans.engine import derive, rejected_rule_rows
from pointloom.plans.registry import Calculation, Compiled, register_calculation, register_function
from pointloom.schemas import MODEL, OBJECT, POINT_CONF
from pointloom.streaming.job import derive_stream

ROWS = [
    ("D0", "a", 5, 0), ("D0", "a", 2, 3 * MIN), ("D0", "a", 9, 40 * MIN), ("D0", "a", 4, 70 * MIN), ("D0", "b", 1, 71 * MIN),
]


@pytest.fixture
def own_kinds():
    before = dict(registry.CALCULATIONS), dict(registry.FORMULA_FUNCTIONS)
    register_calculation("HOUR_RANGE", Calculation(lambda c: (c.maximum - c.minimum) * c.param("times").cast("double"), "hour"))
    register_function(
        "spread",
        lambda c: Compiled(
            F.lit("HOUR_RANGE"), F.lit(1), compiler._own_point(c), F.array(compiler._param("times", c.arg(1))), compiler._needs(c, 2)
        ),
    )
    yield
    for live, old in zip((registry.CALCULATIONS, registry.FORMULA_FUNCTIONS), before, strict=True):
        live.clear()
        live.update(old)


def compiled(spark):
    objects = spark.createDataFrame([(1, None, 396, "D0", 5, 1)], OBJECT)
    models = spark.createDataFrame([(5, 396, "M")], MODEL)
    points = spark.createDataFrame(
        [
            (1, 396, 1, "range", "0", 2, "spread('a','2')"), (2, 396, 1, "short", "0", 2, "spread('a')"),
            (3, 396, 1, "double", "0", 2, json.dumps({"formula": "r+r2", "vars": [
                {"name": "r", "data_code": "range", "object_code": "D0"}, {"name": "r2", "data_code": "range", "object_code": "D0"},
            ]})),
        ],
        POINT_CONF,
    )
    return compiler.compile_rules(points, objects), compiler.rejected_rules(points, objects, models)


def ranges():
    """By hand: twice the hour's range of what was in the snapshot at each window end so far, by hour of the snapshot."""
    out, seen = {}, {}
    for tick in range(1, 90):
        held = [(ms // MIN, v) for d, p, v, ms in ROWS if p == "a" and ms // MIN < tick]
        if held and tick - held[-1][0] <= 15:
            newest = max(ms for d, p, _, ms in ROWS if ms // MIN < tick)
            values = seen.setdefault(newest // (60 * MIN), [])
            values.append(held[-1][1])
            out[tick] = 2.0 * (max(values) - min(values))
    return out


def test_batch(spark, own_kinds):
    table, bad = compiled(spark)
    assert [(r.point_code, r.reason) for r in bad.collect()] == [("short", "too few arguments")]
    assert rejected_rule_rows(table).isEmpty()
    got = results(derive(readings(spark, ROWS), table))
    assert {t: v for (t, _, p), v in got.items() if p == "range"} == ranges()
    assert {t: v for (t, _, p), v in got.items() if p == "double"} == {t: 2 * v for t, v in ranges().items()}


def test_live(spark, own_kinds, tmp_path):
    table, _ = compiled(spark)
    table = table.where("point_code = 'range'")
    feed = Feed(spark, tmp_path / "in")
    feed.add([(*r, i) for i, r in enumerate(ROWS)])
    feed.add([("S", "s", 0, FAR, 99)])
    run(derive_stream(feed.stream(), lambda s: table, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp")))
    got = results(spark.read.parquet(str(tmp_path / "out")), "range")
    assert {t: v for (t, _, _), v in got.items()} == ranges()


def test_unregistered_names_are_rejected(spark):
    _, bad = compiled(spark)
    assert {(r.point_code, r.reason) for r in bad.collect()} >= {("range", "unknown function"), ("short", "unknown function")}
