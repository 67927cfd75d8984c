"""What is computed and written once, or not at all."""

from helpers import MIN, readings, results, rule, rules
from pyspark.sql import functions as F

from pointloom.functions.arithmetic import PROGRAM, evaluate
from pointloom.plans import engine
from pointloom.plans import queries as catalogue
from pointloom.plans.registry import CALCULATIONS, FiredContext


def test_only_named_rules_are_written(spark, sf_dir, monkeypatch):
    written, write = [], catalogue.materialize
    monkeypatch.setattr(catalogue, "materialize", lambda df: written.append(write(df)) or written[-1])
    catalogue.rollup_spikes(spark, sf_dir)
    assert {r.point_code for r in written[0].select("point_code").distinct().collect()} == {"plantSum", "plantAvg"}


def test_a_filter_repeats_no_formula(spark):
    df = spark.createDataFrame([], f"tick_ms long, snapshot_ms long, company_id string, device_code string, point_code string, kind string, parameters array<struct<name:string,value:string>>, program {PROGRAM}, value double")
    out = engine.calculate(engine.without_period(df.withColumn("computed", evaluate(F.col("program"), F.array("value")))))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(program") == 1


def test_statistic_looks_its_type_up_once(spark):
    names = ["value", "first", "maximum", "minimum", "total", "count"]
    rows = [(k, 1.0, 2.0, 9.0, 3.0, 8.0, 4.0) for k in ("max", "MIN", "avg", "other", None)]
    df = spark.createDataFrame(rows, "k string, " + ", ".join(f"{n} double" for n in names))
    params = F.array(F.struct(F.lit("type").alias("name"), F.col("k").alias("value")))
    made = CALCULATIONS["DAILY_STATS"].value(FiredContext(*[F.col(n) for n in names], params))
    out = df.select("k", made.alias("x"))
    assert {r.k: r.x for r in out.collect()} == {"max": 9.0, "MIN": 3.0, "avg": 2.0, "other": None, None: 9.0}
    assert out._jdf.queryExecution().analyzed().toString().count("filter(") == 1


def test_the_last_level_is_not_written(spark, monkeypatch):
    made = rules(
        spark, rule("x", "a+1", [("a", "D0", "a")]), rule("y", "x*2", [("x", "D0", "x")]), rule("z", "y-1", [("y", "D0", "y")]),
    )
    rs = engine.prepare_rules(made)
    written, write = [], engine.materialize
    monkeypatch.setattr(engine, "materialize", lambda df: written.append(df.columns) or write(df))
    got = results(engine.derive(readings(spark, [("D0", "a", 4, 0), ("D0", "a", 6, MIN)]), rs))
    assert written.count(engine.TICK.fieldNames()) == 2  # of three levels
    assert {p: v for (m, _, p), v in got.items() if m == 2} == {"x": 7.0, "y": 14.0, "z": 13.0}
