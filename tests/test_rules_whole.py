"""Rules of any number, depth and length; each bad rule is set aside with a reason and disturbs no other."""

import pytest
from pyspark.sql import functions as F

from helpers import MIN, T0, readings, results, rule, rules
from pointloom.operators.binding import operand_events
from pointloom.operators.snapshot import device_firings, slot_latest
from pointloom.plans import lineage
from pointloom.plans.engine import derive, prepare_rules, rejected_rule_rows
from pointloom.schemas import MODEL, OBJECT


def test_chains_of_any_depth_and_cycles(spark):
    r = readings(spark, [("D0", "p", 1, 0)])
    chain = [rule("l1", "a+1", [("a", "D0", "p")])] + [rule(f"l{i}", "a+1", [("a", "D0", f"l{i - 1}")]) for i in range(2, 13)]
    cycle = [rule("x", "a+1", [("a", "D0", "y")]), rule("y", "a+1", [("a", "D0", "x")]), rule("z", "a", [("a", "D0", "x")])]
    table = rules(spark, *chain, *cycle)
    got = results(derive(r, table))
    assert {p: v for (m, _, p), v in got.items() if m == 1} == {f"l{i}": float(i + 1) for i in range(1, 13)}
    assert sorted((x.point_code, x.reason) for x in rejected_rule_rows(table).collect()) == [("x", "cycle"), ("y", "cycle"), ("z", "cycle")]


def test_long_formulas_beside_short_ones(spark):
    n = 1100
    names = [f"p{i}" for i in range(n)]
    r = readings(spark, [("D0", p, 1, i % 50) for i, p in enumerate(names)])
    dep = lambda k: [(f"v{i}", "D0", names[i]) for i in range(k)]
    table = rules(
        spark, rule("all", "+".join(f"v{i}" for i in range(n)), dep(n)), rule("two", "v0+v1", dep(2)),
        rule("s66", "v0+v1", dep(66)), rule("s70", "v0+v1", dep(70)),
    )
    got = results(derive(r, table))
    assert {p: v for (m, _, p), v in got.items() if m == 1} == {"all": 1100.0, "two": 2.0, "s66": 2.0, "s70": 2.0}


def test_bad_rules_have_a_reason_and_others_run(spark):
    r = readings(spark, [("D0", "a", 4, 0), ("D0", "b", 2, 1)])
    ab = [("a", "D0", "a"), ("b", "D0", "b")]
    table = rules(
        spark, rule("ok", "a/b", ab), rule("big", "a+1" + "0" * 401, ab), rule("bad", "a ** b", ab), rule("name", "a + q", ab), rule("none", "1+2"),
        rule("what", "NO_SUCH", ab[:1], 1), rule("price", "abc", (), 2), rule("kids", "CHILD_SUM", (), 1, [("model", "M"), ("point", "a")]), rule("off", "a ** b", ab, enabled=0),
    )
    assert {k[2] for k in results(derive(r, table))} == {"ok"}
    assert {x.point_code: x.reason for x in rejected_rule_rows(table).collect()} == {
        "big": "number out of range", "bad": "outside grammar", "name": "unbound name", "none": "no operand", "what": "unknown calculation",
        "price": "unreadable constant", "kids": "no child",
    }


def test_no_rules_and_only_idle_rules(spark):
    r = readings(spark, [("D0", "a", 4, 0)])
    empty = rules(spark, rule("x", "a", [("a", "D0", "a")])).limit(0)
    assert derive(r, empty).count() == 0
    assert derive(r, rules(spark, rule("one", "1+1"))).count() == 0


def test_the_newest_row_of_a_key_counts(spark):
    r = readings(spark, [("D0", "a", 1, 0), ("D0", "b", 100, 0)])
    twice = rules(spark, rule("x", "a+2", [("a", "D0", "a")]), rule("x", "b+2", [("b", "D0", "b")]))
    twice = twice.withColumn("seq", F.when(F.col("expr") == "a+2", 2).otherwise(1))
    assert set(results(derive(r, twice)).values()) == {3.0}
    assert [(x.point_code, x.reason) for x in rejected_rule_rows(twice).collect()] == [("x", "duplicate key")]


def test_replaced_children_count_once(spark):
    objects = spark.createDataFrame(
        [(1, None, 396, "P", None, 1), (10, 1, 396, "C0", 5, 1), (11, 1, 396, "C1", 5, 1), (12, 1, 396, "C1", 5, 1), (2, None, 396, "P", None, 1)], OBJECT
    )
    models = spark.createDataFrame([(5, 396, "M")], MODEL)
    r = readings(spark, [("C0", "p", 1, 0), ("C1", "p", 3, 10), ("C1", "p", float("nan"), 5 * MIN), ("C1", "p", 5, 6 * MIN)])
    table = rules(spark, rule("sum", "CHILD_SUM", (), 1, [("model", "M"), ("point", "p")], "P"))
    got = {m: v for (m, _, _), v in results(derive(r, table, objects, models)).items()}
    assert got[1] == 4.0 and got[6] != got[6] and got[7] == 6.0


def test_rows_follow_readings_not_minutes(spark):
    week = 7 * 24 * 60 * MIN
    r = readings(spark, [("D0", "a", 1, 0), ("D1", "b", 2, week), ("D0", "a", 3, 2 * week)])
    table = rules(spark, rule("x", "a+b", [("a", "D0", "a"), ("b", "D1", "b")]))
    rs = prepare_rules(table)
    deps = rs.deps.join(rs.rules.select("company_id", "device_code", "point_code", "rule_id"), ["company_id", "device_code", "point_code"]).drop("var", "device_code", "point_code")
    events = operand_events(slot_latest(r), device_firings(r), deps, None, rs.constants, MIN, 15)
    assert events.count() == 45
    got = results(derive(r, table))
    assert len(got) == 30 and set(got.values()) == {3.0, 5.0}


def test_arrival_numbers_of_any_size(spark):
    rows = [("D0", "a", 1, 0, -5), ("D0", "a", 2, 0, -7), ("D0", "b", 1, 0, 2**60), ("D0", "b", 2, 0, 2**47)]
    from pointloom.schemas import READING

    data = [(r[4], "396", r[0], "161", "gw", r[1], float(r[2]), T0) for r in rows]
    got = {x.property_name: x.value for x in slot_latest(spark.createDataFrame(data, READING)).collect()}
    assert got == {"a": 1.0, "b": 1.0}


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.checkpoint_folder(Session())
