"""Hand-written cases: one per quirk of the semantics."""

import math

import pytest
from helpers import MIN, T0, readings, results, rule, rules

from pointloom.operators import series, snapshot
from pointloom.plans.engine import derive


def by_tick(df, point, col="value"):
    return {(r.tick_ms - T0) // MIN: r[col] for r in df.collect() if r.property_name == point}


def test_tie_later_arrival_wins(spark):
    r = readings(spark, [("D0", "p", 1, 1000, 1), ("D0", "p", 2, 1000, 2)])
    assert set(by_tick(snapshot.latest_snapshot(r), "p").values()) == {2.0}


def test_reading_on_a_minute_boundary_enters_the_next_window_and_stays_15(spark):
    r = readings(spark, [("D0", "p", 1, 0)])
    assert sorted(by_tick(snapshot.latest_snapshot(r), "p")) == list(range(1, 16))


def test_unnamed_points_are_dropped(spark):
    assert snapshot.latest_snapshot(readings(spark, [("D0", None, 1, 0)])).count() == 0


def test_negative_times_and_any_sequence(spark):
    r = readings(spark, [("D0", "p", 1, -T0 - 30_000)])
    assert {t.tick_ms for t in snapshot.latest_snapshot(r).collect()} == {MIN * k for k in range(15)}
    far = readings(spark, [("D0", "p", 1, 1000, 1 << 50), ("D0", "p", 2, 1000, (1 << 50) - 1), ("D0", "p", 3, 1000, None), ("D0", "p", 4, 999, 1 << 60)])
    assert set(by_tick(snapshot.latest_snapshot(far), "p").values()) == {1.0}


def test_snapshot_time_is_the_newest_reading_of_the_device(spark):
    r = readings(spark, [("D0", "a", 1, 10_000), ("D0", "b", 1, 5 * MIN + 7_000), ("D1", "a", 1, 9 * MIN)])
    ticks = by_tick(snapshot.snapshot_ticks(r), "a", "snapshot_ms")
    d0 = {(t.tick_ms - T0) // MIN: t.snapshot_ms - T0 for t in snapshot.snapshot_ticks(r).collect() if t.device_id == "D0" and t.property_name == "a"}
    assert ticks and d0 == {k: 10_000 if k <= 5 else 5 * MIN + 7_000 for k in range(1, 16)}


def test_value_carried_over_midnight_starts_the_new_day(spark):
    day = 24 * 60 * MIN
    r = readings(spark, [("D0", "m", 10, day - 5 * MIN), ("D0", "m", 14, day - 2 * MIN), ("D0", "other", 1, day + 30_000), ("D0", "m", 15, day + 3 * MIN)])
    got = by_tick(series.period_diffs(snapshot.snapshot_ticks(r), ["day"]), "m", "day_diff")
    at = day // MIN
    assert got[at - 4] == 0.0 and got[at - 1] == 4.0 and got[at] == 4.0
    assert got[at + 1] == 0.0  # the other point moves the device into the new day; 14 is the baseline
    assert got[at + 4] == 1.0


def test_local_day_differs_from_utc_day(spark):
    r = readings(spark, [("D0", "m", 10, 15 * 3600_000 + 59 * MIN), ("D0", "m", 12, 16 * 3600_000 + 30_000)])
    utc = by_tick(series.period_diffs(snapshot.snapshot_ticks(r), ["day"]), "m", "day_diff")
    local = by_tick(series.period_diffs(snapshot.snapshot_ticks(r), ["day"], "Asia/Shanghai"), "m", "day_diff")
    assert utc[961] == 2.0 and local[961] == 0.0


def test_meter_reset_gives_a_negative_difference(spark):
    r = readings(spark, [("D0", "m", 100, 0), ("D0", "m", 5, MIN)])
    got = by_tick(series.period_diffs(snapshot.snapshot_ticks(r), ["total"]), "m", "total_diff")
    assert got[1] == 0.0 and got[2] == -95.0


def test_daily_average_counts_a_reading_once_per_firing(spark):
    r = readings(spark, [("D0", "m", 4, 0), ("D0", "m", 8, 3 * MIN)])
    out = series.daily_stats(snapshot.snapshot_ticks(r))
    assert by_tick(out, "m", "daily_avg")[4] == pytest.approx((4 * 3 + 8) / 4)
    per_reading = series.daily_reading_stats(r)
    assert by_tick(per_reading, "m", "daily_avg")[4] == pytest.approx(6)


def test_formula_cases(spark):
    r = readings(spark, [("D0", "b", 3, 0), ("D0", "a", 7, 40 * MIN), ("D0", "zero", 0, 40 * MIN)])
    rs = rules(
        spark,
        rule("old", "a+b", [("a", "D0", "a"), ("b", "D0", "b")]),
        rule("missing", "a+c", [("a", "D0", "a"), ("c", "D0", "c")]),
        rule("byzero", "a/z", [("a", "D0", "a"), ("z", "D0", "zero")]),
        rule("modzero", "a % z", [("a", "D0", "a"), ("z", "D0", "zero")]),
        rule("literals", "a*(1/2) + 7/2 + 2.5", [("a", "D0", "a")]),
        rule("sign", "-(a - 10) % 2", [("a", "D0", "a")]),
        rule("unbound", "a + q", [("a", "D0", "a")]),
        rule("code", "__import__('os')", [("a", "D0", "a")]),
        rule("power", "a**2", [("a", "D0", "a")]),
        rule("off", "a+1", [("a", "D0", "a")], enabled=0),
        rule("nodeps", "0"),
        rule("unknown", "NO_SUCH", [("a", "D0", "a")], expr_type=1),
    )
    got = results(derive(r, rs))
    assert {k[2] for k in got} == {"old", "literals", "sign"}
    # b alone fires `old` too, but a is not known yet; later b is 40 minutes old and still bound
    assert sorted(k[0] for k in got if k[2] == "old") == list(range(41, 56))
    assert got[(41, "D0", "old")] == 10.0
    assert got[(41, "D0", "literals")] == 5.5  # whole-number literals divide whole
    assert got[(41, "D0", "sign")] == 1.0


def test_constants(spark):
    r = readings(spark, [("D0", "p", 10, 0), ("D0", "price", 5, 2 * MIN)])
    rs = rules(
        spark,
        rule("price", '{"formula":"2.5"}', expr_type=2),
        rule("off", "9", expr_type=2, enabled=0),
        rule("lonely", "3", expr_type=2, device="D9"),
        rule("cost", "p*c", [("p", "D0", "p"), ("c", "D0", "price")]),
        rule("offcost", "p*c", [("p", "D0", "p"), ("c", "D0", "off")]),
        rule("alone", "c", [("c", "D9", "lonely")], device="D9"),
        rule("across", "p*c", [("p", "D0", "p"), ("c", "D9", "lonely")]),
    )
    got = results(derive(r, rs))
    assert {k[2] for k in got} == {"cost", "across"}
    assert [got[(t, "D0", "cost")] for t in (1, 2, 3)] == [25.0, 25.0, 50.0]
    assert got[(1, "D0", "across")] == 30.0


def test_function_rules(spark):
    r = readings(spark, [("D0", "s", 5, 0), ("D0", "s", -5, MIN), ("D0", "s", 1e300, 2 * MIN)])
    src = [("a", "D0", "s")]
    rs = rules(
        spark,
        *[rule(f"bit{b}", "DEC_TO_BIN", src, 1, [("bit", b)]) for b in ("1", "2", "3", "0", "x")],
        rule("nobit", "DEC_TO_BIN", src, 1),
        rule("stat", "DAILY_STATS", src, 1),
        rule("low", "DAILY_STATS", src, 1, [("type", "MIN")]),
        rule("odd", "DAILY_STATS", src, 1, [("type", "median")]),
        rule("d", "HOUR_DIFF", src, 1),
    )
    got = results(derive(r, rs))
    assert [got[(1, "D0", f"bit{b}")] for b in (1, 2, 3)] == [1.0, 0.0, 1.0]
    assert got[(2, "D0", "bit2")] == 1.0 and (3, "D0", "bit1") not in got
    assert not {"bit0", "bitx", "nobit", "odd"} & {k[2] for k in got}
    assert got[(2, "D0", "stat")] == 5.0 and got[(2, "D0", "low")] == -5.0 and got[(2, "D0", "d")] == -10.0


def test_cross_device_rule_waits_for_both_and_takes_the_newest_time(spark):
    r = readings(spark, [("D0", "a", 1, 0), ("D1", "b", 5, 3 * MIN + 5), ("D1", "other", 0, 4 * MIN + 9)])
    out = derive(r, rules(spark, rule("x", "a+b", [("a", "D0", "a"), ("b", "D1", "b")])))
    got = results(out)
    assert sorted(k[0] for k in got) == list(range(4, 19)) and set(got.values()) == {6.0}
    at5 = [x for x in out.collect() if x.tick_ms == T0 + 5 * MIN]
    assert [x.snapshot_ms - T0 for x in at5] == [4 * MIN + 9]


def test_rollups(spark):
    from pointloom.schemas import MODEL, OBJECT

    objects = spark.createDataFrame(
        [(1, None, 396, "P", None, 1), (2, None, 396, "EMPTY", None, 1), (10, 1, 396, "D0", 7, 1), (11, 1, 396, "D1", 7, 1), (12, 1, 396, "D2", 8, 1)], OBJECT
    )
    models = spark.createDataFrame([(7, 396, "METER"), (9, 396, "METER"), (8, 396, "VALVE")], MODEL)
    r = readings(spark, [("D0", "p", 1, 0), ("D1", "p", 3, 2 * MIN), ("D2", "p", 100, 0)])
    params = [("model", "METER"), ("point", "p")]
    rs = rules(
        spark, rule("sum", "CHILD_SUM", (), 1, params, device="P"), rule("avg", "CHILD_AVG", (), 1, params, device="P"),
        rule("none", "CHILD_SUM", (), 1, params, device="EMPTY"),
        rule("twice", "s*2", [("s", "P", "sum")], device="P"),
    )
    got = results(derive(r, rs, objects, models))
    assert {k[2] for k in got} == {"sum", "avg", "twice"}
    assert sorted(k[0] for k in got if k[2] == "sum") == list(range(3, 18))
    assert got[(3, "P", "sum")] == 4.0 and got[(3, "P", "avg")] == 2.0 and got[(3, "P", "twice")] == 8.0


def test_rollups_after_large_values(spark):
    from pointloom.schemas import MODEL, OBJECT

    objects = spark.createDataFrame([(1, None, 396, "P", None, 1), *[(10 + i, 1, 396, f"D{i}", 7, 1) for i in range(3)]], OBJECT)
    models = spark.createDataFrame([(7, 396, "METER")], MODEL)
    values = [
        (0.1, 1e17, -0.3), (0.1, 1.0, -0.3), (0.2, 1.0, -0.3), (1e22, -1e22, 1e-9), (-7.25, 3.0, 1e-9), (1e-9, -1e-9, 0.1),
        (float("nan"), 1e20, 2.0), (-1e20, 1e20, 2.0), (float("inf"), 1e20, 2.0), (0.1, 0.2, 0.3), (-0.1, -0.2, -0.3), (2.0**53, 1.0, 1.0),
    ]
    r = readings(spark, [(f"D{i}", "p", v, k * 20 * MIN) for k, row in enumerate(values) for i, v in enumerate(row)])
    params = [("model", "METER"), ("point", "p")]
    got = results(derive(r, rules(spark, rule("sum", "CHILD_SUM", (), 1, params, device="P")), objects, models))
    for k, row in enumerate(values):
        want = math.fsum(row) if all(map(math.isfinite, row)) else sum(row)
        assert got[(20 * k + 1, "P", "sum")] == pytest.approx(want, rel=2.3e-16, abs=0, nan_ok=True)


def test_exact_sums_in_any_order(spark):
    import random

    from pyspark.sql import functions as F

    from pointloom.operators import exact

    rng = random.Random(3)
    rows = [(g, rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-30, 30)) for g in range(40) for _ in range(rng.randint(1, 30))]
    rows += [(g, -v) for g, v in rows if g % 4 == 0 for _ in range(1)] + [(40, 5e-324), (40, 1.5e308), (41, None), (41, -0.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    of = exact.limb_range(df, "v")
    names = [f"l{i}" for i in range(len(of))]
    sums = df.groupBy("g").agg(*[F.sum(x).alias(n) for n, x in zip(names, exact.limbs(F.col("v"), of), strict=True)])
    for r in exact.with_total(sums, names, of, "total").collect():
        assert r.total == pytest.approx(math.fsum(v for g, v in rows if g == r.g and v is not None), rel=2.3e-16, abs=0)
    none = df.where("v is null")
    assert exact.limb_range(none, "v") == range(0) and [r.total for r in exact.with_total(none, [], range(0), "total").collect()] == [0.0]


def test_chains_and_cycles(spark):
    r = readings(spark, [("D0", "a", 2, 0)])
    rs = rules(
        spark,
        rule("one", "a+1", [("a", "D0", "a")]),
        rule("two", "x*a", [("x", "D0", "one"), ("a", "D0", "a")]),
        rule("three", "x+y", [("x", "D0", "two"), ("y", "D0", "one")]),
        rule("diff", "DAY_DIFF", [("", "D0", "three")], 1),
        rule("c1", "x+a", [("x", "D0", "c2"), ("a", "D0", "a")]),
        rule("c2", "x+a", [("x", "D0", "c1"), ("a", "D0", "a")]),
        rule("selfish", "x+a", [("x", "D0", "selfish"), ("a", "D0", "a")]),
    )
    got = results(derive(r, rs))
    assert {k[2] for k in got} == {"one", "two", "three", "diff"}
    assert got[(1, "D0", "two")] == 6.0 and got[(15, "D0", "three")] == 9.0 and got[(15, "D0", "diff")] == 0.0


def test_formulas_with_very_many_operands(spark):
    n = 90
    r = readings(spark, [("D0", f"p{i}", i, i * 100) for i in range(n)])
    deps = [(f"v{i}", "D0", f"p{i}") for i in range(n)]
    rs = rules(spark, rule("long", " + ".join(f"v{i}" for i in range(n)), deps), rule("short", "a*2", [("a", "D0", "p3")]))
    got = results(derive(r, rs))
    assert got[(1, "D0", "long")] == sum(range(n)) and got[(15, "D0", "short")] == 6.0


def test_results_do_not_depend_on_arrival_order(spark):
    import random

    rnd = random.Random(5)
    rows = [(f"D{rnd.randrange(3)}", rnd.choice("ab"), rnd.random(), rnd.randrange(90 * MIN), i) for i in range(300)]
    a = snapshot.snapshot_ticks(readings(spark, rows))
    rnd.shuffle(rows)
    b = snapshot.snapshot_ticks(readings(spark, rows).repartition(7))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
