"""Rule sets after changes against preparing all rules anew; rules pinned by batch."""

import random

import pytest
from helpers import MIN, readings, results, rule, rules
from pyspark.sql import functions as F

from pointloom.plans import engine
from pointloom.plans.engine import prepare_rules, reached_rules, refresh_rules
from pointloom.schemas import MODEL, OBJECT, RULE, RULE_KEY
from pointloom.streaming.job import batch_function
from pointloom.streaming.ruleset import LiveRules
from pointloom.streaming.snapshots import stream_snapshots, stream_ticks
from pointloom.streaming.state import stream_device_state

HEAD = [*RULE_KEY, "kind", "parameters", "program", "n_required", "many_devices", "n_deps", "level", "route"]


def content(rs):
    def rows(df, *columns):
        return sorted(map(repr, df.select(*columns).collect()))

    return {
        "rules": rows(rs.rules, *HEAD), "deps": rows(rs.deps, *RULE_KEY, "idx", "var", "dep_device_code", "dep_point_code"),
        "constants": rows(rs.constants, "company_id", "device_id", "property_name", "const"),
        "rejected": rows(rs.rejected, *RULE_KEY, "reason"), "arity": rs.arity, "groups": rs.groups, "depth": rs.max_level,
    }


def numbers(rs):
    got = {(r.device_code, r.point_code): r.rule_id for r in rs.rules.select(*RULE_KEY, "rule_id").collect()}
    assert len(set(got.values())) == len(got)
    return got


def objects(spark, *codes):
    """Children of P (object 1), all of model M (5)."""
    rows = [(1, None, 396, "P", None, 1), *[(10 + i, 1, 396, c, 5, 1) for i, c in enumerate(codes)]]
    return spark.createDataFrame(rows, OBJECT)


def random_rule(rng, point):
    if rng.random() < 0.1:
        return rule(point, str(rng.randint(1, 9)), expr_type=2)
    if rng.random() < 0.1:
        return rule(point, "CHILD_SUM", (), 1, [("model", "M"), ("point", rng.choice(["m", "p3"]))], device="P")
    names = [rng.choice(["m", "n", *[f"p{i}" for i in range(10)]]) for _ in range(rng.randint(1, 3))]
    deps = [(f"v{i}", rng.choice(["D0", "D0", "D1", "P"]), n) for i, n in enumerate(names)]
    text = "+".join(v for v, _, _ in deps) + rng.choice(["", "", "*2", "+nowhere"])
    if rng.random() < 0.2:
        return rule(point, rng.choice(["HOUR_DIFF", "NO_SUCH"]), deps[:1], 1)
    return rule(point, text, deps, device=rng.choice(["D0", "D0", "D1"]), enabled=rng.choice([1, 1, 1, 1, 0]))


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_preparing_anew(spark, monkeypatch, seed):
    monkeypatch.setattr(engine, "MOST_LAYERS", 2)
    rng = random.Random(seed)
    tree, models = objects(spark, "D0", "D1"), spark.createDataFrame([(5, 396, "M")], MODEL)
    table = {(r := random_rule(rng, f"p{i}"))[:3]: r for i in range(10) for _ in range(2)}
    rs = prepare_rules(rules(spark, *table.values()), tree, models)
    for _ in range(2):
        after = dict(table)
        for key in rng.sample(sorted(after), 2):
            if rng.random() < 0.3:
                del after[key]
            else:
                after[key] = (*key, *random_rule(rng, key[2])[3:])
        new = random_rule(rng, f"p{rng.randint(0, 12)}")
        after[new[:3]] = new
        changed = [k for k in {*table, *after} if table.get(k) != after.get(k)]
        current = rules(spark, *after.values())
        rs = refresh_rules(rs, current, spark.createDataFrame(changed, "company_id STRING, device_code STRING, point_code STRING"), tree, models)
        assert content(rs) == content(prepare_rules(current, tree, models))
        numbers(rs)
        table = after


def test_only_what_a_change_reaches_is_touched(spark):
    base = [rule("a", "x+1", [("x", "D0", "m")]), rule("b", "x*2", [("x", "D0", "a")]), rule("c", "x*2", [("x", "D0", "b")], device="D1")]
    other = [rule(f"o{i}", "x*2", [("x", "D0", "m" if i == 0 else f"o{i - 1}")]) for i in range(4)]
    rs = prepare_rules(rules(spark, *base, *other))
    changed = spark.createDataFrame([("396", "D0", "a")], "company_id STRING, device_code STRING, point_code STRING")
    assert {r.point_code for r in reached_rules(rs.deps, changed).collect()} == {"a", "b", "c"}
    # a now stands on o3: its followers rise with it; then a cycle that the next change ends
    moved = refresh_rules(rs, rules(spark, rule("a", "x+1", [("x", "D0", "o3")]), *base[1:], *other), changed)
    assert {r.point_code: r.level for r in moved.rules.collect()} == {"o0": 0, "o1": 1, "o2": 2, "o3": 3, "a": 4, "b": 5, "c": 6}
    before, after = numbers(rs), numbers(moved)
    assert {k for k in before if before[k] != after[k]} <= {("D0", "a"), ("D0", "b"), ("D1", "c")}
    assert all(before[k] == after[k] for k in before if k[1].startswith("o"))
    round_ = refresh_rules(moved, rules(spark, rule("a", "x+1", [("x", "D1", "c")]), *base[1:], *other), changed)
    assert {(r.point_code, r.reason) for r in round_.rejected.collect()} == {(p, "cycle") for p in "abc"}
    behind = refresh_rules(round_, rules(spark, rule("a", "x+1", [("x", "D1", "c")]), *base[1:], *other[:3], rule("o3", "x*2", [("x", "D0", "b")])), changed.replace("a", "o3"))
    assert {(r.point_code, r.reason) for r in behind.rejected.collect()} == {(p, "cycle") for p in ("a", "b", "c", "o3")}
    ended = refresh_rules(round_, rules(spark, *base, *other), changed)
    assert content(ended) == content(rs)


def test_rules_are_pinned_by_batch(spark, tmp_path):
    held = {"rules": rules(spark, rule("a", "x+1", [("x", "D0", "m")]), rule("k", "7", expr_type=2), rule("s", "CHILD_SUM", (), 1, [("model", "M"), ("point", "m")], device="P")), "objects": objects(spark, "D0")}
    models = spark.createDataFrame([(5, 396, "M")], MODEL)

    def live():
        return LiveRules(spark, str(tmp_path / "c"), lambda s: held["rules"], lambda s: held["objects"], lambda s: models, every=2)

    one, want = live(), None
    for batch in range(4):
        if batch == 1:
            held["rules"] = held["rules"].where("point_code <> 'k'").unionByName(rules(spark, rule("b", "x*3", [("x", "D0", "a")])))
        if batch == 2:
            held["objects"] = objects(spark, "D0", "D1")
        before = one._set
        made = one.at(batch)
        assert (made is before) == (batch == 3)  # nothing changed, nothing was done
        if batch == 2:
            want = content(made)
            assert want == content(prepare_rules(held["rules"], held["objects"], models))
    held["rules"] = held["rules"].where("point_code = 's'")
    assert one.at(3) is made and content(live().at(3)) == want  # the last batch again, in the same job and in a new one
    assert [r.point_code for r in one.at(4).rules.collect()] == ["s"]


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    held = [rules(spark, rule("x", "a+1", [("a", "D0", "a")]))]
    readings(spark, [("D0", "a", 1, 0, 0), ("D0", "a", 3, 2 * MIN, 1), ("S", "s", 0, 40 * MIN, 2)]).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(readings(spark, []).schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    run = batch_function(spark, lambda s: held[0], out, str(tmp_path / "state"))
    got = []

    def twice(batch, batch_id):
        batch.persist()
        for _ in range(2):
            run(batch, batch_id)
            got.append(results(spark.read.parquet(f"{out}/batch_id={batch_id}")))
            held[0] = rules(spark, rule("x", "a+100", [("a", "D0", "a")]))
        batch.unpersist()

    ticks = stream_device_state(stream_ticks(stream_snapshots(stream)))
    ticks.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(got) >= 2 and any(got) and all(a == b for a, b in zip(got[::2], got[1::2], strict=True))


def test_pinned_rows_have_the_schema_of_rules(spark, tmp_path):
    """A loader may give further columns and rows with null keys."""
    table = rules(spark, rule("a", "x+1", [("x", "D0", "m")])).withColumn("seq", F.lit(3)).withColumn("_now", F.lit("mine"))
    table = table.unionByName(table.withColumn("point_code", F.lit(None).cast("string")))
    older = table.withColumns({"seq": F.lit(1), "expr": F.lit("x+9")})
    live = LiveRules(spark, str(tmp_path / "c"), lambda s: table.unionByName(older))
    assert live.at(0).rules.count() == 1 and live.at(1) is live.at(1)
    rows = live.rules.rows(1).collect()
    assert [r.expr for r in rows] == ["x+1"] and rows[0].__fields__ == RULE.fieldNames()
