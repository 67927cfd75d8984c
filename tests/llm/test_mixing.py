"""Targets and thresholds against a plain version, and the query against its SQL."""

import random
import re
from collections import defaultdict

import pytest
from compare import connect, differences

from pointloom.llm import mixing as X


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight, cap, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, out, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (budget - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        out |= {s: most * sizes[s] for s in over}
        free -= over
    return out


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 50, 1000, 10**6]) + rng.randint(0, 99) * (seed % 2) for s in ["b", "a", "é", "z", "ß", "A", None][: 3 + seed % 5]}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in X.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in got)


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40]), rng.choice(["hot"] * 6 + ["b", "c", None]), "x") for i in range(900)]
    rows += [(5000, None, "only null", "x"), (None, "no id here", "b", "x"), (7007, "same row", "c", "x"), (7007, "same row", "c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string").repartition(5)
    out = X.mix(df).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, X.mix(df.repartition(2)).collect()))
    sizes, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[2] for r in rows}
    for r in out:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
        target[s] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - target[s]) <= max(1, largest[s])
    mixed = X.mixed_rows(df)
    assert mixed.columns == df.columns
    n = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in mixed.collect())
    assert n == sum(taken.values())
    assert X.mix(df.limit(0)).count() == 0 and X.mixed_rows(df.limit(0)).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    from pointloom.llm.queries import ALL, SQL

    a, b, only_spark, only_sql, notes = differences(ALL["op7_mixing"](spark, sf_dir), connect(sf_dir), SQL["op7_mixing"])
    assert a == b and not (only_spark or only_sql or notes)
