"""Connected components of random graphs, chains and stars; folders; rows kept by Arrow passes."""

import random

import pyarrow as pa
import pytest

from pointloom.llm.common import components, map_texts, shared_folder


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    groups = {}
    for x in list(root):
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("kind", ["random", "chain", "star"])
def test_components(spark, kind):
    rng = random.Random(kind)
    edges = {
        "random": [(rng.randint(-50, 400), rng.randint(-50, 400)) for _ in range(260)],
        "chain": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(100, 160)],
    }[kind]
    groups = {}
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [g for g in brute(edges) if len(g) > 1]
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = type("F", (), {"get": lambda *_: None})()
        sparkContext = type("C", (), {"master": "local-cluster[3,2,1024]"})  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_map_texts_keeps_columns_and_replaces_new_ones(spark):
    df = spark.createDataFrame([(1, "ab", "x"), (2, None, "y")], "_text int, text string, N string")
    out = map_texts(df, "text", lambda t: [pa.array([len(x or "") for x in t.to_pylist()], pa.int64())], "n long")
    assert out.columns == ["_text", "text", "n"] and sorted(map(tuple, out.collect()), key=str) == [(1, "ab", 2), (2, None, 0)]
