"""Cosine links within labels against all pairs."""

import numpy as np
import pytest

from pointloom.llm import embeddings as M


def brute(rows, t=0.93):
    n = len(rows)
    ok = [l is not None and x is not None and all(v is not None and np.isfinite(v) for v in x) and any(x) for _, x, l in rows]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [np.array(x, float) / np.linalg.norm(np.array(x, float)) if o else None for (_, x, _), o in zip(rows, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= t:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted(
        (str(rows[i][0]), links[i], least.get(find(i)), rows[i][0] == least.get(find(i))) for i in range(n)
    )


def made(rng, n, d, labels):
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        x = centres[rng.integers(12)] + rng.normal(size=d) * rng.choice([0.05, 0.2, 0.5])
        rows.append((i * 7 % 1009, x.tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize(("cell", "block"), [(10, 2048), (1000, 16), (8, 12)])
def test_equals_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(M, "CELL", cell)
    monkeypatch.setattr(M, "BLOCK", block)
    rng = np.random.default_rng(cell)
    rows = made(rng, 260, 6, 2)
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(30)]  # copies
    rows += [
        (3000, None, 1), (3001, [0.0] * 6, 1), (3002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (3003, [float("nan")] * 6, 1), (3004, rows[5][1], None),
        (3005, [float("inf")] + [0.0] * 5, 0), (3006, [1.0, 2.0], 0), (3007, [1.0, 2.1], 0), (None, rows[7][1], rows[7][2]), (rows[9]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in M.near_groups(df).collect())
    assert got == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, n_links string")
    assert M.op2_embeddings(df).count() == 0


def test_query(spark, sf_dir):
    from pointloom.llm.queries import ALL

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in ALL["op2_embeddings"](spark, sf_dir).collect())
    assert got == brute(rows)


def of_random_labels(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


def test_a_vector_is_written_once_whatever_cells_it_visits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "CELL", 20)
    monkeypatch.setattr(M, "BLOCK", 100)
    x = np.random.default_rng(4).normal(size=(1500, 64)).astype(np.float32)  # spread evenly: nearly all are near all borders
    monkeypatch.setattr("pointloom.llm.common.shared_folder", lambda spark: str(tmp_path))
    got = M.near_groups(of_random_labels(spark, [(i, v.tolist(), i % 2) for i, v in enumerate(x)])).collect()
    assert len(got) == 1500 and all(r.kept and r.n_links == 0 for r in got)
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 4 * x.nbytes


def test_labels_large_and_small_negative_zero_and_shared_hashes(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 10)
    monkeypatch.setattr(M, "BLOCK", 30)
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(x).tolist(), label if i % 3 else 5 + i % 40) for i, x, label in made(rng, 300, 5, 1)]
    rows += [(4000 + i, [0.0, -0.0 if i % 2 else 0.0, 1.0, 0.5, -0.0], i % 4) for i in range(8)]
    want = brute(rows)
    for _ in range(2):
        assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in M.near_groups(of_random_labels(spark, rows)).collect()) == want
        monkeypatch.setattr(M, "hashed", lambda x: M.F.lit(1).cast("long"))


def test_links_of_a_task_are_thinned_but_connect_the_same(monkeypatch):
    monkeypatch.setattr(M, "STEP", 50)
    monkeypatch.setattr(M, "EDGES", 40)
    rng = np.random.default_rng(2)
    x = np.array([r[1] for r in made(rng, 120, 6, 1)]) * 1e200
    packs = [M.Pack(np.arange(a, a + 40) * 3, np.full(40, 2), np.zeros(40, np.int32), x[a : a + 40]) for a in (0, 40, 80)]
    found, every = M.Links(), np.arange(40)
    for i, a in enumerate(packs):
        for b in packs[i:]:
            found.meet(a, b, every, every, 0.93)
            assert sum(e.shape[1] for e in found.edges) < 400
    got = found.rows().to_pylist()
    want = brute([(3 * i, v.tolist(), 0) for i, v in enumerate(x / 1e200)])
    assert {r["a"]: r["n"] for r in got if r["b"] is None} == {int(i): 2 * n for i, n, _, _ in want if n}
    least = {int(i): c for i, _, c, _ in want}
    edges = [(r["a"], r["b"]) for r in got if r["b"] is not None]
    assert all(least[a] == least[b] for a, b in edges) and len(edges) == 120 - len(set(least.values()))
