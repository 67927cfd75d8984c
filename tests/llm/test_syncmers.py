"""Closed syncmers, edited texts and neighbours in id order."""

import hashlib
import random

import numpy as np

from pointloom.llm import syncmers as Y
from pointloom.llm.textbytes import U64, mix


def all_syncmers(text):
    """Places of closed syncmers by the definition."""
    c = [int(mix(np.array([ord(x) + 1], dtype=U64))[0]) for x in text]
    m = lambda v: int(mix(np.array([v % 2**64], dtype=U64))[0])
    inner = [m(m(c[i] * 3 + c[i + 1]) * 5 + c[i + 2]) for i in range(len(c) - 2)]
    return [i for i in range(len(c) - Y.K + 1) if min(inner[i : i + Y.K - Y.S + 1]) in (inner[i], inner[i + Y.K - Y.S])]


def test_anchors_are_closed_syncmers_of_least_hash():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef ") for _ in range(150))
    h, at = Y.anchors(text)
    want = all_syncmers(text)
    assert set(at.tolist()) <= set(want) and len(h) == min(Y.KEPT, len(want))
    assert (np.diff(h) > 0).all()
    # an edit far away leaves an anchor where it was
    assert set(all_syncmers(text[:100])) == {i for i in want if i + Y.K <= 100}


def test_likeness():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9)))
    a, b = (" ".join(word() for _ in range(400)) for _ in range(2))
    p, q, e = Y.anchors(a), Y.anchors(b), Y.anchors(Y.edited(a, b))
    assert Y.likeness(p, p) == 1 and Y.likeness(p, q) < 0.1 and 0.5 < Y.likeness(p, e) < 0.95
    none, short = Y.anchors(""), Y.anchors("abc")
    assert Y.likeness(none, none) == 1 and Y.likeness(none, p) == 0 and Y.likeness(short, Y.anchors("abc")) == 1
    assert Y.written(none) == "" and Y.likeness(short, Y.anchors("abd")) == 0
    assert len(Y.anchors("a" * 5000)[0]) == 1


def test_a_short_passage_of_long_texts_is_seen():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9)))
    a, b, shared = (" ".join(word() for _ in range(n)) for n in (8000, 8000, 160))
    p, q = Y.anchors(a + shared + b), Y.anchors(b[:30000] + shared + a[:100])
    hashes = lambda t: {int(h) for h in Y.anchors(t)[0] if h <= Y.BOUND}
    assert len(p[0]) > 1000 and (p[0] <= Y.BOUND).all()
    # all anchors up to the bound are there, wherever the text stands
    assert len(hashes(shared)) > 5 and hashes(shared) <= set(p[0].tolist()) & set(q[0].tolist())
    x, y = Y.anchors(a), Y.anchors(shared)
    assert Y.likeness(Y.anchors(a[:20000] + shared + a[20000:]), Y.anchors(b[:20000] + shared + b[20000:])) > 0.005
    assert Y.likeness(x, Y.anchors(b)) < 0.005 and Y.likeness(y, y) == 1


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        e = Y.edited(t, following)
        p, q = Y.anchors(t), Y.anchors(e)
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), Y.written(p), Y.written(q), Y.likeness(p, q), Y.likeness(p, Y.anchors(following)))
    return out


def test_neighbours_across_buckets(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcdé\U0001f600 ") for _ in range(rng.randint(0, 120)))) for i in rng.sample(range(-10**12, 10**12), 200)]
    rows += [(None, "no id at all"), (5 * 10**12, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for size in (500, 1 << 20):
        got = {r[0]: tuple(r)[1:] for r in Y.fingerprint_rows(df, size).collect()}
        assert got == expected(rows)
    one = spark.createDataFrame([(3, "only one text here", 1.0)], "doc_id long, text string, near_next double")
    assert [(r.near_next, r.n_chars) for r in Y.fingerprint_rows(one).collect()] == [(1.0, 18)]
    twice = spark.createDataFrame([(3, "same"), (3, "same"), (4, "x")], "doc_id long, text string")
    assert Y.fingerprint_rows(twice).count() == 3
    assert Y.fingerprint_rows(one.limit(0)).count() == 0


def test_query(spark, sf_dir):
    from pointloom.llm.queries import ALL

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in ALL["op5_fingerprints"](spark, sf_dir).collect()}
    assert got == expected(rows)
