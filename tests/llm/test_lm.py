"""Counts, weights and scores against a plain version in Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointloom.llm import lm as L


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]


def grams(text):
    t = ["<s>", "<s>", *tokens(text)]
    return [(t[i - 2], t[i - 1], t[i]) for i in range(2, len(t))]


class Plain:
    """Counts of some texts."""

    def __init__(self, texts):
        self.n = [Counter(), Counter(), Counter()]
        for x in texts:
            for u, v, w in grams(x):
                self.n[0][w] += 1
                self.n[1][v, w] += 1
                self.n[2][u, v, w] += 1
        self.texts, self.total, self.seen = len(texts), sum(self.n[0].values()), len(self.n[0])

    def estimates(self, u, v, w):
        one = self.texts if v == "<s>" else self.n[0][v]
        two = self.texts if v == "<s>" else self.n[1][u, v]
        below = (self.total, one, two)
        cls = [min(L.CLASSES - 1, n.bit_length()) for n in (one, two)]
        return [c / max(1, b) for c, b in zip((self.n[0][w], self.n[1][v, w], self.n[2][u, v, w]), below, strict=True)], cls


def learned(events, seen):
    w1, w2, w3, before = 0.5, [0.5] * L.CLASSES, [0.5] * L.CLASSES, None
    for _ in range(L.ROUNDS):
        s1, s2, s3, fit = [0, 0], [[0, 0, 0] for _ in w2], [[0, 0] for _ in w3], 0
        for (m1, m2, m3), (c1, c2) in events:
            p1 = w1 * m1 + (1 - w1) / (seen + 1)
            p2 = w2[c1] * m2 + (1 - w2[c1]) * p1
            p3 = w3[c2] * m3 + (1 - w3[c2]) * p2
            a3 = w3[c2] * m3 / p3
            a2 = (1 - a3) * w2[c1] * m2 / p2
            a1 = (1 - a3 - a2) * w1 * m1 / p1
            s3[c2][0] += a3
            s3[c2][1] += 1
            s2[c1][0] += a2
            s2[c1][1] += 1 - a3
            s2[c1][2] += 1
            s1[0] += a1
            s1[1] += 1 - a3 - a2
            fit += math.log(p3)
        if not events:
            return w1, w2, w3
        w1 = (s1[0] + 0.5) / (s1[1] + 1)
        w2 = [(a + 0.5) / (b + 1) for a, b, _ in s2]
        w3 = [(a + 0.5) / (b + 1) for a, b in s3]
        for c in range(2, L.CLASSES):
            w2[c] = w2[c] if s2[c][2] else w2[c - 1]
            w3[c] = w3[c] if s3[c][1] else w3[c - 1]
        fit /= len(events)
        if before is not None and abs(fit - before) < L.ENOUGH:
            break
        before = fit
    w2[0] = w3[0] = 0
    return round(w1, 6), [round(w, 6) for w in w2], [round(w, 6) for w in w3]


def plain(rows):
    crc = lambda s: zlib.crc32(s.encode())
    key = lambda i: "" if i is None else str(i)
    held = [crc(key(i)) % 7 == 2 for i, _ in rows]
    deleted = [not h and crc("deleted:" + key(i)) % 10 == 0 for (i, _), h in zip(rows, held, strict=True)]
    kept = Plain([t for (_, t), h, d in zip(rows, held, deleted, strict=True) if not h and not d])
    whole = Plain([t for (_, t), h in zip(rows, held, strict=True) if not h])
    events = [kept.estimates(*g) for (_, t), d in zip(rows, deleted, strict=True) if d for g in grams(t)]
    w1, w2, w3 = learned(events, kept.seen)
    out = []
    for (i, t), h in zip(rows, held, strict=True):
        base = score = 0.0
        known = 0
        for u, v, w in grams(t):
            (m1, m2, m3), (c1, c2) = whole.estimates(u, v, w)
            one = w1 if whole.total else 0
            p = one * m1 + (1 - one) / (whole.seen + 1)
            p = w2[c1] * m2 + (1 - w2[c1]) * p
            score += math.log10(w3[c2] * m3 + (1 - w3[c2]) * p)
            base += math.log10((whole.n[0][w] + 1) / (whole.total + whole.seen + 1))
            known += whole.n[0][w] > 0
        out.append((i, h, len(grams(t)), known, whole.total, base, score))
    return out


def same(got, want):
    order = lambda r: (str(r[0]), r[2], round(r[5], 6), round(r[6], 6))
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6, atol=1e-6)


def test_plain(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 3000)
    monkeypatch.setattr(L, "ENTRIES", 300)
    rng = random.Random(2)
    vocabulary = ["the", "The", "of", "ÉTÉ", "été", "x", "a-b", "日本", "new york"] + [f"w{i}" for i in range(60)]
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.choice([0, 1, 2, 9, 60])))) for i in range(260)]
    rows += [(i, "one text that many rows repeat word for word") for i in range(1000, 1100)]
    rows += [(None, "no id"), (None, None), (2000, None), (2001, ""), (2002, " \n "), (2003, "long text " * 20_000), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(*r, 7.0, "mine") for r in rows], "doc_id long, text string, score double, kind string").repartition(5)
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    got = L.lm_scores(df, held)
    assert got.columns == ["doc_id", "kind", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert {r.kind for r in got.select("kind").collect()} == {"mine"}
    same(got.drop("kind").collect(), plain(rows))
    same(L.op11_lm_scores(df).collect(), plain(rows))


@pytest.mark.parametrize("rows", [[(2, "a b a")], [(None, None)], [(1, ""), (2, "x"), (3, "x y")]])
def test_tiny(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(L.op11_lm_scores(df).collect(), plain(rows))
    assert L.op11_lm_scores(df.limit(0)).count() == 0


def test_query_on_the_sample(spark, sf_dir):
    from pointloom.llm.queries import ALL

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = ALL["op11_lm_scores"](spark, sf_dir).collect()
    same(got, plain(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_places_among_distinct_values():
    rng = np.random.default_rng(2)
    for values in (np.zeros(0, dtype=np.uint64), rng.integers(0, 50, 400).astype(np.uint64), rng.integers(0, 2**56, 300, dtype=np.uint64)):
        known, place = np.unique(values, return_inverse=True)
        assert (L.places(values) == place).all() and (L.distinct(values)[0] == known).all()
