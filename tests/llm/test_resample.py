"""Weights, scores and ranks against a plain version, and the query against its SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from compare import connect, differences

from pointloom.llm import resample as R


def plain(docs, target, n, buckets, seed, least, percent):
    def features(text):
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n_words, hit = features(text)
        weight = sum(gain[b] for b in hit) // len(hit) if hit else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(hit), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = able[: len(able) * percent // 100]
    out = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    left = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return Counter(out) + Counter({(*r, None): k for r, k in left.items()})


@pytest.mark.parametrize("n,percent", [(1, 10), (3, 50), (2, 100), (1, 0)])
def test_plain(spark, n, percent):
    rng = random.Random(n)
    words = ["alpha", "Beta", "gamma", "ÉTÉ", "x1", "ß", "long" * 50]
    docs = [(i, rng.choice([" ", ", ", "\n\n"]).join(rng.choices(words, k=rng.choice([0, 3, 6, 40])))) for i in range(200)]
    docs += [(None, "alpha beta gamma delta"), (None, None), (500, ""), (501, None), (502, "...!"), (503, "alpha Beta " * 30_000)]
    docs += [(7, docs[7][1])] * 60 + [(600 + i, "Beta gamma alpha beta") for i in range(60)]
    target = ["Beta beta gamma", None, "", "x1 x1 été delta"]
    df = spark.createDataFrame([(*d, "mine", 5) for d in docs], "doc_id long, text string, rank string, able long").repartition(6)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = R.resample(df, aim, n=n, buckets=97, seed=5, least_words=3, percent=percent)
    assert got.columns == ["doc_id", "text", "able", *R.ADDED] and {r.able for r in got.select("able").collect()} == {5}
    assert Counter(tuple(r) for r in got.select("doc_id", *R.ADDED).collect()) == plain(docs, target, n, 97, 5, 3, percent)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert R.resample(df.limit(0), df).count() == 0
    got = {tuple(r) for r in R.resample(df, df.limit(0), keep=["doc_id"], least_words=1, percent=100).collect()}
    assert got == set(plain([(1, "a b c"), (2, None)], [], 1, R.BUCKETS, 2024, 1, 100))


def test_query_equals_its_sql(spark, sf_dir):
    from pointloom.llm.queries import ALL, SQL

    a, b, only_spark, only_sql, notes = differences(ALL["op13_resampling"](spark, sf_dir), connect(sf_dir), SQL["op13_resampling"])
    assert a == b and not (only_spark or only_sql or notes)
