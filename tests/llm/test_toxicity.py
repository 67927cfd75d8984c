"""Terms, scores against the plain formula, pairs that only interactions can tell, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest

from pointloom.llm import toxicity as Z
from pointloom.llm.common import map_texts


def test_terms_do_not_depend_on_neighbours():
    texts = [b"You idiot, you", b"", b"idiot", "Ärger über dich".encode(), b"   ", b"you idiot you IDIOT!"]
    alone = [Z.text_terms([t])[0].tolist() for t in texts]
    assert [t.tolist() for t in Z.text_terms(texts)] == alone
    assert alone[1] == alone[4] == [] and set(alone[2]) <= set(alone[0]) == set(alone[5])


def test_margins_are_the_machine_of_the_definition():
    rng = np.random.default_rng(1)
    m = Z.Model(np.zeros(0, np.int32), rng.normal(size=9), rng.normal(size=9), rng.normal(size=(9, 4)), 0.3)
    rows = [np.array(r, dtype=np.int32) for r in ([0, 3, 8], [], [2], [1, 2, 3, 4])]
    for r, got in zip(rows, Z.margins(rows, m)):
        want = 0.3 + sum(m.weight[i] * m.value[i] for i in r)
        want += sum(m.vectors[i] @ m.vectors[j] * m.value[i] * m.value[j] for i in r for j in r if i < j)
        assert got == pytest.approx(want)


def test_a_pair_counts_beyond_its_parts():
    rng = random.Random(2)
    texts, y = [], []
    for i in range(3000):
        words = [f"w{rng.randint(0, 40)}" for _ in range(8)]
        a, b = rng.random() < 0.4, rng.random() < 0.4
        words += ["insultx"] * a + ["groupy"] * b
        rng.shuffle(words)
        texts.append(" ".join(words).encode())
        y.append(int(a and b))
    terms = Z.text_terms(texts)
    m = Z.fit_rows(terms[:2400], np.array(y[:2400]))
    z = Z.margins([s[s >= 0] for s in (m.slot[t] for t in terms[2400:])], m)
    assert ((z > 0) == np.array(y[2400:])).mean() > 0.97
    pair = [m.slot[Z.text_terms([w])[0]] for w in (b"insultx", b"groupy")]
    one, other = ([i for i in p if i >= 0] for p in pair)
    assert sum(m.vectors[i] @ m.vectors[j] for i in one for j in other) > 0


def test_degenerate_labels():
    assert Z.fit_rows([], np.zeros(0, np.int64)).intercept < -10
    assert Z.fit_rows([np.array([1])] * 4, np.ones(4, np.int64)).intercept > 10


def test_query_scores_every_row_and_never_sees_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {r.doc_id: r for r in Z.op10_toxicity(docs, labels).collect()}
    assert out.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    for d, r in out.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    assert {r.doc_id: r.score for r in Z.op10_toxicity(docs, flipped).collect()} == {d: r.score for d, r in out.items()}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = Z.op10_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.toxic for r in rows) > 0.8 and hit / sum(r.predicted for r in rows) > 0.95


def test_nulls_ties_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 6), (None, "you idiot", 7), (3, "good", 8), (3, "good", 8), (4, "long " * 30000, 9)], "doc_id long, text string, score int"
    )
    labels = spark.createDataFrame([(None, 1), (3, None), (3, 0), (3, 1), (4, 0), (2, 0)], "doc_id long, toxic int")
    out = Z.score(docs, Z.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == 6
    assert len({r.score for r in out.where("coalesce(text, '') = ''").collect()}) == 1
    assert Z.keep_civil(docs, labels).columns == docs.columns
    assert Z.op10_toxicity(docs.limit(0), labels.limit(0)).count() == 0
    assert [bool(re.match("[01]", str(r.predicted))) for r in out.collect()] == [True] * 6


def test_texts_go_to_python_once_and_rows_stay(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x" * 9) for i in range(20)], "doc_id long, text string, other string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    plan = Z.keep_civil(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    kept = map_texts(docs, "text", lambda t: [t], "again string")
    assert "_text" not in kept._jdf.queryExecution().analyzed().toString()
    assert [r.again for r in kept.collect()] == [r.text for r in docs.collect()]
