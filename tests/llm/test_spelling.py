"""Near words, forms and roots against all pairs, and the query against its SQL."""

import random
import zlib
from collections import Counter

import pytest
from compare import connect, differences

from pointloom.llm import spelling as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, times=10):
    form, near = {}, {}
    for w in counts:
        found = [v for v in counts if one_edit(v, w)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        near[w] = len(found)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], near[w], counts.get(form[w]))
    return out


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(S, "CELL", 40)
    monkeypatch.setattr(S, "LEAF", 3)
    monkeypatch.setattr(S, "PAIRS", 500)


def random_words(rng, n):
    made = {"".join(rng.choice("aabcdeé×ÿ") for _ in range(rng.randint(7, 9))) for _ in range(n)}
    for w in list(made)[: n // 2]:
        i = rng.randrange(len(w))
        made.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + "b" + w[i:], w[:i] + "ü" + w[i + 1 :]]))
    made |= {"abcdefg"[i:] + "abcdefg"[:i] for i in range(7)}  # equal counts
    made |= {"e" * 300, "e" * 301, "e" * 299 + "d", "d" * 40 + "e" * 300, "y" * 5000, "y" * 5001}
    return sorted(w for w in made if len(w) >= 7)


@pytest.mark.parametrize("seed", range(3))
def test_all_pairs(spark, small_cells, seed):
    rng = random.Random(seed)
    counts = {w: rng.choice([2, 3, 20, 200, 2500]) for w in random_words(rng, 400)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    edges, upper = S.upper_trie(_coded(spark, counts))
    assert upper and edges
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(df).collect()}
    assert got == plain(counts)


def _coded(spark, counts):
    import numpy as np

    words = list(counts)
    v = S.Words(words).vectors(np.arange(256) % S.GROUPS)
    return spark.createDataFrame([(w, n, bytearray(x.tobytes())) for (w, n), x in zip(counts.items(), v, strict=True)], "word string, n long, vector binary")


def test_whole_tables_have_no_upper_trie(spark):
    counts = {"colour" + x: 2 + i for i, x in enumerate("abcdefgh")} | {"coloura" * 2: 90}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(df).collect()}
    assert got == plain(counts)
    assert S.variants(df.limit(0)).count() == 0


def plain_counts(rows):
    import re

    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def test_words(spark):
    rng = random.Random(4)
    letters = "ABCdefÀÉÿ×÷ĀЖ1_ \n"
    rows = [(rng.randint(0, 50), "".join(rng.choice(letters) + rng.choice(["", "abcdef"]) for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    rows += [(None, "Nothing nothing NOTHING"), (None, None), (3, ""), (3, "  "), (9, "straße Straßenbahn straßenbahn " * 4000), (8, "same same sameword"), (8, "same same sameword")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(4)
    got = {r.word: r.n for r in S.word_counts(df).collect()}
    assert got == plain_counts(rows)
    assert S.word_counts(df.limit(0)).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    from pointloom.llm.queries import ALL, SQL

    a, b, only_spark, only_sql, notes = differences(ALL["op12_spelling"](spark, sf_dir), connect(sf_dir), SQL["op12_spelling"])
    assert a == b and not (only_spark or only_sql or notes)
