"""Greedy longest match by the automaton against greedy longest match by search."""

import base64
import random

import numpy as np
import public_tokenizers as P

from pointloom.llm.token_counts import Automaton, automaton, count_texts, token_counts

PATH = P.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as f:
    ENTRIES = {base64.b64decode(x.split()[0]) for x in f}


def greedy(word, entries, longest=64):
    n = at = 0
    while at < len(word):
        size = next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in entries)
        at += size
        n += 1
    return n


def words_of(text):
    out = [b""]
    for c in (text or "").encode():
        if c in b" \t\n\v\f\r":
            out.append(b"")
        else:
            out[-1] += bytes([c])
    return [w for w in out if w]


def test_random_vocabularies():
    rng = random.Random(1)
    for _ in range(40):
        entries = {bytes([i]) for i in range(256)} | {bytes(rng.choice(b"ab ") for _ in range(rng.randint(2, 7))) for _ in range(25)}
        a = Automaton(sorted(entries))
        for _ in range(60):
            w = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40)))
            assert a.one(w) == greedy(w, entries)
        texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 300))) for _ in range(9)).encode() for _ in range(5)]
        assert count_texts(texts, a)[1].tolist() == [sum(greedy(b" " + w, entries) for w in t.split()) for t in texts]


def test_query_and_edge_cases(spark, sf_dir):
    from pointloom.llm.queries import ALL

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in ALL["op9_token_counts"](spark, sf_dir).collect():
        ws = words_of(rows[r.doc_id])
        assert (r.n_words, r.n_tokens) == (len(ws), sum(greedy(b" " + w, ENTRIES) for w in ws))
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "ab  c\td", "z"), (3, "ab  c\td", "z"), (None, "q" * 5000, "")], "doc_id long, text string, n_words string")
    got = token_counts(df, PATH)
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens"]
    assert sorted((r.n_words, r.n_tokens) for r in got.collect()) == sorted(
        (len(ws), sum(greedy(b" " + w, ENTRIES) for w in ws)) for ws in (words_of(r.text) for r in df.collect())
    )
    assert token_counts(df.limit(0), PATH).count() == 0
    assert isinstance(automaton(PATH).edge, np.ndarray)
