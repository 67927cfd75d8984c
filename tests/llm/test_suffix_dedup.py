"""Removal of repeated passages against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest

from pointloom.llm import chunks
from pointloom.llm import suffix_dedup as S
from pointloom.llm.bwt import equal_prefix_groups


def brute(rows, length):
    """{position in rows: (n_bytes, n_removed, n_spans, sha256)} for (doc_id, text) rows; ids are distinct."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if s in seen:
                gone[k : k + length] = True
            seen.add(s)
        gone = gone[: len(b)]
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[rows[i][0]] = (len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


def hard_texts(rng, n):
    base = ["".join(rng.choice("abcdeé \n") for _ in range(rng.randint(0, 400))) for _ in range(n // 3)]
    texts = list(base)
    texts += [None, "", "a" * 900, "a" * 950 + "b" + "a" * 300, "xyz" * 200, "0123456789" * 60 + "q", "short"]
    while len(texts) < n:
        parts = [rng.choice(base)[rng.randint(0, 50) :] for _ in range(rng.randint(1, 3))]
        t = "".join(parts)
        if rng.random() < 0.5 and t:
            k = rng.randrange(len(t))
            t = t[:k] + "#" + t[k + 1 :]
        texts.append(t)
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("length", [3, 8, 17])
def test_groups_are_the_equal_prefixes(length):
    rng = random.Random(length)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    data = np.frombuffer("\0".join(texts).encode() + b"\0", dtype=np.uint8)
    symbols = np.where(data == 0, 0, data + 1).astype(np.uint8)
    suffix, group = equal_prefix_groups(symbols, length)
    raw = symbols.tobytes()
    key = {}
    for s, g in zip(suffix.tolist(), group.tolist()):
        p = raw[s : s + length]
        if len(p) == length and b"\0" not in p:
            assert key.setdefault(g, p) == p
            assert key.setdefault(p, g) == g


def test_every_start_has_one_anchor_and_equal_strings_share_its_hash():
    rng = random.Random(5)
    texts = [(t or "").encode() for t in hard_texts(rng, 60)]
    for length in (16, 50, 100):
        a = S.Anchors(b"".join(texts), np.cumsum([len(t) for t in texts]), length)
        body, seen, by_string = b"".join(texts), set(), {}
        for v, f, z in zip(a.value.tolist(), a.first.tolist(), a.last.tolist()):
            for k in range(f, z + 1):
                assert k not in seen
                seen.add(k)
                assert by_string.setdefault(body[k : k + length], v) == v
        assert len(seen) == sum(max(0, len(t) - length + 1) for t in texts)


@pytest.mark.parametrize("length", [16, 100])
def test_equals_brute_force(spark, monkeypatch, length):
    rng = random.Random(length)
    rows = list(zip(rng.sample(range(-50, 5000), 120), hard_texts(rng, 120)))
    rows[0] = (None, rows[0][1])
    monkeypatch.setattr(chunks, "CHUNK", 3000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(df, length).collect()}
    assert got == brute(rows, length)


def test_large_anchor_groups_and_long_texts_are_split_exactly():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh") for _ in range(130))
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + passage + "".join(rng.choice("xyz") for _ in range(20)) for _ in range(40)})
    texts = [t.encode() for t in texts]
    together = S.repeated_starts(texts, 100)
    split = S._by_first_bytes(texts, 100)
    assert all(np.array_equal(a, b) for a, b in zip(together, split))


def test_nulls_copies_clashing_columns_and_empty_tables(spark):
    t = "Ein Satz mit Umlauten: äöü. " * 12
    rows = [(1, t, "x", 5), (1, t, "x", 5), (None, None, None, None), (2, "neu " + t, "y", 7), (3, "", "y", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_chars int")
    out = S.dedup(df, kept="kept").collect()
    assert sorted(r.n_removed for r in out)[:2] == [0, 0] and len(out) == 5
    assert [r.kept for r in out if r.doc_id is None] == [None]
    assert sum(r.n_bytes for r in out if r.doc_id == 1) == 2 * len(t.encode())
    assert sum(r.n_removed == r.n_bytes for r in out if r.doc_id == 1) == 1  # one of two equal rows stays
    kept = S.without_repeats(df)
    assert kept.columns == df.columns and kept.count() == 5
    assert S.dedup(df.limit(0)).count() == 0


def test_whole_copies_are_settled_by_their_hash_alone(spark, monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randint(150, 600))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(chunks, "CHUNK", 3000)
    written, _ = chunks.write_chunks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "text")
    codes = b"".join(r.codes for r in S.anchor_codes(written, "doc_id", 100, 2).collect())
    a = S.Anchors("".join(texts).encode(), np.cumsum([len(t) for t in texts]), 100)
    assert codes.count(2) == 0  # no text is sent
    assert codes.count(0) == len(a.value)  # the first of two copies, in whichever chunk
