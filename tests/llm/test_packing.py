"""Packing: token ids against the tokenizer itself, pieces, gapless sequences, and how few there are."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pointloom.llm.packing import Encoder, Plan, cut, op3_packing, pack

VOCABULARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
SLOW = Tokenizer.from_file(VOCABULARY)
FAST = Encoder(VOCABULARY, RANKS)


def ids(text):
    return SLOW.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tabcé'.1sS  日̀ß|<>")) , max_size=40))
def test_ids_are_the_tokenizers(text):
    assert FAST(text) == np.array(ids(text), dtype="<u4").tobytes()


def test_ids_of_odd_texts():
    for t in ["", " ", "a <|endoftext|> b", "x<|endoftext|>", "a  b", "a   b", "a \nb", "a\n b \n\n c ", "it's we'll 'S", "Ünïcödé " * 50, "ａｂ ①②"]:
        assert FAST(t) == np.array(ids(t), dtype="<u4").tobytes(), t


def test_pieces_are_full_but_the_first():
    for n in (1, 5, 8, 9, 16, 17):
        start, length = cut(n, 8)
        assert length.sum() == n and (length[1:] == 8).all() and 0 < length[0] <= 8 and start.tolist() == (np.cumsum(length) - length).tolist()


def test_plan_fills_sequences():
    rng = random.Random(3)
    for _ in range(60):
        cap = rng.choice([6, 30, 100])
        items = [rng.randint(1, cap) for _ in range(rng.randint(1, 400))]
        at, sequence, offset = Plan(Counter(items), cap).arrays()
        rank, end, used = Counter(), defaultdict(list), 0
        for n in items:
            key = n << 44 | rank[n]
            i = int(np.searchsorted(at, key, "right")) - 1
            end[int(sequence[i] + rank[n])].append((int(offset[i]), n))
            rank[n] += 1
        for held in end.values():
            stop = 0
            for o, n in sorted(held):
                assert o == stop
                stop += n
            assert stop <= cap
            assert sum(3 * n > cap for _, n in held) <= 2
        used = len(end)
        # best fit of descending sizes needs at most 11/9 of the fewest sequences and one more
        assert used <= 11 / 9 * max(-(-sum(items) // cap), sum(2 * n > cap for n in items)) + 1


def check(rows, out, capacity):
    want = Counter()
    for i, t in rows:
        x = [*ids(t), 0]
        cuts = [0] if len(x) <= capacity else [0, *range(len(x) % capacity or capacity, len(x), capacity)]
        for k, a in enumerate(cuts):
            b = cuts[k + 1] if k + 1 < len(cuts) else len(x)
            want[(i, k, a, b - a, zlib.crc32(np.array(x[a:b], dtype="<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    stop = Counter()
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == stop[r.sequence_id]
        stop[r.sequence_id] += r.length
    assert not stop or max(stop.values()) <= capacity
    return len(stop), -(-sum(k[3] * n for k, n in want.items()) // capacity)


def test_whole_operator(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "and", "Übung", "xq7", "\n"]) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (7, "same"), (7, "same"), (None, "no id"), (2000, "word " * 3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, piece string").repartition(3)
    used, bound = check(rows, pack(df, VOCABULARY, RANKS, capacity=64).collect(), 64)
    assert used <= bound * 1.02 + 1
    assert op3_packing(df.limit(0)).count() == 0


def test_query_on_the_smallest_table(spark, sf_dir):
    from pointloom.llm.queries import ALL

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used, bound = check(rows, ALL["op3_packing"](spark, sf_dir).collect(), 2048)
    assert used <= bound + 1
