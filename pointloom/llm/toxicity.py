"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words (ASCII lower case, cut at white space and ASCII punctuation) and their first 4 and 6
bytes, each hashed to one of 2^18 buckets; a text has a bucket once or not. A selected term has the value log odds of
its document frequencies in toxic and other texts; the machine learns one weight and one vector a term, so that pairs of
terms (an insult with a group mention) count beyond their sum.

The fit uses a bounded sample of labelled rows (`most_labelled`), deterministic by a hash of the id. Scoring reads all
texts whole, without a shuffle. Null and empty texts have no terms and get the score of the intercept. Repeated rows get
equal scores. With no usable labels, or only one class, the score is the share of toxic rows (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import STEP_BYTES, map_texts, set_aside
from pointloom.llm.textbytes import LOWER, U64, RangeHash, encode, parts, words

BITS = 18
PREFIXES = (4, 6)
#: Most labelled rows that the fit takes.
MOST_LABELLED = 20_000
#: Least chi-square (one degree of freedom) and least document frequency of a selected term.
LEAST_CHI_SQUARE = 10.0
LEAST_DOCUMENTS = 3
FACTORS = 8

_FOLD = LOWER.copy()
_FOLD[np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", dtype=np.uint8)] = 32


@dataclass
class Model:
    """slot: for each bucket its row in the other arrays, or -1; value, weight: by row; vectors: row by factor."""

    slot: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    vectors: np.ndarray
    intercept: float


def text_terms(texts: list[bytes], slot: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct term buckets of each text, ascending; with `slot` only selected ones, as rows of the model."""
    out: list[np.ndarray] = []
    for s in parts([len(t) for t in texts], STEP_BYTES):
        held = texts[s]
        data = _FOLD[np.frombuffer(b"".join(held), dtype=np.uint8)]
        start, end, owner = words(data, np.cumsum([len(t) for t in held]))
        hashed = RangeHash(data)
        keys, owners = [hashed(start, end)], [owner]
        for n in PREFIXES:
            longer = end - start > n
            keys.append(hashed(start[longer], start[longer] + n) * U64(2 * n + 1))
            owners.append(owner[longer])
        term = (np.concatenate(keys) >> U64(64 - BITS)).astype(np.int64)
        owner = np.concatenate(owners).astype(np.int64)
        if slot is not None:
            term = slot[term]
            owner, term = owner[term >= 0], term[term >= 0]
        both = np.unique(owner << BITS | term)
        cuts = np.searchsorted(both >> BITS, np.arange(len(held) + 1))
        both &= (1 << BITS) - 1
        out += [both[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def margins(terms: list[np.ndarray], m: Model) -> np.ndarray:
    """Log odds of each text, given its model rows."""
    n = len(terms)
    row = np.repeat(np.arange(n), [len(t) for t in terms])
    at = np.concatenate([*terms, np.zeros(0, np.int32)]).astype(np.int64)
    x = m.value[at]
    scaled = m.vectors[at] * x[:, None]
    total = np.stack([np.bincount(row, scaled[:, k], n) for k in range(scaled.shape[1])], axis=1)
    squares = np.bincount(row, (scaled**2).sum(axis=1), n)
    return m.intercept + np.bincount(row, m.weight[at] * x, n) + 0.5 * ((total**2).sum(axis=1) - squares)


def fit_rows(terms: list[np.ndarray], toxic: np.ndarray, epochs: int = 30, rate: float = 0.1, seed: int = 1) -> Model:
    """Select terms and fit the machine with Adagrad on the log loss. `terms` are buckets."""
    n, n1 = len(toxic), int(toxic.sum())
    n0 = n - n1
    if not n1 or not n0:
        share = min(max(n1 / n if n else 0.0, 1e-6), 1 - 1e-6)
        none = np.zeros(0, np.float32)
        return Model(np.full(1 << BITS, -1, np.int32), none, none, np.zeros((0, FACTORS), np.float32), float(np.log(share / (1 - share))))
    count = lambda of: np.bincount(
        np.concatenate([*[t for t, y in zip(terms, toxic, strict=True) if y == of], np.zeros(0, np.int32)]), minlength=1 << BITS
    )
    c1, c0 = count(1), count(0)
    odds = np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1))
    p = (c1 + c0) / n
    chi = (c1 - n1 * p) ** 2 / np.maximum(n1 * p * (1 - p) * n0 / n, 1e-9)
    chosen = np.flatnonzero((chi >= LEAST_CHI_SQUARE) & (c1 + c0 >= LEAST_DOCUMENTS))
    slot = np.full(1 << BITS, -1, np.int32)
    slot[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(seed)
    m = Model(
        slot, odds[chosen].astype(np.float32), np.zeros(len(chosen), np.float32),
        rng.normal(0, 0.02, (len(chosen), FACTORS)).astype(np.float32), float(np.log(n1 / n0)),
    )
    rows = [s[s >= 0] for s in (slot[t] for t in terms)]
    seen_w = np.full(len(chosen), 1e-3, np.float32)
    seen_v = np.full(len(chosen), 1e-3, np.float32)
    seen_b, shrink, batch = 1e-3, 1e-3, 128
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, batch):
            take = order[i : i + batch]
            held = [rows[j] for j in take]
            row = np.repeat(np.arange(len(take)), [len(t) for t in held])
            at = np.concatenate(held).astype(np.int64)
            x = m.value[at]
            scaled = m.vectors[at] * x[:, None]
            total = np.zeros((len(take), FACTORS), np.float32)
            np.add.at(total, row, scaled)
            z = margins(held, m)
            slope = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[take]) / len(take)).astype(np.float32)
            which, to = np.unique(at, return_inverse=True)
            dw = np.bincount(to, slope[row] * x, len(which)).astype(np.float32) + shrink * m.weight[which] / len(take)
            dv = np.zeros((len(which), FACTORS), np.float32)
            np.add.at(dv, to, (slope[row] * x)[:, None] * (total[row] - scaled))
            dv += shrink * m.vectors[which] / len(take)
            seen_w[which] += dw**2
            seen_v[which] += (dv**2).mean(axis=1)
            m.weight[which] -= rate * dw / np.sqrt(seen_w[which])
            m.vectors[which] -= 0.3 * rate * dv / np.sqrt(seen_v[which])[:, None]
            db = float(slope.sum())
            seen_b += db * db
            m.intercept -= rate * db / seen_b**0.5
    return m


def held_out(doc_id: Column) -> Column:
    """True for rows that the fit never sees: crc32 of the id's text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on at most `most_labelled` labelled rows that are not held out. A text with several labels takes the highest."""
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(most_labelled)
    )

    def terms_of(texts) -> list[pa.Array]:
        return [pa.array([t.tobytes() for t in text_terms(encode(texts))], pa.binary())]

    # bounded by most_labelled, so it may be broadcast
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    sample = map_texts(rows, "text", terms_of, "terms binary", keep=["id", "y"]).groupBy("id").agg(
        F.max("y").alias("y"), F.min("terms").alias("terms")
    )
    got = sample.toPandas().sort_values("id")
    return fit_rows([np.frombuffer(t, dtype=np.int32) for t in got["terms"]], got["y"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs`, with score double (0 to 1) and predicted int added or replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^18 buckets and FACTORS: fixed size

    @F.arrow_udf("score double, predicted int")
    def scored(texts: pa.Array) -> pa.Array:
        m, size = shared.value, pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        z = [margins(text_terms(encode(texts[s]), m.slot), m) for s in parts(size, STEP_BYTES)]
        p = 1 / (1 + np.exp(-np.clip(np.concatenate([*z, np.zeros(0)]), -500, 500)))
        return pa.StructArray.from_arrays([pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], ["score", "predicted"])

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    made = "_scored"
    while made.lower() in {c.lower() for c in kept}:
        made = "_" + made
    # only the texts go to Python, the rows stay
    out = docs.select(*[F.col(f"`{c}`") for c in kept], scored(F.col(text)).alias(made))
    return out.select(*[F.col(f"`{c}`") for c in kept], F.col(f"{made}.score"), F.col(f"{made}.predicted"))


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs` that are not predicted toxic, with the columns of `docs`."""
    held = docs.select(set_aside(docs.columns, "row"), "text")
    return score(held, fit(docs, labels)).where("predicted = 0").select("row.*")
