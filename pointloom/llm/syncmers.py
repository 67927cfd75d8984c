"""Document fingerprints of closed syncmers.

A closed syncmer is a substring of K characters whose least inner substring of S characters (by hash) stands at its first or
last place. Whether a substring is one depends on itself alone, so an edit elsewhere never moves an anchor. The
fingerprint of a text is, with their places, all anchors whose hash is at most BOUND, about one in fifty characters of a text
of any length, and of shorter texts the KEPT of least hash. Likeness of two fingerprints: of the hashes up to where both hold
all of theirs, those that both have at places shifted alike (near the median shift); that share j is an estimate of common
over all anchors, and 2j / (1 + j), the common share of each text, is reported.

A text shorter than K is one anchor. The empty (and null) text has the empty fingerprint, which is like itself only. Equal
texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.textbytes import U64, mix

K, S, KEPT = 8, 3, 64
#: Of 32 bits: a sixteenth of all anchors, which are a third of all places.
BOUND = 1 << 28
#: Bytes of text that neighbours in id order share a bucket with.
BUCKET_BYTES = 4 << 20

Print = tuple[np.ndarray, np.ndarray]  # hashes (32 bits, ascending), places


def anchors(text: str) -> Print:
    """Hash and place of the anchors of a text up to BOUND, or its KEPT least, by hash."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(c) < K:
        h = U64(len(c))
        for x in c:
            h = mix(np.array([h * U64(31) + x], dtype=U64))[0]
        return np.array([int(h) >> 32]), np.zeros(1, np.int64)
    one = mix(c + U64(1))
    two = mix(one[:-1] * U64(3) + one[1:])
    inner = mix(two[:-1] * U64(5) + one[2:])  # S = 3 characters
    four = mix(two[:-2] * U64(7) + two[2:])
    whole = mix(four[:-4] * U64(9) + four[4:])  # K = 8 characters
    n, last = len(whole), K - S
    pair = np.minimum(inner[:-1], inner[1:])
    least = np.minimum(np.minimum(pair[:n], pair[2 : n + 2]), pair[4 : n + 4])  # over K - S + 1 = 6 inner ones
    at = np.flatnonzero((inner[:n] == least) | (inner[last : last + n] == least))
    h = (whole[at] >> U64(32)).astype(np.int64)
    if len(h) > 4 * KEPT:
        near = np.flatnonzero(h <= max(BOUND, int(np.partition(h, 4 * KEPT)[4 * KEPT])))
        few, first = np.unique(h[near], return_index=True)
        if len(few) >= KEPT:
            count = max(KEPT, int(np.searchsorted(few, BOUND, "right")))
            return few[:count], at[near[first[:count]]]
    few, first = np.unique(h, return_index=True)
    count = max(KEPT, int(np.searchsorted(few, BOUND, "right")))
    return few[:count], at[first[:count]]


def _reach(h: np.ndarray) -> int:
    """Up to which hash a fingerprint holds all anchors of its text."""
    return 1 << 32 if len(h) < KEPT else max(BOUND, int(h[-1]))


def written(p: Print) -> str:
    return ",".join([f"{h:08x}@{a:x}" for h, a in zip(p[0].tolist(), p[1].tolist(), strict=True)])


def likeness(p: Print, q: Print) -> float:
    if not len(p[0]) or not len(q[0]):
        return float(len(p[0]) == len(q[0]))
    upto = min(_reach(p[0]), _reach(q[0]))
    common, i, j = np.intersect1d(p[0], q[0], assume_unique=True, return_indices=True)
    held = common <= upto
    if not held.any():
        return 0.0
    shift = q[1][j[held]] - p[1][i[held]]
    slack = max(16, int(max(p[1].max(), q[1].max())) // 20)
    both = int((p[0] <= upto).sum()) + int((q[0] <= upto).sum()) - int(held.sum())
    alike = int((np.abs(shift - np.median(shift)) <= slack).sum()) / both
    return 2 * alike / (1 + alike)


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as many characters, or all, of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _bucket(splits: list[int], doc_id) -> F.Column:
    """How many of the ascending splits are at most doc_id: binary search in a literal array."""
    bits = max(1, len(splits).bit_length())
    padded = F.array(*[F.lit(s).cast("long") for s in splits + [2**63 - 1] * ((1 << bits) - len(splits))])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, p: F.when(F.element_at(padded, at + p) <= doc_id, at + p).otherwise(at))


def neighbours(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """(bucket, follows, doc_id, text): rows of near ids, and after each bucket's rows the one that follows them.

    Rows are ordered by id (null first; equal ids by their text's hash). The last row is followed by the first. Only ids and
    sizes decide the buckets; each text is shuffled once, and one text a bucket once more.
    """
    total, n = docs.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    count = max(1, min(n or 1, -(-(total or 0) // bucket_bytes)))
    points = docs.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.1 / count) if count > 1 and n else []
    splits = sorted({int(p) for p in points})
    rows = docs.select(
        F.coalesce(_bucket(splits, F.col("doc_id")), F.lit(0)).alias("bucket"), F.lit(0).alias("follows"), "doc_id",
        F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"),
    )
    first = rows.groupBy("bucket").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none")
    ).orderBy("bucket").collect()  # one row a bucket
    if not first:
        return rows, 1
    before = {r["bucket"]: first[i - 1]["bucket"] for i, r in enumerate(first)}
    spark = docs.sparkSession
    heads = spark.createDataFrame(
        [(r["bucket"], before[r["bucket"]], None if r["none"] else r["least"]) for r in first], "bucket int, before int, least long"
    )
    # at most one id a bucket, so a broadcast of these is bounded by their number
    led = rows.join(F.broadcast(heads), (rows["bucket"] == heads["bucket"]) & rows["doc_id"].eqNullSafe(heads["least"])).select(
        F.col("before").alias("bucket"), F.lit(1).alias("follows"), "doc_id", "h", "text"
    )
    led = led.dropDuplicates(["bucket", "h"])
    return rows.unionByName(led), len(first)


def fingerprint_rows(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, count = neighbours(source, bucket_bytes)
    dealt = rows.repartition(count, "bucket").sortWithinPartitions("bucket", "follows", "doc_id", "h")
    schema = source.select("doc_id").schema
    for name, kind in (
        ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
        ("near_edited", "double"), ("near_next", "double"),
    ):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # bucket, id, text, fingerprint
        for batch in batches:
            out: list[tuple] = []
            for bucket, follows, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("bucket", "follows", "doc_id", "text")], strict=True):
                here = anchors(text)
                if last is not None and last[0] == bucket:
                    _, of, own, mark = last
                    changed = edited(own, text)
                    there = anchors(changed)
                    out.append((
                        of, len(own), hashlib.sha256(changed.encode()).hexdigest(), written(mark), written(there),
                        likeness(mark, there), likeness(mark, here),
                    ))
                last = None if follows else (bucket, doc_id, text, here)
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    return dealt.select("bucket", "follows", "doc_id", "text").mapInArrow(run, schema)


def op5_fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return fingerprint_rows(docs.select("doc_id", "text"))
