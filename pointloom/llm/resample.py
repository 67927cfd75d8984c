"""Importance resampling towards a target set: documents drawn by how their hashed n-grams resemble the target's.

A document's features are its runs of 1 to n words, with repeats; a feature's bucket is the CRC-32 of its UTF-8 bytes
modulo the number of buckets. A bucket's gain is the log-ratio of its smoothed shares in the target and in the documents,
a document's weight the mean gain of its features. Gumbel noise from a hash of the id is added, and the greatest scores
are drawn, which samples without replacement in proportion to exp(weight).

Texts go through Arrow kernels: lower case, split by a pattern, flattened lists, dictionary encoding. n-grams are made of
shifted dictionary indices; only the distinct ones of a step are written out and hashed. Gains are taken by bucket and
summed up by document. Two passes read the texts: one for the histograms (one row of buckets a task is all that is
shuffled), one for the weights. Scores are whole numbers, so the last score that is drawn is found on their histogram, and
only rows from there on are put in order, by ranges.

A null or empty text has no feature and weight 0. Very long texts are taken whole, each in a step of its own. Equal scores
are drawn by smaller id, null ids first; rows of one id and score (repeated rows) in any order, each with a rank of its own.
A null id is hashed as the empty text. An empty table gives no rows, an empty target equal gains for empty buckets.
Columns of the documents with the names of the added ones are replaced; any other name is kept as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import STEP_BYTES, map_texts, materialize, set_aside
from pointloom.llm.textbytes import parts

#: What stands between words, in lower-cased text: all of ASCII but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ADDED = ("n_features", "weight", "score", "rank")


def text_steps(texts: pa.Array) -> Iterator[tuple[slice, pa.Array]]:
    """Slices of the texts of about STEP_BYTES; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    sizes = pc.binary_length(texts).to_pylist()
    for s in parts(sizes, STEP_BYTES):
        yield s, texts.slice(s.start, s.stop - s.start)


def crc_buckets(values: pa.Array, buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(v) for v in values.cast(pa.binary()).to_pylist()], dtype=np.int64) % buckets


def feature_buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each length of run (number of the text, bucket) of every feature, in order of the texts."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), GAP)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(flat, "")
    flat, owner = flat.filter(real), owner.filter(real).to_numpy()
    n_words = np.bincount(owner, minlength=len(texts))
    coded = flat.dictionary_encode()
    words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    names, code, found = words, index, []
    for length in range(1, n + 1):
        if length > 1:  # runs one word longer: the index of a run and that of the word behind it
            inside = owner[: len(code) - 1] == owner[length - 1 :]
            pair = (code[:-1] * len(words) + index[length - 1 :]) if len(code) else code
            distinct, code = np.unique(pair, return_inverse=True)
            first, last = np.divmod(distinct, max(1, len(words)))
            names = pc.binary_join_element_wise(names.take(pa.array(first)), words.take(pa.array(last)), " ")
            found.append((owner[: len(code)][inside], crc_buckets(names, buckets)[code[inside]]))
        else:
            found.append((owner, crc_buckets(names, buckets)[code]))
    return n_words, found


def histogram(df: DataFrame, text: str = "text", n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, texts in text_steps(b.column(0)):
                for _, hit in feature_buckets(texts, n, buckets)[1]:
                    total += np.bincount(hit, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = df.select(F.col(f"`{text}`")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths and rounded down. As many numbers as there are buckets come to the driver."""
    spark = docs.sparkSession
    source = histogram(docs, text, n, buckets).withColumnRenamed("n", "s")
    aim = histogram(target, text, n, buckets).withColumnRenamed("n", "t")
    both = source.join(aim, "bucket", "full").na.fill(0, ["s", "t"])
    both = materialize(both, "histograms")
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).na.fill(0)
    d = lambda c: F.col(c).cast("double")
    ratio = (d("t") + 1) * (d("all_s") + buckets) / ((d("s") + 1) * (d("all_t") + buckets))
    rows = spark.range(buckets).withColumnRenamed("id", "bucket").join(both, "bucket", "left").na.fill(0, ["s", "t"])
    made = rows.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()  # one row of sums
    out = np.zeros(buckets, dtype=np.int64)
    for r in made:
        out[r.bucket] = r.gain
    return out


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of `<seed>:<id>`."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, able: Column, percent: int) -> DataFrame:
    """Adds `rank`, 1 and on, to the floor(percent/100) of the able rows that have the greatest `score`, then the least `id`.

    `rows` has score long and id; the histogram of scores is bounded by their range, whatever the number of rows.
    """
    rows = materialize(rows.withColumn("able", F.coalesce(able, F.lit(False))), "scores")
    levels = materialize(rows.where("able").groupBy("score").count(), "levels")
    total = levels.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    wanted = total * percent // 100
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    above = F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score")))
    least = levels.withColumn("upto", above).where(F.col("upto") >= wanted).agg(F.max("score")).first()[0]
    upper = F.col("able") & (F.col("score") >= least)
    order = [F.desc("score"), F.asc_nulls_first("id")]
    parts_ = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.where(upper).repartitionByRange(parts_, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("part").count()  # one row a partition
    before = F.coalesce(F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long") + F.col("before")
    drawn = dealt.join(sizes.select("part", before.alias("before")), "part").withColumn("_place", place)
    drawn = drawn.withColumn("rank", F.when(F.col("_place") <= wanted, F.col("_place"))).drop("_place", "before", "part")
    return drawn.unionByName(rows.where(~upper).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, n: int = 1,
    buckets: int = BUCKETS, seed: int = 2024, least_words: int = 20, percent: int = 10,
) -> DataFrame:
    """The kept columns (default: all) with n_features, weight, score and rank (null: not drawn), all long."""
    gain = gains(docs, target, text, n, buckets)
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    held = docs.select(
        set_aside(kept, "row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")
    )

    def run(texts: pa.Array) -> list[pa.Array]:
        n_words, n_features, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        for s, some in text_steps(texts):
            n_words[s], found = feature_buckets(some, n, buckets)
            for owner, hit in found:
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
                if len(first):
                    total[s.start + owner[first]] += np.add.reduceat(gain.take(hit), first)
                n_features[s] += np.bincount(owner, minlength=len(some))
        return [pa.array(n_words), pa.array(n_features), pa.array(total // np.maximum(n_features, 1))]

    rows = map_texts(held, "text", run, "n_words long, n_features long, weight long", ["row", "id"])
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    return ranked(rows, F.col("n_words") >= least_words, percent).select("row.*", *ADDED)


#: The same rows in DuckDB SQL. CRC-32 by its table of 256 remainders, which the rule of the polynomial gives.
OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS r FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(words) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM b) GROUP BY w),
x AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
crc AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(hx) // 2), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, t[CAST(xor(c, y) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS k FROM x, crc_table),
s AS (SELECT k, CAST(sum(n) AS BIGINT) AS s FROM dw JOIN crc USING (w) GROUP BY k),
t AS (SELECT k, CAST(sum(n) AS BIGINT) AS t FROM bw JOIN crc USING (w) GROUP BY k),
g AS (
  SELECT s.k, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) FROM s) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(t), 0) AS DOUBLE) FROM t) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON s.k = t.k),
v AS (SELECT r, sum(n) AS n, sum(n * gain) AS total FROM dw JOIN crc USING (w) JOIN g USING (k) GROUP BY r),
y AS (
  SELECT d.doc_id, d.r, CAST(len(d.words) AS BIGINT) AS n_features,
    CASE WHEN v.n IS NULL THEN CAST(0 AS BIGINT) ELSE CAST((v.total - ((v.total % v.n) + v.n) % v.n) // v.n AS BIGINT) END AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN v ON d.r = v.r),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM y),
o AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM z WHERE n_features >= 20)
SELECT z.doc_id, z.n_features, z.weight, z.score, CASE WHEN o.place <= o.able * 10 // 100 THEN CAST(o.place AS BIGINT) END AS rank
FROM z LEFT JOIN o ON z.r = o.r
"""


def op13_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's parameters: single words, 10,000 buckets, 10 % of the documents of at least 20 words."""
    return resample(docs, benchmark, keep=["doc_id"])
