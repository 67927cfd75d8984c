"""Mixing sources to target weights by hash thresholds.

Sizes are words. A source's target is its share of the budget by weight, at most `most` times its size; what goes beyond
is shared again by weight among the others, which is one water level: target = least(most * size, level * weight).

A document is taken whole-number times as often as its whole source fits the target, and once more if its hash lies below
the source's threshold. The threshold comes from sums of sizes by source and hash bucket: the bucket in which the running
sum passes the rest of the target is the boundary, only its rows are summed again by the next bits of the hash, and so on
until it holds one row. Rows below the boundary are taken by a filter; nothing is sorted. Rows of the boundary itself are
taken if that leaves the source nearer to its target.

The hash is of the id, so reruns agree; rows of one id (and rows of null id) are taken or left together. A null text has
size 0. Null is a source like any other. A source without words has target 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: A hash has 60 bits; each level looks at 12 more of them.
HASH_BITS, LEVEL_BITS = 60, 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds target to (source, source_size), one row a source. The number of sources is small beside the documents."""
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_n") % len(weights) + 1).cast("int")).cast("double")
    ranked = sizes.withColumn(
        "_n", F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    ).withColumn("_w", weight)
    by_cap = everything.orderBy(F.col("source_size") / F.col("_w"), "_n")
    cap = most * F.col("source_size")
    levels = ranked.withColumns({
        "_capped": F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_open": F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
        "_all": F.sum("source_size").over(everything),
    }).withColumn("_level", (share * F.col("_all") - F.col("_capped")) / F.col("_open"))
    # the water level is the first, in order of caps, that its own source's cap doesn't bind
    level = F.min(F.when(F.col("_level") * F.col("_w") <= cap, F.struct(F.col("source_size") / F.col("_w"), F.col("_n"), F.col("_level").alias("l")))).over(everything)
    return levels.withColumn("_l", level["l"]).select(
        "source", "source_size",
        F.when(F.col("_l").isNull(), cap.cast("double")).otherwise(F.least(cap.cast("double"), F.col("_l") * F.col("_w"))).alias("target"),
    )


def thresholds(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, whole, below, shift, at): how often a source's rows are taken.

    `rows` has source, size and h. Each row is taken `whole` times, and once more if h >> shift is below `below`.
    """
    shift = HASH_BITS - LEVEL_BITS
    first = materialize(
        rows.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n")), "histogram"
    )
    aims = targets(first.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = materialize(
        aims.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets"
    )
    edge = _boundary(first, aims.withColumn("base", F.lit(0).cast("long")), "rest", "base")
    edge = materialize(edge, "boundary")
    while shift > 0 and not edge.where("n > 1").isEmpty():
        now, shift = shift, max(0, shift - LEVEL_BITS)
        inside = rows.join(
            edge.select(F.col("source").alias("_s"), F.col("b").alias("_b")),
            F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("h", now) == F.col("_b")),
        )
        finer = inside.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        edge = materialize(_boundary(finer, edge.select("source", "rest", "base"), "rest", "base"), "boundary")
    nearer = F.col("base") + F.col("size") - F.col("rest") < F.col("rest") - F.col("base")
    cuts = edge.select(F.col("source").alias("_s"), (F.col("b") + nearer.cast("long")).alias("below"))
    return aims.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below"), F.lit(shift).alias("shift")
    )


def _boundary(histogram: DataFrame, aims: DataFrame, rest: str, base: str) -> DataFrame:
    """The first bucket of each source in which the running sum passes the rest of its target: source, rest, base, b, size, n."""
    w = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    aims = aims.select(F.col("source").alias("_s"), F.col(rest).alias("rest"), F.col(base).alias("_from"))
    run = histogram.withColumn("_sum", F.sum("size").over(w)).join(aims, F.col("source").eqNullSafe(F.col("_s")))
    run = run.withColumn("base", F.col("_from") + F.col("_sum") - F.col("size"))
    passed = run.where((F.col("base") + F.col("size") > F.col("rest")) & (F.col("base") <= F.col("rest")))
    return passed.groupBy("source").agg(
        F.min(F.struct("b", "base", "size", "n", "rest")).alias("_e")
    ).select("source", "_e.*")


def taken_times(h: Column) -> Column:
    """How often a row is taken, given its source's row of `thresholds`."""
    return F.col("whole") + F.expr("shiftright(h, shift) < below").cast("long")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row of `docs`."""
    rows = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), row_hash(F.col(doc_id)).alias("h")
        ), "sizes"
    )
    cuts = materialize(thresholds(rows, weights, share, most), "thresholds").withColumnRenamed("source", "_s")
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * taken_times(F.col("h"))).alias("taken")
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with the columns of `docs`."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).select(
        "row", F.col("row.source").alias("source"), n_words(F.col("row.text")).alias("size"), row_hash(F.col("row.doc_id")).alias("h")
    )
    cuts = materialize(thresholds(rows.drop("row"), weights, share, most), "thresholds").withColumnRenamed("source", "_s")
    times = rows.join(cuts, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_times", taken_times(F.col("h")))
    repeated = times.select("row", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_t"))
    return repeated.select("row.*")


#: The same rows in DuckDB SQL: the threshold as a running sum over all hashes of a source.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM s),
w AS (SELECT *, CAST([3, 1, 2][CAST(n % 3 AS INTEGER) + 1] AS DOUBLE) AS w FROM r),
l AS (
  SELECT *,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (ORDER BY source_size / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY source_size / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
water AS (SELECT level FROM l WHERE level * w <= 2 * source_size ORDER BY source_size / w, n LIMIT 1),
t AS (
  SELECT source, source_size,
    CAST(least(2 * source_size, coalesce((SELECT level FROM water) * w, 2 * source_size)) AS DOUBLE) AS target FROM l),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
u AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
c AS (
  SELECT u.*, q.target - q.whole * q.source_size AS rest,
    sum(u.size) OVER (PARTITION BY u.source ORDER BY u.h ROWS UNBOUNDED PRECEDING) - u.size AS base
  FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source),
e AS (
  SELECT source, h, base + size <= rest OR (base <= rest AND base + size - rest < rest - base) AS more FROM c)
SELECT d.doc_id, d.size, q.source_size, q.target, CAST(d.size * (q.whole + CAST(e.more AS BIGINT)) AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
JOIN e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h
"""


def op7_mixing(docs: DataFrame) -> DataFrame:
    """The contract's weights, share and limit."""
    return mix(docs)
