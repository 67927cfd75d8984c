"""Written tables in the shared folder, Arrow passes over texts, and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy step takes at once; with its 8-byte arrays it stays below about 100 MB.
STEP_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset: a temporary one, but only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pointloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/pointloom-llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers of this machine also find this package from then on, wherever they start."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(names: list[str], alias: str) -> Column:
    """The named columns as one struct, so that their names meet no others. A struct needs a field, so none are one null."""
    return F.struct(*([F.col(f"`{c}`") for c in names] or [F.lit(None).cast("int").alias("_")])).alias(alias)


def map_texts(
    df: DataFrame, text: str, fn: Callable[[list], list[pa.Array]], added: str, keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (default: all) and columns made by `fn` from the texts of each batch.

    `added` is the DDL of the new columns; a column of `df` with such a name is replaced. `fn` gets the texts of one
    batch as an Arrow array and returns one Arrow array for each new column. Texts that are kept are sent once.
    """
    new = df.sparkSession.createDataFrame([], added).schema
    names = {f.name.lower() for f in new}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    source = "_text"
    while source.lower() in {c.lower() for c in kept}:
        source = "_" + source
    at = kept.index(text) if text in kept else len(kept)
    inner = df.select(*[F.col(f"`{c}`") for c in kept], *([F.col(text).alias(source)] if at == len(kept) else []))
    schema = inner.drop(source).schema
    for f in new:
        schema = schema.add(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fn(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *made], names=schema.names)

    return inner.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of `edges` (a, b): equal roots exactly for connected nodes.

    Every round, each node moves to the neighbour (or itself) with the least hash and edges are relabelled, which
    about halves the nodes of any graph; no round holds more than a row a node and edge. Tables of each round go
    to the shared folder.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["n"].alias("to")
        )
        best = materialize(best, "moves")
        moved = (
            edges.join(best.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a")
            .join(best.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b")
            .where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        )
        if labels is None:
            labels = best.select("node", F.col("to").alias("root"))
        else:
            step = best.select(F.col("node").alias("root"), F.col("to").alias("_to"))
            labels = materialize(
                labels.join(step, "root", "left").select("node", F.coalesce("_to", "root").alias("root")), "labels"
            )
        edges = materialize(moved, "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
