"""Texts gathered into chunks: a table whose texts are joined with small verdicts without being shuffled.

A chunk is one row that holds about CHUNK bytes of neighbouring texts (a larger text stands alone with those before it) and
their other columns. The table is written once to the shared folder and bucketed by chunk, so a join by chunk shuffles only
the other side. It stays in the session's catalogue under a name of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from pointloom.llm.common import new_path

CHUNK = 1 << 21
MOST_BUCKETS = 50_000


def write_chunks(docs: DataFrame, text: str, most: int = CHUNK) -> tuple[DataFrame, int]:
    """(table of chunk long, sizes binary, body binary, row array<struct of all other columns>; bytes of text).

    A chunk ends with the text that brings it to `most` bytes. `sizes` are the 32-bit lengths of the texts in `body`, -1 for null. The table has at least as many buckets as the session
    has shuffle partitions: with fewer, a join would rather shuffle it than use them.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    flat = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias("_body"))
    total = flat.agg(F.sum(F.octet_length("_body"))).first()[0] or 0
    plain = flat.drop("_body").schema
    out = spark.createDataFrame([], "chunk long, sizes binary, body binary").schema.add("row", ArrayType(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            nonlocal n
            t = pa.Table.from_batches(held).combine_chunks()
            body = t.column("_body").cast(pa.binary()).to_pylist()
            sizes = np.array([-1 if x is None else len(x) for x in body], dtype=np.int32)
            rows = pa.StructArray.from_arrays(
                [pa.concat_arrays(t.column(c).chunks) for c in others], fields=[t.schema.field(c) for c in others]
            )
            n += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | (n - 1)], pa.int64()), pa.array([sizes.tobytes()], pa.binary()),
                    pa.array([b"".join(x or b"" for x in body)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                ],
                names=out.names,
            )

        for batch in batches:
            length = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False)
            start = 0
            for i in range(batch.num_rows):
                size += int(length[i])
                if size >= most:
                    held.append(batch.slice(start, i + 1 - start))
                    yield chunk()
                    held, size, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield chunk()

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, min(MOST_BUCKETS, int(total) >> 24))
    name = f"llm_chunks_{uuid.uuid4().hex}"
    (
        flat.mapInArrow(run, out).write.bucketBy(buckets, "chunk").sortBy("chunk").format("parquet")
        .option("path", new_path(spark, "chunks")).option("compression", "zstd").option("parquet.block.size", str(1 << 24))
        .option("parquet.page.size.row.check.min", "1").saveAsTable(name)
    )
    return spark.table(name), int(total)
