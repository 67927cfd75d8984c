"""Cutting long plans by writing intermediate tables to the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset: a temporary one, but only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pointloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """`df` written once as a table and read back; survives the loss of executors."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/pointloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Rows found in rounds, kept in one folder: all of them are one scan, however many rounds there were."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n, self.schema = spark, f"{checkpoint_folder(spark).rstrip('/')}/pointloom-{uuid.uuid4().hex}", 0, None

    def add(self, df: DataFrame) -> DataFrame:
        """Write the rows of a round, and give them back."""
        self.schema = self.schema or df.schema
        path = f"{self.folder}/round-{self.n}"
        df.write.parquet(path)
        self.n += 1
        return self.spark.read.schema(self.schema).parquet(path)

    def rows(self) -> DataFrame:
        """The rows of all rounds so far."""
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/round-{i}" for i in range(self.n)])
