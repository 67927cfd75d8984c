"""Idempotent table sinks for batch and foreachBatch, the Kafka sink, and a console preview."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pointloom.schemas import RULE, RULE_KEY

# Fixed producer settings; further options override them.
PRODUCER = {"kafka.linger.ms": "50", "kafka.batch.size": "16384", "kafka.acks": "all"}


def write_derived(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of results below `path`. A batch that runs again replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def derived_to_kafka(messages: DataFrame, topic: str, servers: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """At-least-once Kafka sink for messages (`value`), keyed by device so that a device keeps its order."""
    keyed = messages.select(F.concat_ws("/", "company_id", "device_id").alias("key"), "value")
    return (
        keyed.writeStream.format("kafka")
        .options(**{**PRODUCER, "kafka.bootstrap.servers": servers, "topic": topic, **options})
        .option("checkpointLocation", checkpoint).trigger(processingTime="60 seconds")
    )


def kafka_writer(topic: str, servers: str, **options: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch's messages (`value`) to Kafka, keyed by device; a batch that runs again sends them again."""

    def write(messages: DataFrame, batch_id: int) -> None:
        keyed = messages.select(F.concat_ws("/", "company_id", "device_id").alias("key"), "value")
        keyed.write.format("kafka").options(**{**PRODUCER, "kafka.bootstrap.servers": servers, "topic": topic, **options}).save()

    return write


def preview(df: DataFrame, rows: int = 20):
    """Print results: a console query for a stream, the first rows of a batch."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows).option("truncate", False).start()
    df.show(rows, truncate=False)
    return None


def newest(updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the largest `order` per key; combined before the shuffle."""
    row = F.struct(*[c for c in updates.columns if c not in keys])
    return updates.groupBy(*keys).agg(F.max_by(row, F.col(order)).alias("_r")).select(*keys, "_r.*")


def upsert_rules(current: DataFrame, updates: DataFrame, order: str = "seq") -> DataFrame:
    """`current` with each rule of `updates` inserted or replaced. The newest of several updates of a rule wins."""
    last = newest(updates, RULE_KEY, order).select(*RULE.fieldNames())
    kept = current.join(last.select(*RULE_KEY), RULE_KEY, "left_anti").select(*RULE.fieldNames())
    return kept.unionByName(last)


class LogTable:
    """A keyed table kept as a base and a log of changed rows: a batch writes the keys it changed, whatever the table's size.

    Each version is a folder, complete once it has _SUCCESS: `log/log_version=n` holds the rows that batch n put in or replaced,
    `base/base_version=n` the whole table after batch n. A reader takes, for each key, the row of the newest version. Batch
    n builds on what lies below version n, so running a batch again gives the same table, and readers never see a
    half-written version. After `every` batches the log is merged into a new base; what lies below the base before that is
    deleted, so folders stay few, and the last batch can still run again.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: Sequence[str], every: int = 16):
        self.spark, self.path, self.schema, self.keys, self.every = spark, path.rstrip("/"), schema, list(keys), every

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.path}/{kind}/{kind}_version={version}"

    def versions(self, kind: str = "log") -> list[int]:
        """Complete versions, oldest first."""
        jvm, fs = self._fs()
        done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{kind}_version=*/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)

    def _base(self, before: int | None) -> int | None:
        return max((v for v in self.versions("base") if before is None or v < before), default=None)

    def read(self, before: int | None = None) -> DataFrame:
        """The table as of the versions below `before` (default: all)."""
        return self._merged(self._base(before), before)

    def _logs(self, base: int | None, before: int | None) -> list[int]:
        return [v for v in self.versions() if (base is None or v > base) and (before is None or v < before)]

    def _merged(self, base: int | None, before: int | None) -> DataFrame:
        logs = self._logs(base, before)
        parts = []
        if base is not None:
            whole = self.spark.read.schema(self.schema).parquet(self._folder("base", base))
            if not logs:
                return whole
            parts.append(whole.withColumn("_version", F.lit(base).cast("bigint")))
        if logs:
            schema = T.StructType([*self.schema.fields, T.StructField("log_version", T.LongType())])
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/log").parquet(*[self._folder("log", v) for v in logs])
            parts.append(rows.withColumnRenamed("log_version", "_version"))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return newest(rows, self.keys, "_version").select(*self.schema.fieldNames())

    def changes(self, version: int) -> DataFrame:
        """The rows that one batch put in or replaced; kept until the second compaction after it."""
        return self.spark.read.schema(self.schema).parquet(self._folder("log", version))

    def write(self, changed: DataFrame, version: int) -> None:
        """Put in or replace rows, one a key."""
        changed.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._folder("log", version))
        base = self._base(version)
        if len(self._logs(base, version + 1)) >= self.every:
            self._merged(base, version + 1).write.mode("overwrite").parquet(self._folder("base", version))
            self._forget(base)

    def _forget(self, base: int | None) -> None:
        """Delete the log up to a base, and the bases below it."""
        if base is None:
            return
        jvm, fs = self._fs()
        for kind, last in (("log", base), ("base", base - 1)):
            for v in self.versions(kind):
                if v <= last:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(self._folder(kind, v)), True)


def upsert_rule_table(spark: SparkSession, path: str, order: str = "seq"):
    """A foreachBatch function that keeps the rule table at `path` current."""
    table = LogTable(spark, path, RULE, RULE_KEY)

    def apply(updates: DataFrame, batch_id: int) -> None:
        table.write(newest(updates, RULE_KEY, order), batch_id)

    return apply


def merge_statement(target: str, staging: str) -> str:
    """The statement that merges the staging table into the rule table, whose unique key is RULE_KEY (MySQL's form)."""
    names = RULE.fieldNames()
    set_ = ", ".join(f"{c} = VALUES({c})" for c in names if c not in RULE_KEY)
    return f"INSERT INTO {target} ({', '.join(names)}) SELECT {', '.join(names)} FROM {staging} ON DUPLICATE KEY UPDATE {set_}"


def jdbc_upsert(updates: DataFrame, staging_table: str, order: str = "seq", **options: str) -> None:
    """Load the newest update of each rule into a staging table over JDBC.

    The database then merges it by `merge_statement`.
    """
    rows = newest(updates, RULE_KEY, order).select(*RULE.fieldNames())
    rows.write.format("jdbc").options(**{"batchsize": "10000", **options, "dbtable": staging_table}).mode("overwrite").save()
