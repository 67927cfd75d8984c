"""The rule-sync job: change records of the configuration tables -> current configuration -> rule rows.

Each micro-batch brings the configuration tables up to date, compiles anew the points that the batch touched, and
upserts their rules. A point is touched by a change of its own row or of its object, and a roll-up also by a change of its
model or of an object of its model below its parent. Rules whose point went, or became a measured one, are switched off.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from pointloom.operators.topology import affected_rules
from pointloom.plans.compile import compile_points, rollup_watches, rule_rows
from pointloom.plans.lineage import materialize
from pointloom.schemas import MODEL, OBJECT, POINT_CONF, RULE, RULE_KEY
from pointloom.sinks.tables import LogTable
from pointloom.sources.changes import row_image

TABLES = {"point": (POINT_CONF, "data_id"), "object": (OBJECT, "object_id"), "model": (MODEL, "model_id")}


def _state(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_seq", T.LongType()), T.StructField("_gone", T.BooleanType())])


def current_rows(before: DataFrame, changes: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Rows of one table that `changes` name, with the number of their last change, deleted ones marked.

    A change that is older than what is known of its row has no effect, in whatever batch it comes.
    """
    rows = row_image(changes).withColumn("_r", F.from_json("image", schema)).where(F.col(f"_r.{key}").isNotNull())
    fresh = rows.select("_r.*", F.col("seq").alias("_seq"), (F.col("op") == "d").alias("_gone"))
    names = [c for c in before.columns if c != key]
    touched = before.join(fresh.select(key).distinct(), key, "left_semi").select(*before.columns)
    newest = touched.unionByName(fresh).groupBy(key).agg(F.max_by(F.struct(*names), F.col("_seq")).alias("_s"))
    return newest.select(key, "_s.*").select(*before.columns)


def _live(state: DataFrame) -> DataFrame:
    return state.where(~F.col("_gone")).drop("_seq", "_gone")


def sync_function(
    spark: SparkSession, root: str, names: dict[str, str] | None = None, write: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function over change records (table, op, before, after, seq).

    `names`: what the tables point, object and model are called in the records. The rule table is kept below `root`/rules;
    `write` also gets each batch's updates (RULE rows with `seq`), for a sink of its own.
    """
    names = names or {t: t for t in TABLES}
    tables = {t: LogTable(spark, f"{root.rstrip('/')}/{t}", _state(schema), [key]) for t, (schema, key) in TABLES.items()}
    rules = LogTable(spark, f"{root.rstrip('/')}/rules", RULE, RULE_KEY)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch.select("table", "op", "before", "after", "seq"))
        old, new, images = {}, {}, {}
        for t, (schema, key) in TABLES.items():
            own = batch.where(F.col("table") == names[t])
            before = tables[t].read(before=batch_id)
            tables[t].write(current_rows(before, own, schema, key), batch_id)
            old[t], new[t] = _live(before), _live(tables[t].read(before=batch_id + 1))
            texts = own.select(F.explode(F.array("before", "after")).alias("i")).where(F.col("i").isNotNull())
            images[t] = texts.select(F.from_json("i", schema).alias("r")).select("r.*")
        compiled = [compile_points(x["point"], x["object"]) for x in (old, new)]
        models = old["model"].unionByName(new["model"]).unionByName(images["model"]).distinct()
        # an object may be known by what it was: its rows before and after the batch count as images too
        moved = images["object"].unionByName(old["object"].join(images["object"].select("object_id"), "object_id", "left_semi").select(*OBJECT.fieldNames()))
        hit = [c.join(images["point"].select("data_id").distinct(), "data_id", "left_semi") for c in compiled]
        hit += [c.join(moved.select("object_id").distinct(), "object_id", "left_semi") for c in compiled]
        keys = [h.select(*RULE_KEY) for h in hit]
        for c in compiled:
            watches = rollup_watches(c)
            for found in (
                affected_rules(moved.select("parent_id", "model_id"), models, watches),
                watches.join(images["model"].select("company_id", F.col("object_code").alias("model_code")).distinct(), ["company_id", "model_code"], "left_semi"),
            ):
                keys.append(found.select(F.col("company_id").cast("string").alias("company_id"), "device_code", "point_code"))
        touched = materialize(reduce(DataFrame.unionByName, keys).distinct())
        updates = rule_rows(compiled[1]).join(touched, RULE_KEY, "left_semi")
        known = rules.read(before=batch_id)
        off = known.join(touched, RULE_KEY, "left_semi").join(updates.select(*RULE_KEY), RULE_KEY, "left_anti").withColumn("enabled", F.lit(0))
        updates = materialize(updates.select(*RULE.fieldNames()).unionByName(off.select(*RULE.fieldNames())).withColumn("seq", F.lit(batch_id).cast("bigint")))
        rules.write(updates, batch_id)
        if write:
            write(updates, batch_id)

    return run


def sync_stream(changes: DataFrame, root: str, checkpoint: str, **options) -> DataStreamWriter:
    """The whole job over one stream of change records; call `.trigger(...).start()` on the result."""
    return changes.writeStream.foreachBatch(sync_function(changes.sparkSession, root, **options)).option("checkpointLocation", checkpoint)
