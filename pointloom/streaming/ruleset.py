"""The rule set of a live job: pinned by batch, and brought up to date by what changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointloom.plans.compile import rollup_dependencies
from pointloom.plans.engine import RuleSet, active_rules, newest_rules, prepare_rules, refresh_rules
from pointloom.plans.lineage import materialize
from pointloom.plans.registry import ROLLUPS
from pointloom.schemas import MODEL, OBJECT, RULE, RULE_KEY
from pointloom.sinks.tables import LogTable

Loader = Callable[[SparkSession], DataFrame]


class PinnedTable:
    """What each batch saw of a table with a loader, one row a key, as a table of a base and a log.

    The first run of a batch loads the table and logs the rows that differ from those of the batch before; rows that are
    gone are marked. A batch that runs again reads what its first run saw. Rows with a null in their key are left out:
    nothing refers to them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], load: Loader, every: int = 16):
        state = T.StructType([*schema.fields, T.StructField("_gone", T.BooleanType())])
        self.spark, self.schema, self.keys, self.load = spark, schema, list(keys), load
        self.log = LogTable(spark, path, state, keys, every)

    def _loaded(self) -> DataFrame:
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        rows = self.load(self.spark)
        if self.keys == RULE_KEY:
            rows = newest_rules(rows)
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        rows = rows.where(F.lit(True) if not self.keys else F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)))
        return rows.groupBy(*self.keys).agg(F.max(F.struct(*rest)).alias("_now"))

    def pin(self, batch_id: int) -> DataFrame:
        """Rows that the batch put in, replaced or marked as gone."""
        if batch_id not in self.log.versions():
            rest = [c for c in self.schema.fieldNames() if c not in self.keys]
            known = self.log.read(before=batch_id).select(*self.keys, F.struct(*rest).alias("_then"), "_gone")
            both = self._loaded().join(known, self.keys, "full_outer")
            now, then = F.col("_now"), F.col("_then")
            differs = F.when(now.isNull(), ~F.col("_gone")).otherwise(F.coalesce("_gone", F.lit(True)) | ~now.eqNullSafe(then))
            changed = both.where(differs).select(*self.keys, F.coalesce(now, then).alias("_r"), now.isNull().alias("_gone"))
            self.log.write(changed.select(*self.keys, "_r.*", "_gone"), batch_id)
        return self.log.changes(batch_id)

    def rows(self, batch_id: int) -> DataFrame:
        """The table as the batch saw it."""
        return self.log.read(before=batch_id + 1).where(~F.col("_gone")).select(*self.schema.fieldNames())


class LiveRules:
    """Rule sets by batch, below `root`: the rule, object and model rows that a batch saw are pinned, so a batch that runs
    again has the same rules whatever the loaders give by then.

    From one batch to the next, only rules that a changed row reaches are taken apart and levelled anew. A roll-up is changed
    by a change of its row or of its children. After a restart the first batch prepares all rules from the pinned rows.
    """

    def __init__(
        self, spark: SparkSession, root: str, rules: Loader, objects: Loader | None = None, models: Loader | None = None, every: int = 16
    ):
        def table(name: str, schema: T.StructType, keys: Sequence[str], load: Loader | None) -> PinnedTable | None:
            return load and PinnedTable(spark, f"{root.rstrip('/')}/{name}", schema, keys, load, every)

        self.rules = table("rules", RULE, RULE_KEY, rules)
        self.objects = table("objects", OBJECT, ["object_id"], objects)
        self.models = table("models", MODEL, ["model_id"], models)
        self._batch: int | None = None
        self._set: RuleSet | None = None

    def _children_changed(self, rs: RuleSet, rows: DataFrame, objects: DataFrame, models: DataFrame) -> DataFrame:
        """Roll-ups whose children are no longer those of the rule set."""
        rollups = active_rules(rows).where((F.col("expr_type") == 1) & F.col("expr").isin(*ROLLUPS))
        child = [*RULE_KEY, "dep_device_code", "dep_point_code"]
        now = rollup_dependencies(rollups, objects, models).select(*child)
        then = rs.deps.join(rollups.select(*RULE_KEY), RULE_KEY, "left_semi").select(*child)
        count = now.withColumn("_n", F.lit(1)).unionByName(then.withColumn("_n", F.lit(-1))).groupBy(*child).agg(F.sum("_n").alias("_n"))
        return count.where(F.col("_n") != 0).select(*RULE_KEY)

    def at(self, batch_id: int) -> RuleSet:
        """The rule set of a batch; batches come one after another, the last one possibly again."""
        tables = [t for t in (self.rules, self.objects, self.models) if t]
        changes = {id(t): t.pin(batch_id) for t in tables}
        if self._set is not None and self._batch == batch_id:
            return self._set
        rows = self.rules.rows(batch_id)
        objects, models = (t and t.rows(batch_id) for t in (self.objects, self.models))
        if self._set is None or self._batch != batch_id - 1:
            made = prepare_rules(rows, objects, models)
            # what the set holds must outlive the pinned tables' older versions
            made = replace(made, constants=materialize(made.constants))
        else:
            made, changed = self._set, changes[id(self.rules)].select(*RULE_KEY)
            if self.objects and not all(changes[id(t)].isEmpty() for t in tables[1:]):
                changed = changed.unionByName(self._children_changed(made, rows, objects, models))
            changed = materialize(changed.distinct())
            if not changed.isEmpty():
                made = refresh_rules(made, rows, changed, objects, models)
        self._set, self._batch = made, batch_id
        return made
