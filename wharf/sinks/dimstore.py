"""Dimension tables (K3-K9): catalog tables over ordinary Parquet, partitioned by the batch that wrote.

There is no MERGE here, so a table holds what each batch did to its row keys (``row_effects``), and readers
fold that (``fold_effects``)::

    <root>/effects/sink_table=<name>/run=<r>/batch=<b>/   row_key, family, cleared, cells
    <root>/ddl/run=<r>/batch=<b>/                         seq, action (create, drop, whole), sink_table, family
    <root>/config/run=<r>/batch=<b>/                      the config changes that the batch took note of

A sink table is the external catalog table ``<namespace>.<name>`` over its directory; create, drop and exists
are the catalog's (K6-K8). A dropped table's rows stay in the files, but its readers begin at the table's
last create. A batch writes directories that bear its name, whole, and reads what earlier batches wrote, so a
batch that is run again leaves the same files. Batches are ordered by (run, batch): a new checkpoint starts
its batch ids anew and takes the next ``run``; one run is at work at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from wharf.config import DIM_NAMESPACE
from wharf.operators.cdc import CONFIG_FIELDS
from wharf.operators.dim import fold_effects, fold_to_effects

EFFECT_SCHEMA = "row_key string, family string, cleared boolean, cells map<string,string>"
DDL_SCHEMA = "seq int, action string, sink_table string, family string, run int, batch bigint"
SEEN_SCHEMA = ", ".join(f"{f} string" for f in CONFIG_FIELDS) + ", op string, o bigint, run int, batch bigint"
DIM_SCHEMA = "sink_table string, row_key string, family string, cells map<string,string>"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class DimStore:
    def __init__(self, spark: SparkSession, root: str, run: int = 0, namespace: str = DIM_NAMESPACE):
        self.spark, self.root, self.run, self.namespace = spark, root.rstrip("/"), run, namespace
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
        self.attach()

    # -- what batches wrote -----------------------------------------------------------------------
    def _rows(self, sub: str, schema: str, before: int | None) -> DataFrame:
        """Rows of all batches, or of those before batch ``before`` of this run."""
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{sub}")
        except AnalysisException:  # nothing is written yet
            return self.spark.createDataFrame([], schema)
        return rows if before is None else rows.where(F.struct("run", "batch") < F.struct(F.lit(self.run), F.lit(before).cast("long")))

    def _write(self, rows: DataFrame, sub: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{sub}/run={self.run}/batch={batch_id}")

    def tables(self, before: int | None = None) -> DataFrame:
        """The tables that are there: ``sink_table, family, since`` (the last create, or whole version)."""
        place = F.struct("run", "batch")
        last = self._rows("ddl", DDL_SCHEMA, before).groupBy("sink_table").agg(
            F.max_by(F.struct("action", "family", place.alias("since")), F.struct("run", "batch", "seq")).alias("l")
        )
        return last.where("l.action <> 'drop'").select("sink_table", "l.family", "l.since")

    def committed(self, batch_id: int) -> bool:
        """Whether this run has finished the batch."""
        return not self._rows("done", "run int, batch bigint", None).where((F.col("run") == self.run) & (F.col("batch") == batch_id)).isEmpty()

    def last_batch(self) -> int:
        """The largest batch id that this run has finished, -1 without any."""
        r = self._rows("done", "run int, batch bigint", None).where(F.col("run") == self.run).agg(F.max("batch")).first()[0]
        return -1 if r is None else int(r)

    def finish(self, batch_id: int) -> None:
        self._write(self.spark.createDataFrame([(batch_id,)], "id bigint").coalesce(1), "done", batch_id)

    # -- K8, K6, K7: the catalog ----------------------------------------------------------------------
    def name(self, sink_table: str) -> str:
        return f"`{self.namespace}`.`{sink_table}`"

    def table_exists(self, sink_table: str) -> bool:
        """K8: a table of that name is in the catalog, and it is this store's."""
        if not self.spark.catalog.tableExists(f"{self.namespace}.{sink_table}"):
            return False
        own = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(sink_table)}").where("key = 'store'").first()
        return own is not None and own["value"] == self.root

    def create_table(self, sink_table: str, family: str | None) -> bool:
        """K6: an empty table, if absent; no family means no table. True if created."""
        if not family or self.table_exists(sink_table):
            return False
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(sink_table)}")  # another store's; its files stay
        self.spark.sql(
            f"CREATE TABLE {self.name(sink_table)} ({EFFECT_SCHEMA}, run int, batch bigint) USING parquet PARTITIONED BY (run, batch) "
            f"LOCATION {_text(self.root + '/effects/sink_table=' + sink_table)} TBLPROPERTIES ('store' = {_text(self.root)}, 'family' = {_text(family)})"
        )
        return True

    def drop_table(self, sink_table: str) -> bool:
        """K7: drop a table if it is there (dropping an absent one is a no-op, not an error)."""
        if not self.table_exists(sink_table):
            return False
        self.spark.sql(f"DROP TABLE {self.name(sink_table)}")
        return True

    def attach(self, before: int | None = None) -> None:
        """Make the catalog agree with the store, as all batches (or those before one) left it: a session
        whose catalog does not outlive it, or a batch that is run again, finds its tables."""
        there = {r["sink_table"]: r["family"] for r in self.tables(before).collect()}
        for t in self._rows("ddl", DDL_SCHEMA, None).select("sink_table").distinct().collect():
            if t[0] not in there:
                self.drop_table(t[0])
        for t, family in there.items():
            if self.create_table(t, family):
                self.spark.sql(f"ALTER TABLE {self.name(t)} RECOVER PARTITIONS")

    # -- K9 ---------------------------------------------------------------------------------------
    def run_ddl(self, batch_id: int, actions: list[tuple[str, str, str | None]]) -> None:
        """Apply ``(action, sink_table, family)`` in order to the catalog and keep those that did something."""
        done = []
        for action, table, family in actions:
            if self.drop_table(table) if action == "drop" else self.create_table(table, family):
                done.append((len(done), action, table, family))
        self._write(self.spark.createDataFrame(done, "seq int, action string, sink_table string, family string").coalesce(1), "ddl", batch_id)

    def new_config_changes(self, changes: DataFrame, batch_id: int) -> list[dict]:
        """The config changes (:func:`wharf.operators.cdc.config_changes`) that no earlier batch took note of,
        in order; they are noted under this batch. A change that comes after a later one of its source table
        has been noted does not count: the later one rules, as in the current config."""
        noted = self._rows("config", SEEN_SCHEMA, batch_id).groupBy("source_table").agg(F.max("o").alias("_noted"))
        new = changes.join(noted, "source_table", "left").where("_noted IS NULL OR o > _noted").drop("_noted").persist()
        try:
            self._write(new.select(*CONFIG_FIELDS, "op", "o"), "config", batch_id)
            return [r.asDict(recursive=True) for r in new.orderBy("o", "source_table").collect()]
        finally:
            new.unpersist()

    def changed_config(self, config: DataFrame, batch_id: int) -> list[dict]:
        """The same from a whole config, where there is no feed: what differs from the config that earlier
        batches noted, row by row, as deletes, creates and updates."""
        noted = self._rows("config", SEEN_SCHEMA, batch_id)
        latest = Window.partitionBy("source_table").orderBy(F.desc("run"), F.desc("batch"))
        old = noted.withColumn("_n", F.row_number().over(latest)).where("_n = 1 AND op <> 'd'")
        rows = lambda d, name: d.select("source_table", F.struct(*CONFIG_FIELDS).alias(name))
        both = rows(old, "before").join(rows(config, "after"), "source_table", "full").where("NOT (before <=> after)")
        op = F.when(F.col("after").isNull(), "d").when(F.col("before").isNull(), "c").otherwise("u")
        new = both.select("source_table", op.alias("op"), "before", "after").persist()
        try:
            image = F.coalesce("after", "before")
            self._write(new.select(*[image[f].alias(f) for f in CONFIG_FIELDS], "op", F.lit(None).cast("long").alias("o")), "config", batch_id)
            return [r.asDict(recursive=True) for r in new.orderBy(F.col("op") != "d", "source_table").collect()]
        finally:
            new.unpersist()

    # -- rows -------------------------------------------------------------------------------------
    def write_effects(self, batch_id: int, effects: DataFrame, tables: Callable[[], list[str]]) -> None:
        """A batch's effects, one directory per table, in one write; then the partitions of ``tables`` (those that
        got any) are named to the catalog."""
        # the effects are hash-clustered by (sink_table, row_key) already: no extra shuffle
        rows = effects.select("row_key", "family", "cleared", "cells", "sink_table", F.lit(self.run).alias("run"), F.lit(batch_id).cast("long").alias("batch"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sink_table", "run", "batch").parquet(f"{self.root}/effects")
        for t in tables():
            if self.table_exists(t):
                self.spark.sql(f"ALTER TABLE {self.name(t)} ADD IF NOT EXISTS PARTITION (run = {self.run}, batch = {batch_id})")

    def effects(self, sink_tables: list[str]) -> DataFrame:
        """What counts of the tables' effects: all since their last create."""
        found = self.spark.createDataFrame([], f"sink_table string, {EFFECT_SCHEMA}, run int, batch bigint")
        for r in self.tables().where(F.col("sink_table").isin(sink_tables)).collect():
            if self.table_exists(r["sink_table"]):
                run, batch = r["since"]
                rows = self.spark.table(self.name(r["sink_table"])).where(f"run > {run} OR (run = {run} AND batch >= {batch})")
                found = found.unionByName(rows.withColumn("sink_table", F.lit(r["sink_table"])))
        return found.withColumn("n", F.struct("run", "batch"))

    def snapshot(self, sink_tables: list[str]) -> DataFrame:
        """The current rows ``sink_table, row_key, family, cells`` of the named tables (none of absent ones)."""
        return fold_effects(self.effects(sink_tables))

    def read_table(self, sink_table: str) -> DataFrame:
        return self.snapshot([sink_table])

    def compact(self) -> list[str]:
        """Write a whole version of every table with more than one batch since its last; their names. A job of
        its own, while no stream runs. A version takes the place of its last batch and keeps the row keys that
        were cleared, so readers get the same rows before and after the ``whole`` entry that lets them begin
        there."""
        names = [r[0] for r in self.tables().select("sink_table").collect()]
        held = self.effects(names).groupBy("sink_table").agg(F.count_distinct("n").alias("c"), F.max("n").alias("last"))
        many = {r["sink_table"]: r["last"] for r in held.where("c > 1").collect()}
        for t, (run, batch) in sorted(many.items()):
            rows = fold_to_effects(self.effects([t])).select("row_key", "family", F.lit(True).alias("cleared"), "cells")
            place = f"run={run}/batch={batch}"
            rows.write.mode("overwrite").parquet(f"{self.root}/whole/sink_table={t}/{place}")  # apart from what is being read
            whole = self.spark.read.parquet(f"{self.root}/whole/sink_table={t}/{place}")
            whole.write.mode("overwrite").parquet(f"{self.root}/effects/sink_table={t}/{place}")
            entry = [(1 << 30, "whole", t, self.tables().where(F.col("sink_table") == t).first()["family"])]
            entry = self.spark.createDataFrame(entry, "seq int, action string, sink_table string, family string").coalesce(1)
            entry.write.mode("append").parquet(f"{self.root}/ddl/{place}")
            self.spark.sql(f"REFRESH TABLE {self.name(t)}")
        return sorted(many)


def plan_ddl(changes: list[dict]) -> list[tuple[str, str, str | None]]:
    """K9: what config changes ``{op, before, after}``, in order, ask for: ``[(action, sink_table, family)]``.

    ``d`` drops the table of ``before``; ``c`` and ``r`` create that of ``after``; anything else (D9) drops the
    tables of both and creates that of ``after``, so its rows are lost. Creating needs a family (K6)."""
    out: list[tuple[str, str, str | None]] = []
    for change in changes:
        before, after = change["before"] or {}, change["after"] or {}
        old, new = before.get("sink_table"), after.get("sink_table")
        family = (after.get("sink_family") or "").strip() or None
        if change["op"] not in ("c", "r"):
            out += [("drop", t, None) for t in dict.fromkeys([old, new]) if t and not (change["op"] == "d" and t != old)]
        if change["op"] != "d" and new:
            out.append(("create", new, family))
    return out
