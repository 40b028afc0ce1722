"""The log-split job as a stream: one query, one read of the source, every output per micro-batch.

Per micro-batch: place the lines (S1), classify, repair the flag (T3) against the dates that earlier batches
stored, split, and write

* ``<out>/routes/batch=<id>/route=<name>``: the five routes (or the topics of the ``kafka`` servers),
* ``<out>/quarantine/batch=<id>``: bad logs and the parts of good ones that no route takes,
* ``<state>/devices/batch=<id>``: the dates of devices that this batch met first (``mid, dt, seen``),
* ``<state>/late/batch=<id>``: one row, the batch's late logs and its greatest time.

The state is an append-only table: a batch reads what earlier ones wrote, folded by an aggregate, and adds
its own rows. It is a join and an aggregate like any other, with no Python in the plan, and a device with
very many logs in one batch is spread as in the batch job. Every directory is named by the batch and
written whole, and a batch reads earlier batches only, so a batch that is run again leaves the same files.
A new checkpoint starts at batch 0 and needs an output folder of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.utils import AnalysisException

from wharf.config import LogJobOptions, StreamOptions
from wharf.operators.logs import (
    LOG,
    ROUTE_RECORD,
    classify_logs,
    fix_is_new,
    quarantine_records,
    route_records,
)
from wharf.sources.files import with_positions

DEVICES = "mid string, dt string, seen timestamp, batch bigint"
LATE = "n bigint, late bigint, max_ts bigint, batch bigint"
# Fixed value: the event disorder that the upstream job allows.
DISORDER_MS = 3000
# What a split gives besides routes: a bad part, and the date of a device.
QUARANTINE, DEVICE = "quarantine", "device"


def _written(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """The rows of a table by batch that batches before ``before`` have written."""
    try:
        return spark.read.schema(schema).parquet(path).where(F.col("batch") < before)
    except AnalysisException:  # nothing is written yet
        return spark.createDataFrame([], schema)


def known_devices(spark: SparkSession, state: str, before: int, ttl_ms: int | None = None) -> DataFrame:
    """``mid, dt`` of the devices that earlier batches stored; with a TTL, no longer ago than that."""
    rows = _written(spark, f"{state}/devices", DEVICES, before)
    if ttl_ms:
        rows = rows.where(F.col("seen") > F.current_timestamp() - F.make_interval(secs=F.lit(ttl_ms / 1000)))
    return rows.groupBy("mid").agg(F.min_by("dt", "batch").alias("dt"))


def batch_records(batch: DataFrame, known: DataFrame, opts: LogJobOptions = LogJobOptions(), bound: int | None = None, seen: Observation | None = None) -> DataFrame:
    """Everything that a micro-batch of text gives, as ``partition, offset, route, value, reason``: routes,
    ``quarantine`` records, and a ``device`` record (the device, and its date as reason) for each new date.

    ``seen`` observes the good logs on their way: their number, those older than ``bound`` (the greatest
    time of earlier batches less the disorder), and their greatest time. No log is dropped for its time."""
    c = classify_logs(batch)
    bad = F.col("reason").isNotNull()
    if seen is not None:
        late = F.col("ts") < F.lit(bound) if bound is not None else F.lit(False)
        c = c.observe(
            seen, F.count(F.when(~bad, 1)).alias("n"), F.count(F.when(~bad & late, 1)).alias("late"), F.max(F.when(~bad, F.col("ts"))).alias("max_ts")
        )
    # only bad logs keep their text; good ones are rebuilt from the parsed log
    c = c.withColumn("value", F.when(bad, F.col("value")))
    fixed = fix_is_new(c, rule=opts.rule, flag_type=opts.flag_type, tz=opts.tz, known=known)

    def record(route: Column, value: Column, reason: Column) -> Column:
        return F.struct(route.alias("route"), value.alias("value"), reason.cast("string").alias("reason"))

    routed = F.when(~bad, route_records(F.col(LOG), F.col("kind"))).otherwise(F.array().cast(ArrayType(ROUTE_RECORD)))
    none = F.array().cast("array<struct<route:string,value:string,reason:string>>")
    recs = F.concat(
        F.transform(routed, lambda r: record(r["route"], r["value"], F.lit(None))),
        F.transform(quarantine_records(), lambda r: record(F.lit(QUARANTINE), r["value"], r["reason"])),
        F.when(F.col("sets").isNotNull(), F.array(record(F.lit(DEVICE), F.col("mid"), F.col("sets")))).otherwise(none),
    )
    return fixed.select("partition", "offset", F.inline(recs))


def log_split_batch(
    batch: DataFrame,
    batch_id: int,
    out_dir: str,
    state: str,
    opts: LogJobOptions = LogJobOptions(),
    ttl_ms: int | None = None,
    kafka: str | None = None,
) -> None:
    """One micro-batch. Its records are computed once and kept (a micro-batch is bounded by its trigger)
    while they are written to their places."""
    spark = batch.sparkSession
    seen = Observation()
    newest = _written(spark, f"{state}/late", LATE, batch_id).agg(F.max("max_ts")).first()[0]
    bound = None if newest is None else newest - DISORDER_MS
    records = batch_records(with_positions(batch), known_devices(spark, state, batch_id, ttl_ms), opts, bound, seen).persist()
    try:
        routes = records.where(~F.col("route").isin(QUARANTINE, DEVICE)).drop("reason")
        if kafka:
            from wharf.sinks.routed import write_kafka

            write_kafka(routes, kafka)
        else:
            routes.write.mode("overwrite").partitionBy("route").parquet(f"{out_dir}/routes/batch={batch_id}")
        refused = records.where(F.col("route") == QUARANTINE).drop("route")
        refused.write.mode("overwrite").parquet(f"{out_dir}/quarantine/batch={batch_id}")
        new = records.where(F.col("route") == DEVICE).select(F.col("value").alias("mid"), F.col("reason").alias("dt"), F.current_timestamp().alias("seen"))
        new.write.mode("overwrite").parquet(f"{state}/devices/batch={batch_id}")
        told = seen.get
        row = [(told.get("n", 0), told.get("late", 0), told.get("max_ts"))]
        spark.createDataFrame(row, "n bigint, late bigint, max_ts bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/late/batch={batch_id}")
    finally:
        records.unpersist()


def start_log_split(
    raw: DataFrame,
    out_dir: str,
    checkpoint_root: str | None = None,
    opts: LogJobOptions = LogJobOptions(),
    available_now: bool = False,
    trigger_interval: str = "5 seconds",
    ttl_ms: int | None = None,
    kafka: str | None = None,
):
    """Start the stream query; its checkpoint and state lie under ``checkpoint_root`` (default: ``log_split``
    under the session's ``spark.checkpoint.dir``). Kafka output is at-least-once; files are exactly-once."""
    from wharf.streaming.runner import checkpoint_for, run_stream

    root = checkpoint_for(raw, "log_split", checkpoint_root)
    stream = StreamOptions(trigger_interval=trigger_interval, available_now=available_now)

    def sink(df: DataFrame, ck: str):
        work = lambda b, i: log_split_batch(b, i, out_dir, f"{root}/state", opts, ttl_ms, kafka)
        return df.writeStream.foreachBatch(work).option("checkpointLocation", ck)

    return run_stream(raw, lambda df: df, sink, "log_split", stream, f"{root}/query")
