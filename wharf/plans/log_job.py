"""The log-split job as one batch plan: ``read -> classify -> fix_is_new -> split -> write``.

One plan feeds both outputs: bad logs ride along as a ``quarantine`` route (their text kept, their
flag untouched), so routes and quarantine come from the same scan and the same write. The flag repair
is the only shuffle (on ``mid``, salted); the split is a generator in the same stage as the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wharf.config import LogJobOptions
from wharf.operators.logs import (
    LOG,
    ROUTE_RECORD,
    classify_logs,
    fix_is_new,
    log_clean,
    log_quarantine,
    quarantine_records,
    route_records,
    split_log,
    with_event_time,
)


def log_split(raw: DataFrame, opts: LogJobOptions = LogJobOptions(), keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Routed records ``(*keep, route, value)`` of every good log in ``raw``."""
    clean = log_clean(raw)
    if opts.watermark:
        clean = with_event_time(clean, opts.watermark)
    fixed = fix_is_new(clean, rule=opts.rule, flag_type=opts.flag_type, tz=opts.tz)
    return split_log(fixed, keep=keep)


def log_split_all(raw: DataFrame, opts: LogJobOptions = LogJobOptions(), keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Routes and quarantine in one frame ``(*keep, route, value, reason)``: good logs give their five
    routes (``reason`` NULL), a bad log gives one ``quarantine`` record holding its raw text, and a part
    of a good log that no route can take gives one holding the text of the part."""
    c = classify_logs(raw)
    bad = F.col("reason").isNotNull()
    # Only bad logs keep their text through the shuffle; good ones are rebuilt from the parsed log.
    c = c.withColumn("value", F.when(bad, F.col("value")))
    fixed = fix_is_new(c, rule=opts.rule, flag_type=opts.flag_type, tz=opts.tz)

    def record(route: Column, value: Column, reason: Column) -> Column:
        return F.struct(route.alias("route"), value.alias("value"), reason.cast("string").alias("reason"))

    routed = F.when(~bad, route_records(F.col(LOG), F.col("kind"))).otherwise(F.array().cast(ArrayType(ROUTE_RECORD)))
    recs = F.concat(
        F.transform(routed, lambda r: record(r["route"], r["value"], F.lit(None))),
        F.transform(quarantine_records(), lambda r: record(F.lit("quarantine"), r["value"], r["reason"])),
    )
    return fixed.select(*keep, F.inline(recs))


def run_log_split(raw: DataFrame, out_dir: str, opts: LogJobOptions = LogJobOptions()) -> None:
    """Write every route, quarantine included, partitioned by ``route``, in one job."""
    log_split_all(raw, opts, keep=("partition", "offset")).write.mode("overwrite").partitionBy("route").parquet(out_dir)


def run_log_split_kafka(raw: DataFrame, bootstrap_servers: str, out_dir: str, opts: LogJobOptions = LogJobOptions()) -> None:
    """The five routes to their topics, the quarantine to files (two sinks, so the input is read twice)."""
    from wharf.sinks.routed import write_kafka

    write_kafka(log_split(raw, opts, keep=()), bootstrap_servers)
    log_quarantine(raw).write.mode("overwrite").parquet(f"{out_dir}/quarantine")
