"""Job entry points (A1), for ``spark-submit --py-files wharf.zip -m wharf <job> ...`` or
``python -m wharf <job> ...``.

    log-split   --input DIR --output DIR [--kafka-out SERVERS]     batch: routes + quarantine
    dim-sync    --input DIR --config DIR --store DIR --batch-id N [--preload FILE]
    dim-compact --store DIR                                        whole versions of the tables
    sql         --input DIR --sql FILE --output DIR                a query over the topic view
    log-stream  --input DIR --output DIR --checkpoint DIR [--kafka-out SERVERS] [--ttl-hours N] [--available-now]
    dim-stream  --input DIR --config DIR --store DIR --checkpoint DIR [--available-now]

Inputs are text files with one JSON record per line (``--kafka SERVERS --topic T`` reads Kafka
instead). Settings not given here come from the session (``spark.checkpoint.dir`` and the rest).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wharf.config import DimJobOptions, LogJobOptions, StreamOptions
from wharf.session import job_session


def _source(spark: SparkSession, a: argparse.Namespace, stream: bool):
    if a.kafka:
        from wharf.sources.kafka import kafka_text

        return kafka_text(spark, a.kafka, a.topic, stream=stream, max_offsets_per_trigger=a.max_offsets)
    from wharf.sources.files import text_records

    return text_records(spark, a.input, stream=stream, max_files_per_trigger=a.max_files)


def _config(spark: SparkSession, a: argparse.Namespace):
    """The live config and its changes, read anew at each call: the change feed over the snapshot taken at the start."""
    from wharf.operators.cdc import CONFIG_FIELDS, config_changes, current_config, parse_config
    from wharf.sources.jdbc import read_config_snapshot
    from wharf.sources.kafka import config_change_feed

    feed = lambda: config_change_feed(spark, a.config)
    snapshot = None
    if a.preload_jdbc:
        snapshot = read_config_snapshot(spark, a.preload_jdbc, a.preload_table)
    elif a.preload:
        snapshot = spark.read.schema(", ".join(f"{f} string" for f in CONFIG_FIELDS)).json(a.preload)
    return lambda: current_config(parse_config(feed()), preload=snapshot), lambda: config_changes(feed(), snapshot)


def _refused(spark: SparkSession, a: argparse.Namespace):
    from wharf.operators.cdc import config_quarantine
    from wharf.sources.kafka import config_change_feed

    return lambda: config_quarantine(config_change_feed(spark, a.config))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="wharf")
    p.add_argument("job", choices=["log-split", "dim-sync", "dim-compact", "sql", "log-stream", "dim-stream"])
    p.add_argument("--input")
    p.add_argument("--kafka")
    p.add_argument("--topic")
    p.add_argument("--output")
    p.add_argument("--config")
    p.add_argument("--store")
    p.add_argument("--checkpoint")
    p.add_argument("--batch-id", type=int, default=0)
    p.add_argument("--run", type=int, default=0, help="number that batch ids belong to; a new checkpoint needs the next one")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-files", type=int, help="files of a micro-batch")
    p.add_argument("--max-offsets", type=int, default=1_000_000, help="Kafka records of a micro-batch")
    p.add_argument("--trigger", default=StreamOptions.trigger_interval)
    p.add_argument("--ttl-hours", type=float, help="forget a device's first date after this time")
    p.add_argument("--watermark", help="assigned only; no row is dropped")
    p.add_argument("--kafka-out", help="servers for the five routes; the quarantine goes to --output")
    p.add_argument("--preload", help="config snapshot, JSON lines")
    p.add_argument("--preload-jdbc", help="config snapshot, JDBC URL")
    p.add_argument("--preload-table", default="table_process_dim")
    p.add_argument("--sql", help="file with the query of the sql job")
    p.add_argument("--tz", default=LogJobOptions.tz)
    p.add_argument("--rule", default=LogJobOptions.rule, choices=["later_day", "same_day"])
    p.add_argument("--flag-type", default=LogJobOptions.flag_type, choices=["string", "int"])
    p.add_argument("--database", default=DimJobOptions.database)
    p.add_argument("--null-cells", default=DimJobOptions.null_cells, choices=["keep_old", "overwrite"])
    a = p.parse_args(argv)

    spark = job_session(f"wharf-{a.job}")
    log_opts = LogJobOptions(tz=a.tz, rule=a.rule, flag_type=a.flag_type, watermark=a.watermark)
    dim_opts = DimJobOptions(database=a.database, null_cells=a.null_cells)

    if a.job == "log-split":
        from wharf.plans.log_job import run_log_split, run_log_split_kafka

        raw = _source(spark, a, stream=False)
        if a.kafka_out:
            run_log_split_kafka(raw, a.kafka_out, a.output, log_opts)
        else:
            run_log_split(raw, a.output, log_opts)
    elif a.job == "sql":
        from wharf.plans.sql_job import run_sql_job

        with open(a.sql) as fh:
            query = fh.read()
        run_sql_job(spark, _source(spark, a, stream=False), lambda s: s.sql(query)).write.mode("overwrite").parquet(a.output)
    elif a.job == "dim-compact":
        from wharf.sinks.dimstore import DimStore

        DimStore(spark, a.store).compact()
    elif a.job == "dim-sync":
        from wharf.sinks.dimstore import DimStore
        from wharf.streaming.dim_stream import dim_sync_batch

        store = DimStore(spark, a.store, run=a.run)
        if store.last_batch() >= a.batch_id:
            p.error(f"run {a.run} has finished batch {store.last_batch()}; --batch-id must be greater")
        live, changes = _config(spark, a)
        dim_sync_batch(_source(spark, a, stream=False), a.batch_id, store, live, dim_opts, refused=_refused(spark, a), changes=changes)
    elif a.job == "log-stream":
        from wharf.streaming.log_stream import start_log_split

        ttl = int(a.ttl_hours * 3_600_000) if a.ttl_hours else None
        q = start_log_split(
            _source(spark, a, stream=True), a.output, a.checkpoint, log_opts,
            available_now=a.available_now, trigger_interval=a.trigger, ttl_ms=ttl, kafka=a.kafka_out,
        )
        q.awaitTermination()
    else:
        from wharf.sinks.dimstore import DimStore
        from wharf.streaming.dim_stream import start_dim_sync

        live, changes = _config(spark, a)
        q = start_dim_sync(
            _source(spark, a, stream=True), DimStore(spark, a.store, run=a.run), live, a.checkpoint,
            dim_opts, available_now=a.available_now, trigger_interval=a.trigger, refused=_refused(spark, a), changes=changes,
        )
        q.awaitTermination()


if __name__ == "__main__":
    main()
