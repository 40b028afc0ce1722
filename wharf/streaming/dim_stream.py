"""The dimension-sync job as a stream: one ``foreachBatch`` per micro-batch of change records.

Per batch: take the live config (T5, read anew every batch so that changes take effect), walk the config
changes that came since the last batch through the catalog (K9), parse, route by the config (J1) and trim
(P4) every change once, append what the batch does to each row key (T6) to its table, and quarantine the
rest with its text. Every write is named by the batch and made whole, and a batch reads only what earlier
ones wrote, so a batch that died anywhere and is run again leaves what one run would have left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wharf.config import DimJobOptions, StreamOptions
from wharf.operators.cdc import judge_changes
from wharf.operators.dim import row_effects
from wharf.sinks.dimstore import DimStore, plan_ddl
from wharf.sources.files import with_positions


def dim_sync_batch(
    batch: DataFrame,
    batch_id: int,
    store: DimStore,
    config: Callable[[], DataFrame],
    opts: DimJobOptions = DimJobOptions(),
    cache: bool = False,
    refused: Callable[[], DataFrame] | None = None,
    changes: Callable[[], DataFrame] | None = None,
) -> None:
    """``changes``: the config feed's changes in order (``config_changes``), for the tables' DDL; without a feed,
    the config as a whole is compared with the one noted before. Only changed config rows reach the driver.
    ``cache``: keep the parsed batch between its two writes (a micro-batch is bounded by its trigger; all of a
    batch job's input is not, so that one reads its input twice). ``refused``: the config records that take no
    part (``config_quarantine``), kept as of the last batch under ``_config_refused``."""
    store.attach(batch_id)  # the tables as earlier batches left them, also when this one is run again
    live = config()
    noted = store.new_config_changes(changes(), batch_id) if changes else store.changed_config(live, batch_id)
    store.run_ddl(batch_id, plan_ddl(noted))
    judged = judge_changes(with_positions(batch), live, store.tables(batch_id + 1), opts.database)
    judged = judged.persist() if cache else judged
    try:
        seen = Observation()
        effects = row_effects(judged.where("reason IS NULL"), opts.null_cells)
        store.write_effects(batch_id, effects.observe(seen, F.collect_set("sink_table").alias("tables")), lambda: seen.get.get("tables") or [])
        bad = judged.where("reason IS NOT NULL").select("value", "reason")
        bad.write.mode("overwrite").parquet(f"{store.root}/_quarantine/run={store.run}/batch={batch_id}")
        if refused is not None:
            refused().write.mode("overwrite").parquet(f"{store.root}/_config_refused")
        store.finish(batch_id)
    finally:
        if cache:
            judged.unpersist()


def start_dim_sync(
    changes_stream: DataFrame,
    store: DimStore,
    config: Callable[[], DataFrame],
    checkpoint: str | None = None,
    opts: DimJobOptions = DimJobOptions(),
    available_now: bool = False,
    trigger_interval: str = "5 seconds",
    refused: Callable[[], DataFrame] | None = None,
    changes: Callable[[], DataFrame] | None = None,
):
    """Start the stream; ``checkpoint`` defaults to ``dim_sync`` under ``spark.checkpoint.dir``."""
    from wharf.streaming.runner import run_stream

    def sink(df: DataFrame, ck: str) -> DataStreamWriter:
        w = df.writeStream.foreachBatch(lambda b, i: dim_sync_batch(b, i, store, config, opts, cache=True, refused=refused, changes=changes))
        return w.option("checkpointLocation", ck)

    stream = StreamOptions(trigger_interval=trigger_interval, available_now=available_now)
    return run_stream(changes_stream, lambda df: df, sink, "dim_sync", stream, checkpoint)
