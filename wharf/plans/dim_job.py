"""The dimension-sync job as one batch plan: ``cdc_clean -> route -> trim -> apply_changes``.

One scan of the change records; the config, a row per source table, is broadcast; one keyed
aggregation pair applies the changes. With a store, the result becomes the tables' next version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wharf.config import DimJobOptions
from wharf.operators.cdc import cdc_clean, dim_changes, route, trim
from wharf.operators.dim import apply_changes


def dim_sync(raw: DataFrame, config: DataFrame, opts: DimJobOptions = DimJobOptions(), base: DataFrame | None = None) -> DataFrame:
    """Dimension rows ``(sink_table, row_key, family, cells)`` after applying ``raw`` change records
    (routed by the live ``config``) on top of ``base``."""
    t = trim(route(cdc_clean(raw, opts.database), config))
    return apply_changes(dim_changes(t), base=base, null_cells=opts.null_cells)


def run_dim_sync(raw: DataFrame, config: DataFrame, store, batch_id: int, opts: DimJobOptions = DimJobOptions()) -> None:
    """Batch run against a :class:`wharf.sinks.dimstore.DimStore`: same steps as one stream batch."""
    from wharf.streaming.dim_stream import dim_sync_batch

    dim_sync_batch(raw, batch_id, store, lambda: config, opts)
