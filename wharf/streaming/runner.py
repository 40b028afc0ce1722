"""A1/A3: the stream job template as a plain function.

``run_stream(source, transform, sink)``: ``transform`` is the same DataFrame -> DataFrame function the
batch plan uses; the sink gets a ``DataStreamWriter``-building function. Checkpointing is always on,
under ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wharf.config import StreamOptions
from wharf.session import checkpoint_dir


def checkpoint_for(df: DataFrame, name: str, location: str | None = None) -> str:
    return location or f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}"


def with_trigger(w: DataStreamWriter, opts: StreamOptions) -> DataStreamWriter:
    """A3: a fixed interval (5 s by default), or ``availableNow`` to drain what is there and stop."""
    return w.trigger(availableNow=True) if opts.available_now else w.trigger(processingTime=opts.trigger_interval)


def run_stream(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, str], DataStreamWriter],
    name: str,
    opts: StreamOptions = StreamOptions(),
    checkpoint: str | None = None,
) -> StreamingQuery:
    out = transform(source)
    w = sink(out, checkpoint_for(source, name, checkpoint))
    return with_trigger(w, opts).queryName(name).start()
