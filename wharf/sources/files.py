"""S1 over files, and table reads.

``spread`` gives CPU-heavy steps (JSON parse and write) every core when an input arrives in fewer
splits than the cluster has task slots, which happens with a few large row groups. On a big input
(many splits) it is a no-op and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Round-robin to the default parallelism when the input has fewer partitions than that."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.parquet(path))


# The line's position is known only where a task reads the file: streams carry the place of its split instead.
SPLIT = "_split"


def with_positions(batch: DataFrame) -> DataFrame:
    """A micro-batch of :func:`text_records` with ``offset``, the line's position in its file, as the batch
    read gives it. Call it on the micro-batch itself, before any shuffle. Other frames stay as they are."""
    if SPLIT not in batch.columns:
        return batch
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return batch.select("value", "partition", (F.col(SPLIT) + line).alias("offset"))


def text_records(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files, one record per line, as ``(value, partition, offset)``.

    ``partition`` is a hash of the file path; ``offset`` is the line's position in its file: the split's
    start, then the line's number in the task (splits of a megabyte or more; a retried task reads the same
    lines in the same order). A stream has no line numbers until a micro-batch is there: it has the
    split's place (``_split``) instead, and :func:`with_positions` gives the micro-batch its ``offset``.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.format("text").load(path)
    split = F.shiftleft(F.shiftright(F.col("_metadata.file_block_start"), 20), 33)
    partition = F.pmod(F.hash(F.col("_metadata.file_path")), F.lit(2**31 - 1))
    placed = df.select(F.col("value"), partition.alias("partition"), split.alias(SPLIT))
    return placed if stream else with_positions(placed)
