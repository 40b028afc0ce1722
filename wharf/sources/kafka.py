"""Kafka topics as text records ``(value, partition, offset)`` (the connector jar must be on the
classpath; it is not bundled here). A null or empty value becomes ``""``, which the clean steps then
reject as unparseable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_text(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    stream: bool = True,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """``min_partitions`` splits large topic partitions into more Spark tasks (Kafka's own partition
    count often is lower than the task slots of a big cluster)."""
    reader = spark.readStream if stream else spark.read
    r = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load()
    return df.select(
        F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def config_change_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S2, re-aimed: change-event JSON of the config table (one object per line) from files; the
    same records can come from a Kafka topic through :func:`kafka_text`. File lines carry no offset,
    so the change-event time ``ts_ms`` (present in Debezium events) orders them."""
    from wharf.sources.files import text_records

    df = text_records(spark, path, stream=stream)
    return df.withColumn("offset", F.get_json_object("value", "$.ts_ms").cast("bigint"))
