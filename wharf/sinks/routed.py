"""Write the five routes (or any ``(route, value)`` frame) to their topics or files.

One query carries every route; the topic is a per-row column, so five outputs cost one scan and one
write. Kafka is at-least-once in Spark (D13); the file sink is exactly-once through its commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wharf.config import ROUTE_TOPICS


def with_topic(routed: DataFrame, topics: dict[str, str] = ROUTE_TOPICS) -> DataFrame:
    """Add ``topic`` from ``route`` with a literal map (no join)."""
    kv = []
    for k, v in topics.items():
        kv += [F.lit(k), F.lit(v)]
    return routed.withColumn("topic", F.create_map(*kv)[F.col("route")])


def kafka_frame(routed: DataFrame, key_col: str | None = None) -> DataFrame:
    """The ``(topic, key, value)`` frame Spark's Kafka sink writes; value only unless a key is given. Routes
    without a topic (``quarantine``) are not for Kafka; the jobs write them to files."""
    t = with_topic(routed).where("topic IS NOT NULL")
    cols = [F.col("topic"), F.col("value").cast("string").alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    return t.select(*cols)


def write_kafka(routed: DataFrame, bootstrap_servers: str, key_col: str | None = None, **options: str) -> None:
    """K1/K2, batch form."""
    w = kafka_frame(routed, key_col).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def stream_kafka(routed: DataFrame, bootstrap_servers: str, checkpoint: str, key_col: str | None = None) -> DataStreamWriter:
    """K1/K2, stream form (at-least-once)."""
    return (
        kafka_frame(routed, key_col).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("checkpointLocation", checkpoint)
    )


def write_routes_files(routed: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2, file form: one directory per route (``route=<name>``)."""
    routed.write.mode("append").partitionBy("route").format(fmt).save(path)


def stream_routes_files(routed: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """K2, exactly-once file sink partitioned by route."""
    return (
        routed.writeStream.format(fmt).partitionBy("route")
        .option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    )


def print_routes(routed: DataFrame, n: int = 20) -> None:
    """Labelled console output, ``route> value``."""
    routed.select(F.concat_ws("> ", "route", "value").alias("out")).show(n, truncate=False)


def stream_console(routed: DataFrame, checkpoint: str) -> DataStreamWriter:
    """K10, stream form."""
    return (
        routed.select(F.concat_ws("> ", "route", "value").alias("out"))
        .writeStream.format("console").option("truncate", "false").option("checkpointLocation", checkpoint)
    )
