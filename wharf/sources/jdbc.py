"""JDBC reads through Spark's JDBC source.

Connection settings come from arguments (or the caller's environment), never from code. Reads are
partitioned when a numeric column and bounds are given, so a large table is not pulled by one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """S3: a query or a table over JDBC as a DataFrame (``query`` and ``dbtable`` are exclusive)."""
    if (query is None) == (dbtable is None):
        raise ValueError("give exactly one of query or dbtable")
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("query", query) if query is not None else r.option("dbtable", dbtable)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column:
        if query is not None:
            raise ValueError("partitioned reads need dbtable (Spark's JDBC source rule)")
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def snake_to_camel(name: str) -> str:
    """``sink_row_key`` -> ``sinkRowKey`` (lower camel)."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """F9, opt-in: rename every snake_case column to lower camel case (schema work, no data pass)."""
    return df.withColumnsRenamed({c: snake_to_camel(c) for c in df.columns if re.search(r"_[a-z0-9]", c)})


def register_jdbc_view(spark: SparkSession, name: str, url: str, dbtable: str, **kw) -> DataFrame:
    """A JDBC table as a temp view (``select * from base_dic`` then runs on Spark SQL)."""
    df = read_jdbc(spark, url, dbtable=dbtable, **kw)
    df.createOrReplaceTempView(name)
    return df


def read_config_snapshot(spark: SparkSession, url: str, table: str = "table_process_dim", **kw) -> DataFrame:
    """The config table snapshot, to pass as ``preload`` to ``current_config``."""
    return read_jdbc(
        spark, url,
        query=f"SELECT source_table, sink_table, sink_family, sink_columns, sink_row_key FROM {table}",
        **kw,
    )
