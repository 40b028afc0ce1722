"""A2: the SQL job template. Register ``topic_db`` over the change records, then hand the session to
``handle``, which returns the DataFrame of its SQL (batch or streaming, the same text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wharf.sources.topic import comment_filter_sql, register_topic_db


def run_sql_job(spark: SparkSession, raw: DataFrame, handle: Callable[[SparkSession], DataFrame], view: str = "topic_db") -> DataFrame:
    register_topic_db(raw, view)
    return handle(spark)


def comment_info(spark: SparkSession, raw: DataFrame, database: str = "gmall") -> DataFrame:
    """P5 as a job: comments of the source database from the change topic."""
    return run_sql_job(spark, raw, lambda s: s.sql(comment_filter_sql(database)))
