"""The ``topic_db`` SQL table over the change topic, with ``proc_time``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions.jsonx import get_long, get_string

# Fixed value: the declared schema of the SQL table (built in code, so no DDL text can be malformed).
TOPIC_DB_SCHEMA = "database string, table string, ts bigint, data map<string,string>"
# What the text is parsed to first: values keep their digits, and ``ts`` may be a number or its text.
_PARSED = "database string, table string, ts variant, data map<string,variant>"


def topic_db_frame(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Text records -> ``(database, table, ts, data, proc_time)``; unparseable text gives NULL fields.

    The parse sits behind a one-row generator, so a SQL filter on the view is not copied into (and
    pushed below) the parse: each record is parsed once, after any re-partitioning of the input.
    """
    rec = F.from_json(F.col(value_col), _PARSED)
    parsed = raw.select(F.inline(F.array(F.struct(rec.alias("r")))))
    return parsed.select(
        "r.database", "r.table", get_long(F.col("r.ts")).alias("ts"),
        F.transform_values("r.data", lambda _k, v: get_string(v)).alias("data"),
        F.current_timestamp().alias("proc_time"),
    )


def register_topic_db(raw: DataFrame, name: str = "topic_db") -> DataFrame:
    """Register the view for ``spark.sql`` (batch or streaming source alike) and return it."""
    df = topic_db_frame(raw)
    df.createOrReplaceTempView(name)
    return df


def comment_filter_sql(database: str = "gmall", table: str = "comment_info", view: str = "topic_db") -> str:
    """P5: the continuous filter query of the SQL job."""
    return f"SELECT * FROM {view} WHERE `database` = '{database}' AND `table` = '{table}'"
