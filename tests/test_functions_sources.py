"""Date functions (F1-F7), JDBC rename (F9), topic view (S4/P5), routed sinks."""

from pyspark.sql import functions as F

from wharf.functions import dates as D
from wharf.sinks.routed import kafka_frame, with_topic
from wharf.sources.jdbc import camel_columns, snake_to_camel
from wharf.sources.topic import comment_filter_sql, register_topic_db


def test_dates_fixed_zone_and_session_zone_free(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.range(1).select(
            D.date_time_to_ts(F.lit("2023-07-05 01:01:01")).alias("f1"),
            D.ts_to_date(F.lit(1688490061000)).alias("f2"),
            D.ts_to_date_time(F.lit(1688490061000)).alias("f3"),
            D.ts_to_date_for_partition(F.lit(1688490061000)).alias("f4"),
            D.date_to_ts(F.lit("2023-07-05")).alias("f5"),
            D.prev_day(F.lit(1688490061000)).alias("f6"),
            D.date_time_to_ts(F.lit("bad")).alias("bad"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert r.f1 == 1688490061000
    assert (r.f2, r.f3, r.f4, r.f6) == ("2023-07-05", "2023-07-05 01:01:01", "20230705", "2023-07-04")
    assert r.f5 == 1688486400000 and r.bad is None


def test_snake_to_camel(spark):
    assert snake_to_camel("sink_row_key") == "sinkRowKey"
    df = spark.createDataFrame([("a", "b")], "source_table string, op string")
    assert camel_columns(df).columns == ["sourceTable", "op"]


def test_topic_view_filter(spark):
    vals = [
        '{"database":"gmall","table":"comment_info","ts":5,"data":{"id":1,"appraise":"F"}}',
        '{"database":"gmall","table":"order_info","ts":6,"data":{"id":2}}',
        '{"database":"x","table":"comment_info","ts":7,"data":{"id":3}}',
    ]
    register_topic_db(spark.createDataFrame([(v,) for v in vals], "value string"))
    rows = spark.sql(comment_filter_sql()).collect()
    assert [(r.ts, r.data["id"]) for r in rows] == [(5, "1")]
    assert "proc_time" in spark.table("topic_db").columns


def test_routed_topics(spark):
    df = spark.createDataFrame([("page", "{}"), ("err", "{}"), ("display", "{}")], "route string, value string")
    topics = {r.route: r.topic for r in with_topic(df).collect()}
    assert topics == {"page": "dwd_traffic_page", "err": "dwd_traffic_err", "display": "dwd_traffic_display"}
    assert kafka_frame(df).columns == ["topic", "value"]


def test_dates_in_a_dst_gap_of_the_session_zone(spark):
    # 2024-03-10 02:30:00 does not exist in New York; at +08:00 it is an ordinary wall time.
    ms = 1710009000000  # 2024-03-10 02:30:00 +08:00
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.range(1).select(
            D.ts_to_date_time(F.lit(ms)).alias("s"),
            D.date_time_to_ts(F.lit("2024-03-10 02:30:00")).alias("back"),
            D.epoch_ms_of(F.lit("2024-07-01 12:00:00.123456").cast("timestamp_ntz")).alias("e"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert r.s == "2024-03-10 02:30:00" and r.back == ms
    assert r.e == 1719835200123


def test_jdbc_argument_rules(spark):
    """S3/S5 need a database to run (none may be started here); the argument rules are checked."""
    import pytest

    from wharf.sources.jdbc import read_jdbc

    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", query="select 1", dbtable="t")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", query="select 1", partition_column="id", lower_bound=0, upper_bound=9)
