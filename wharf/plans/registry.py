"""Queries over the warehouse tables, one per operator, each checked against a SQL oracle.

Every query builds the wire-format records from the given tables (``wharf.sources.envelopes``), runs
the operators, and returns extracted columns (never JSON text: key order and number text are free).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.functions.jsonx import get_long, get_string, parse_object
from wharf.operators.logs import LOG, fix_is_new, late_by_hour, log_clean, log_quarantine, split_log
from wharf.operators.cdc import (
    cdc_clean,
    cdc_quarantine,
    current_config,
    dim_changes,
    dim_quarantine,
    parse_config,
    route,
    route_by_batch,
    trim,
)
from wharf.operators.dim import apply_changes, fold_effects, row_effects, unpivot_cells
from wharf.operators.lookup import lookup_dictionary
from wharf.sources.files import read_table
from wharf.sources.envelopes import config_feed, log_envelope, null_log_envelope, topic_db_envelope
from wharf.sources.topic import comment_filter_sql, register_topic_db


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_envelope(table(spark, sf_dir, "events"))


def q_log_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = log_clean(_logs(spark, sf_dir))
    log = F.col(LOG)
    return c.select(
        F.col("offset").alias("event_id"),
        "mid",
        "ts",
        get_string(log["common"], "$.is_new").alias("is_new"),
        "kind",
    )


def q_log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_quarantine(_logs(spark, sf_dir)).select(F.col("offset").alias("event_id"), "reason")


def _fix(rule: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from wharf.functions.dates import ts_to_date

        f = fix_is_new(log_clean(_logs(spark, sf_dir)), rule=rule)
        return f.select(
            F.col("offset").alias("event_id"),
            "mid",
            ts_to_date("ts").alias("dt"),
            get_string(F.col(LOG)["common"], "$.is_new").alias("is_new"),
        )

    return q


def q_fix_is_new_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with ``flag_type="int"``: a repaired flag is the number 0, the others stay text."""
    f = fix_is_new(log_clean(_logs(spark, sf_dir)), flag_type="int")
    flag = F.try_variant_get(F.col(LOG)["common"], "$.is_new", "variant")
    return f.select(
        F.col("offset").alias("event_id"),
        get_string(F.col(LOG)["common"], "$.is_new").alias("is_new"),
        F.coalesce(F.schema_of_variant(flag) == "BIGINT", F.lit(False)).alias("is_number"),
    )


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_log(fix_is_new(log_clean(_logs(spark, sf_dir))), keep=["offset"])


def q_split_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routes(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def _route(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = _routes(spark, sf_dir).where(F.col("route") == name)
    return r.select(F.col("offset").alias("event_id"), parse_object("value").alias("rec"))


def _keys(rec) -> F.Column:
    return F.array_join(F.array_sort(F.map_keys(rec)), ",")


def q_split_err(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec")
    return _route(spark, sf_dir, "err").select("event_id", get_long(rec["code"]).alias("code"), _keys(rec).alias("keys"))


def q_split_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec")
    return _route(spark, sf_dir, "start").select(
        "event_id",
        get_string(rec["common"], "$.mid").alias("mid"),
        get_long(rec["ts"]).alias("ts"),
        get_string(rec["common"], "$.is_new").alias("is_new"),
        get_string(rec["start"], "$.entry").alias("entry"),
        _keys(rec).alias("keys"),
    )


def q_split_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec")
    return _route(spark, sf_dir, "page").select(
        "event_id",
        get_string(rec["common"], "$.mid").alias("mid"),
        get_long(rec["ts"]).alias("ts"),
        get_string(rec["common"], "$.is_new").alias("is_new"),
        get_string(rec["page"], "$.page_id").alias("page_id"),
        _keys(rec).alias("keys"),
    )


def q_split_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec")
    return _route(spark, sf_dir, "display").select(
        "event_id",
        get_string(rec["common"], "$.mid").alias("mid"),
        get_long(rec["ts"]).alias("ts"),
        get_string(rec["common"], "$.is_new").alias("is_new"),
        get_string(rec["page"], "$.page_id").alias("page_id"),
        get_long(rec["item"]).alias("item"),
        get_long(rec["pos"]).alias("pos"),
    )


def q_split_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec")
    return _route(spark, sf_dir, "action").select(
        "event_id",
        get_string(rec["common"], "$.mid").alias("mid"),
        get_long(rec["ts"]).alias("ts"),
        get_string(rec["page"], "$.page_id").alias("page_id"),
        get_string(rec["action_id"]).alias("action_id"),
        get_long(rec["item"]).alias("item"),
    )


def q_log_job_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job (one plan for routes and quarantine), records per route."""
    from wharf.plans.log_job import log_split_all

    return log_split_all(_logs(spark, sf_dir)).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def q_log_job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job, every record's body: what each route says of its log, and the text of odd parts."""
    from wharf.plans.log_job import log_split_all

    rows = log_split_all(_logs(spark, sf_dir)).select("offset", "route", "value", "reason", F.inline(F.array(F.struct(parse_object("value").alias("rec")))))
    rec, page, common = F.col("rec"), F.col("rec")["page"], F.col("rec")["common"]
    odd = F.col("reason").rlike("not_(object|array)$")
    return rows.select(
        F.col("offset").alias("event_id"), "route", "reason", F.when(odd, F.col("value")).alias("part"),
        *[F.when(F.col("route") != "quarantine", get_string(v, path)).alias(name) for name, v, path in (
            ("mid", common, "$.mid"), ("uid", common, "$.uid"), ("ch", common, "$.ch"), ("is_new", common, "$.is_new"),
            ("page_id", page, "$.page_id"), ("entry", rec["start"], "$.entry"), ("action_id", rec["action_id"], "$"), ("props", rec["props"], "$"),
        )],
        *[F.when(F.col("route") != "quarantine", get_long(rec[name])).alias(name) for name in ("ts", "item", "pos", "code")],
    )


def q_split_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page records of logs with nulls at every depth; what is left of each object, as its keys."""
    logs = log_clean(null_log_envelope(table(spark, sf_dir, "events")))
    rows = split_log(fix_is_new(logs), keep=["offset"]).where("route = 'page'")
    rows = rows.select("offset", F.inline(F.array(F.struct(parse_object("value").alias("rec")))))
    rec = F.col("rec")
    keys = lambda v: _keys(v.try_cast("map<string,variant>"))
    deep = F.try_variant_get(rec["page"], "$.deep", "variant")
    return rows.select(
        F.col("offset").alias("event_id"), keys(rec["common"]).alias("common_keys"), keys(rec["page"]).alias("page_keys"),
        keys(deep).alias("deep_keys"), get_string(rec["page"], "$.list").alias("list"), get_string(rec["note"]).alias("note"),
    )


def q_late_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late logs per hour at the upstream disorder; the counts of all logs show that none is dropped."""
    return late_by_hour(log_clean(_logs(spark, sf_dir)))


LOG_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "log_job_routes": q_log_job_routes,
    "log_job_records": q_log_job_records,
    "split_nulls": q_split_nulls,
    "late_logs": q_late_logs,
    "log_clean": q_log_clean,
    "log_quarantine": q_log_quarantine,
    "fix_is_new_later_day": _fix("later_day"),
    "fix_is_new_same_day": _fix("same_day"),
    "fix_is_new_int": q_fix_is_new_int,
    "split_routes": q_split_routes,
    "split_err": q_split_err,
    "split_start": q_split_start,
    "split_page": q_split_page,
    "split_display": q_split_display,
    "split_action": q_split_action,
}


def _topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_db_envelope(
        table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"),
        table(spark, sf_dir, "nation"), table(spark, sf_dir, "orders"),
    )


def _config(spark: SparkSession) -> DataFrame:
    return current_config(parse_config(config_feed(spark)))


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim(route(cdc_clean(_topic(spark, sf_dir)), _config(spark)))


def q_cdc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_clean(_topic(spark, sf_dir)).select("partition", "offset", F.col("table").alias("table_name"), "type", "ts")


def q_cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_quarantine(_topic(spark, sf_dir)).select("partition", "offset", "reason")


def q_dim_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_quarantine(_trimmed(spark, sf_dir)).select("partition", "offset", "sink_table", "reason")


def q_dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = route(cdc_clean(_topic(spark, sf_dir)), _config(spark))
    return r.select("partition", "offset", F.col("table").alias("table_name"), "sink_table", "sink_columns", "type")


def q_dim_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trimmed(spark, sf_dir)
    return t.select(
        "partition", "offset", "sink_table", "row_key", "change_op", F.explode(F.map_entries("data")).alias("e")
    ).select(
        "partition", "offset", "sink_table", "row_key", "change_op",
        F.col("e.key").alias("column"), get_string(F.col("e.value")).alias("value"),
    )


def _apply(null_cells: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return unpivot_cells(apply_changes(dim_changes(_trimmed(spark, sf_dir)), null_cells=null_cells))

    return q


# Seconds of the change records: their first half is written up to here (loads and updates), the deletes
# and second inserts come after it.
FIRST_HALF = 1704067201


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = dim_changes(_trimmed(spark, sf_dir))
    return t.where(F.col("ts") <= FIRST_HALF), t.where(F.col("ts") > FIRST_HALF)


def q_dim_apply_on_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 over a table: the second half of the changes applied to what the first half built."""
    first, second = _halves(spark, sf_dir)
    out = apply_changes(second, base=apply_changes(first))
    return out.select("family", "sink_table", "row_key", F.explode(F.map_entries("cells")).alias("e")).select(
        "family", "sink_table", "row_key", F.col("e.key").alias("column"), F.col("e.value").alias("value")
    )


def _by_batches(null_cells: str) -> Callable[[SparkSession, str], DataFrame]:
    """K3-K5 as the store keeps them: each batch's effects on its row keys, folded in order."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, second = (row_effects(h, null_cells).withColumn("n", F.lit(i)) for i, h in enumerate(_halves(spark, sf_dir)))
        return unpivot_cells(fold_effects(first.unionByName(second)))

    return q


def q_dim_route_preload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing by a snapshot that ``region`` derives (one row per region names the supplier's or another
    table) under a feed that knows ``part`` alone."""
    name = F.when(F.col("r_regionkey") == 0, F.lit("supplier")).otherwise(F.concat(F.lit("t_"), F.lower("r_name")))
    snapshot = table(spark, sf_dir, "region").select(
        name.alias("source_table"), F.concat(F.lit("dim_"), name).alias("sink_table"), F.lit("info").alias("sink_family"),
        F.lit("s_suppkey,s_name").alias("sink_columns"), F.lit("s_suppkey").alias("sink_row_key"),
    )
    feed = parse_config(config_feed(spark)).where("source_table = 'part'")
    r = route(cdc_clean(_topic(spark, sf_dir)), current_config(feed, preload=snapshot))
    return r.select("partition", "offset", F.col("table").alias("table_name"), "sink_table", "sink_columns", "type")


# Fixed value: a config change that comes with the second half of the change records.
PART_UPDATE = (
    '{"op":"u","before":{"source_table":"part","sink_table":"dim_part"},"after":{"source_table":"part","sink_table":"dim_part2",'
    '"sink_family":"info","sink_columns":"p_partkey,p_name","sink_row_key":"p_partkey"}}'
)


def q_dim_route_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of change records, cut by time; the config's loads and its create are there in the first,
    its updates and its delete come with the second."""
    feed = config_feed(spark).unionByName(spark.createDataFrame([(PART_UPDATE, 0, 6)], "value string, partition int, offset bigint"))
    feed = parse_config(feed.withColumn("batch", (F.col("offset") >= 4).cast("int")))
    changes = cdc_clean(_topic(spark, sf_dir)).withColumn("batch", (F.col("ts") > FIRST_HALF).cast("int"))
    r = route_by_batch(changes, feed)
    return r.select("partition", "offset", F.col("table").alias("table_name"), "sink_table", "sink_columns", "type", "batch")


def q_cdc_clean_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with the records' ``data``: a row per cell, as text (prices and balances as numbers)."""
    rows = cdc_clean(_topic(spark, sf_dir)).select("partition", "offset", F.explode(F.map_entries("data")).alias("e"))
    amount = F.col("e.key").isin("p_retailprice", "s_acctbal")
    return rows.select(
        "partition", "offset", F.col("e.key").alias("column"), F.when(~amount, get_string(F.col("e.value"))).alias("value"),
        F.when(amount, F.try_variant_get(F.col("e.value"), "$", "double")).alias("amount"),
    )


def q_topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_topic_db(_topic(spark, sf_dir))
    rows = spark.sql(comment_filter_sql())
    return rows.select(
        F.col("database").alias("db_name"), F.col("table").alias("table_name"), "ts",
        F.col("data")["id"].alias("id"), F.col("data")["user_id"].alias("user_id"),
        F.col("data")["appraise"].alias("appraise"),
    )


# Fixed value: a dictionary of two of the three order-status codes, so the left join shows NULLs.
STATUS_DICTIONARY = (("F", "finished", "status"), ("O", "open", "status"))


def q_lookup_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_topic_db(_topic(spark, sf_dir))
    comments = spark.sql(comment_filter_sql()).select(
        F.col("data")["id"].alias("id"), F.col("data")["appraise"].alias("appraise")
    )
    dic = spark.createDataFrame(list(STATUS_DICTIONARY), "dic_code string, dic_name string, parent_code string")
    return lookup_dictionary(comments, "appraise", dic, out="appraise_name")


def q_lookup_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 with a dictionary read from a table: supplier changes enriched with their nation's name."""
    register_topic_db(_topic(spark, sf_dir))
    suppliers = spark.sql(
        "SELECT data['s_suppkey'] AS s_suppkey, data['s_nationkey'] AS s_nationkey FROM topic_db "
        "WHERE `database` = 'gmall' AND `table` = 'supplier'"
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("dic_code"), F.col("n_name").alias("dic_name")
    )
    return lookup_dictionary(suppliers, "s_nationkey", nation, out="nation_name")


def q_date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wharf.functions import dates as D

    ms = D.epoch_ms_of("ts")
    ev = table(spark, sf_dir, "events").select("event_id", ms.alias("ms"))
    dttm = D.ts_to_date_time("ms")
    return ev.select(
        "event_id",
        D.ts_to_date("ms").alias("dt"),
        dttm.alias("dttm"),
        D.ts_to_date_for_partition("ms").alias("part_dt"),
        D.prev_day("ms").alias("prev_dt"),
        D.date_time_to_ts(dttm).alias("dttm_ms"),
        D.date_to_ts(D.ts_to_date("ms")).alias("dt_ms"),
    )


CDC_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cdc_clean": q_cdc_clean,
    "cdc_clean_data": q_cdc_clean_data,
    "cdc_quarantine": q_cdc_quarantine,
    "dim_route_by_batches": q_dim_route_by_batches,
    "dim_quarantine": q_dim_quarantine,
    "dim_route": q_dim_route,
    "dim_trim": q_dim_trim,
    "dim_apply": _apply("keep_old"),
    "dim_apply_overwrite": _apply("overwrite"),
    "dim_apply_on_base": q_dim_apply_on_base,
    "dim_apply_by_batches": _by_batches("keep_old"),
    "dim_apply_by_batches_overwrite": _by_batches("overwrite"),
    "dim_route_preload": q_dim_route_preload,
    "topic_filter": q_topic_filter,
    "lookup_dictionary": q_lookup_dictionary,
    "lookup_nation": q_lookup_nation,
    "date_functions": q_date_functions,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**LOG_QUERIES, **CDC_QUERIES}
