"""Database-change operators: clean (P1), config parse (P3), current config (T5), routing (J1, J2),
column trim (P4) and the put/delete dispatch (K5).

A change record is ``{"database", "table", "type", "ts", "data": {...}}``. ``data`` is kept as a
``map<string,variant>``, so a 20-digit decimal keeps its digits; cells become strings only when they
are written to a dimension table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.config import BOOTSTRAP_MARKERS, CONFIG_DELETE_OP, DELETE_TYPE, SOURCE_DATABASE
from wharf.functions.jsonx import as_object, get_long, get_string, is_object, present, repeats_key
from wharf.operators.logs import parse_once

CONFIG_FIELDS = ("source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key")
CONFIG_SCHEMA = (
    "op string, "
    f"before struct<{', '.join(f + ' string' for f in CONFIG_FIELDS)}>, "
    f"after struct<{', '.join(f + ' string' for f in CONFIG_FIELDS)}>"
)
REC = "rec"


def _order(*cols: str) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def classify_changes(raw: DataFrame, database: str = SOURCE_DATABASE, value_col: str = "value") -> DataFrame:
    """Parse once; add ``database, table, type, ts, data`` and ``status``:

    * ``keep``: the source database, not a bootstrap marker, ``data`` an object (``{}`` included). A
      missing ``type`` is kept (a null-safe test, where SQL ``NOT IN`` would drop it).
    * ``skip``: another database, or a bootstrap marker: not for this job, dropped quietly.
    * ``unparseable`` / ``repeated_key`` / ``no_data`` / ``bad_data``: bad rows, for the quarantine (D5).
    """
    p = parse_once(raw, value_col, out=REC)
    rec = F.col(REC)
    db, typ, data = get_string(rec["database"]), get_string(rec["type"]), rec["data"]
    marker = F.coalesce(typ.isin(*BOOTSTRAP_MARKERS), F.lit(False))
    status = (
        F.when(rec.isNull(), F.lit("unparseable"))
        .when(repeats_key(rec), F.lit("repeated_key"))
        .when(~db.eqNullSafe(F.lit(database)) | marker, F.lit("skip"))
        .when(~present(data), F.lit("no_data"))
        .when(~is_object(data), F.lit("bad_data"))
        .otherwise(F.lit("keep"))
    )
    return p.select(
        "*",
        db.alias("database"),
        get_string(rec["table"]).alias("table"),
        typ.alias("type"),
        get_long(rec["ts"]).alias("ts"),
        as_object(data).alias("data"),
        status.alias("status"),
    )


def cdc_clean(raw: DataFrame, database: str = SOURCE_DATABASE, value_col: str = "value", keep_text: bool = False) -> DataFrame:
    """Kept change records as ``(<raw columns but value>, database, table, type, ts, data)``;
    ``keep_text`` keeps the text too, for a quarantine further on."""
    c = classify_changes(raw, database, value_col)
    keep = [x for x in raw.columns if keep_text or x != value_col]
    return c.where(F.col("status") == "keep").select(*keep, "database", "table", "type", "ts", "data")


def cdc_quarantine(raw: DataFrame, database: str = SOURCE_DATABASE, value_col: str = "value") -> DataFrame:
    """Change records that are bad (not merely for another database), with ``reason``."""
    c = classify_changes(raw, database, value_col)
    return c.where(~F.col("status").isin("keep", "skip")).select(*raw.columns, F.col("status").alias("reason"))


def parse_config(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Config change text -> ``(<raw columns but value>, source_table, sink_table, sink_family,
    sink_columns, sink_row_key, op)``. ``d`` takes the fields from ``before``; ``c``, ``r``, ``u`` and
    anything else from ``after``. A change that renames ``source_table`` is also a ``d`` of the old name."""
    cfg = F.from_json(F.col(value_col), CONFIG_SCHEMA)
    op, before, after = cfg["op"], cfg["before"], cfg["after"]
    row = lambda o, img: F.struct(o.alias("op"), img.alias("img"))
    own = row(op, F.when(op == CONFIG_DELETE_OP, before).otherwise(after))
    rows = F.when(_renames(op, before, after), F.array(row(F.lit(CONFIG_DELETE_OP), before), own)).otherwise(F.array(own))
    keep = [x for x in raw.columns if x != value_col]
    return raw.select(*keep, F.inline(rows)).select(*keep, *[F.col("img")[f].alias(f) for f in CONFIG_FIELDS], "op")


def _renames(op: Column, before: Column, after: Column) -> Column:
    return (op != CONFIG_DELETE_OP) & (before["source_table"] != after["source_table"])


def config_changes(raw: DataFrame, preload: DataFrame | None = None, order: str = "offset", value_col: str = "value") -> DataFrame:
    """The config feed as changes to walk (K9): ``source_table .. sink_row_key`` and ``op`` as
    :func:`parse_config` has them, ``o`` (the order), ``before`` and ``after``. Changes that the current config
    refuses are left out. ``preload`` rows are ``r`` changes before the whole feed."""
    cfg = F.from_json(F.col(value_col), CONFIG_SCHEMA)
    img = F.when(cfg["op"] == CONFIG_DELETE_OP, cfg["before"]).otherwise(cfg["after"])
    fields = [F.col("img")[f].alias(f) for f in CONFIG_FIELDS]
    rows = raw.select(F.col(order).cast("long").alias("o"), cfg["op"].alias("op"), cfg["before"].alias("before"), cfg["after"].alias("after"), img.alias("img"))
    rows = rows.select(*fields, "op", "o", "before", "after").where("o IS NOT NULL")
    if preload is not None:
        after = F.struct(*[F.col(f).cast("string").alias(f) for f in CONFIG_FIELDS])
        first = preload.select(*CONFIG_FIELDS, F.lit("r").alias("op"), F.lit(-(1 << 62)).alias("o"), F.lit(None).cast(rows.schema["before"].dataType).alias("before"), after.alias("after"))
        rows = first.unionByName(rows)
    return validate_config(rows).where("reason IS NULL").drop("reason")


def validate_config(cfg: DataFrame) -> DataFrame:
    """Add ``reason`` (NULL when valid). D10: one column family per table; a list is refused, and so is a table
    name that a catalog cannot hold."""
    fam = F.trim(F.col("sink_family"))
    reason = (
        F.when(F.col("op").isNull(), F.lit("no_op"))
        .when(F.col("source_table").isNull(), F.lit("no_source_table"))
        .when(F.col("op") == CONFIG_DELETE_OP, F.lit(None).cast("string"))
        .when(F.col("sink_table").isNull() | F.col("sink_row_key").isNull(), F.lit("incomplete"))
        .when(fam.contains(","), F.lit("multiple_families"))
        .when(~F.col("sink_table").rlike(r"\A\w+\z"), F.lit("bad_table_name"))
    )
    return cfg.withColumn("reason", reason)


def config_quarantine(raw: DataFrame, order: tuple[str, ...] = ("offset",), value_col: str = "value") -> DataFrame:
    """D5 for the config feed: records that :func:`current_config` refuses, with their text and ``reason``
    (unreadable ones are ``no_op``; ``no_order``: nothing says what came before or after it)."""
    parsed = raw.withColumn("_text", F.col(value_col))
    checked = validate_config(parse_config(parsed, value_col))
    unordered = F.greatest(F.lit(False), *[F.col(c).isNull() for c in order])
    reason = F.coalesce(F.col("reason"), F.when(unordered, F.lit("no_order")))
    return checked.select(F.col("_text").alias("value"), reason.alias("reason")).where("reason IS NOT NULL")


def current_config(feed: DataFrame, preload: DataFrame | None = None, order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """T5 (+ J2): the live config, one row per ``source_table``.

    ``feed`` holds parsed config changes ordered by ``order``; the latest change per key wins and a
    delete removes the key. ``preload`` (a snapshot, e.g. read by JDBC) counts as ``op='r'`` rows that
    come before the whole feed, so a key the feed never mentions is still live, and a delete in the
    feed beats the snapshot. Invalid changes (:func:`validate_config`) and those without an order take no
    part; :func:`config_quarantine` gives them with their text. The config is a handful of rows; the
    aggregate is a keyed ``max_by`` with no window.
    """
    cols = list(CONFIG_FIELDS) + ["op"]
    f = validate_config(feed).where(F.col("reason").isNull()).dropna(subset=list(order))
    rows = f.select(*cols, F.struct(F.lit(1).alias("src"), _order(*order).alias("o")).alias("_o"))
    if preload is not None:
        p = preload.select(*CONFIG_FIELDS).withColumn("op", F.lit("r"))
        p = validate_config(p).where(F.col("reason").isNull()).select(*cols)
        o_type = rows.schema["_o"].dataType["o"].dataType
        first = F.struct(F.lit(0).alias("src"), F.lit(None).cast(o_type).alias("o"))
        rows = p.select(*cols, first.alias("_o")).unionByName(rows)
    latest = rows.groupBy("source_table").agg(F.max_by(F.struct(*cols), F.col("_o")).alias("c"))
    return latest.select("c.*").where(F.col("op") != CONFIG_DELETE_OP)


def _broadcast(config: DataFrame) -> DataFrame:
    """The config, a row per source table, as the broadcast side of its join with the changes, as in the upstream
    job. Nothing says how large a feed's rows are: by estimates alone Spark broadcast the changes, or dealt them by
    ``table``, all changes of a table to one task. A session that forbids broadcasts gets a shuffle join."""
    threshold = str(config.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return config if threshold.startswith("-") else F.broadcast(config)


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Inner equi-join of each change with the config row of its table (``table = source_table``).

    Changes of tables without a config row are dropped (D6). The config is broadcast (:func:`_broadcast`); no
    job runs while the plan is built.
    """
    side = _broadcast(config.select(*CONFIG_FIELDS))
    return changes.join(side, changes["table"] == side["source_table"], "inner").drop("source_table")


def config_intervals(feed: DataFrame, batch: str = "batch", order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """The config as each batch saw it, from parsed config changes that say in which batch they were there
    (``batch``): the config columns, ``from_batch`` and ``to_batch`` (exclusive; NULL: still live). Of the
    changes of one batch the last counts; a delete ends the row before it and starts none."""
    cols = [*CONFIG_FIELDS, "op"]
    f = validate_config(feed).where("reason IS NULL").dropna(subset=[*order, batch])
    last = f.groupBy("source_table", F.col(batch).alias("from_batch")).agg(F.max_by(F.struct(*cols), _order(*order)).alias("c"))
    to = F.lead("from_batch").over(Window.partitionBy("source_table").orderBy("from_batch"))  # a row per config change
    return last.select("c.*", "from_batch", to.alias("to_batch")).where(F.col("op") != CONFIG_DELETE_OP)


def route_by_batch(changes: DataFrame, feed: DataFrame, batch: str = "batch", order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """:func:`route` of many batches in one plan, each change (``batch``) by the config that its batch saw."""
    side = _broadcast(config_intervals(feed, batch, order).select(*CONFIG_FIELDS, "from_batch", "to_batch"))
    n = F.col(batch)
    seen = (changes["table"] == side["source_table"]) & (n >= F.col("from_batch")) & (F.col("to_batch").isNull() | (n < F.col("to_batch")))
    return changes.join(side, seen, "inner").drop("source_table", "from_batch", "to_batch")


def sink_column_list(sink_columns: Column) -> Column:
    """Split on ``,`` and trim, so ``"id, name"`` keeps ``name``."""
    return F.transform(F.split(sink_columns, ","), lambda c: F.trim(c))


def trim(routed: DataFrame) -> DataFrame:
    """P4 (+ D7, K5): take ``row_key`` from ``data[sink_row_key]`` before trimming, keep only the keys of
    ``data`` named in ``sink_columns`` (deletes too), and add ``change_op`` (``delete``/``upsert``)."""
    data = F.col("data")
    cols = sink_column_list(F.col("sink_columns"))
    return routed.select(
        *[c for c in routed.columns if c != "data"],
        get_string(data[F.trim(F.col("sink_row_key"))]).alias("row_key"),
        F.map_filter(data, lambda k, _v: F.array_contains(cols, k)).alias("data"),
        F.when(F.col("type").eqNullSafe(F.lit(DELETE_TYPE)), F.lit("delete")).otherwise(F.lit("upsert")).alias("change_op"),
    )


def dim_changes(trimmed: DataFrame) -> DataFrame:
    """Trimmed changes that can be applied: a row key is present."""
    return trimmed.where(F.col("row_key").isNotNull())


def judge_changes(raw: DataFrame, config: DataFrame, tables: DataFrame, database: str = SOURCE_DATABASE) -> DataFrame:
    """Every change that concerns this job, parsed and routed once, with ``reason`` (NULL: it can be applied
    to one of ``tables``, by ``sink_table``): bad records, changes without a row key, changes of a table that is
    not there. ``value`` stays with those that have a reason; changes of tables without a config row are gone (D6)."""
    c = classify_changes(raw, database).drop(REC).where("status <> 'skip'")
    side = _broadcast(config.select(*CONFIG_FIELDS).join(tables.select("sink_table", F.lit(True).alias("_there")), "sink_table", "left"))
    keep = F.col("status") == "keep"
    routed = c.join(side, keep & (c["table"] == side["source_table"]), "left").drop("source_table")
    reason = (
        F.when(~keep, F.col("status"))
        .when(F.col("row_key").isNull(), F.lit("no_row_key"))
        .when(F.col("_there").isNull(), F.lit("no_table"))
    )
    judged = trim(routed.where(~keep | F.col("sink_table").isNotNull())).withColumn("reason", reason)
    text = F.when(F.col("reason").isNotNull(), F.col("value"))
    return judged.select(
        "ts", "partition", "offset", "sink_table", "sink_family", "row_key", "change_op", "data", "reason", text.alias("value")
    )


def dim_quarantine(trimmed: DataFrame) -> DataFrame:
    """Routed changes without a row key, with ``reason``."""
    return trimmed.where(F.col("row_key").isNull()).withColumn("reason", F.lit("no_row_key"))
