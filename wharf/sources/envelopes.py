"""Wire-format records built from the warehouse tables, so tests and benches run on real tables.

Each builder is a projection (plus one ``explode`` for the change feed) of a table into the text
records the jobs read: behaviour logs from ``events``, database change records from ``part``,
``supplier``, ``nation`` and ``orders``. Deterministic rules decide every field, so an oracle can
compute the expected answer from the same table in SQL without JSON. The work grows with the table.

Output schema of every builder: ``value string, partition int, offset bigint`` (Kafka-like).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.functions.dates import epoch_ms_of

# Fixed values of the synthetic envelopes (not upstream values): source partitions of each table's
# change records, the first change timestamp (seconds), and the per-table config rows.
PARTITION_PART = 0
PARTITION_SUPPLIER = 1
PARTITION_NATION = 2
PARTITION_COMMENT = 3
CHANGE_TS0 = 1704067200
SEQ_SLOTS = 16


def log_envelope(events: DataFrame) -> DataFrame:
    """Behaviour logs from ``events``.

    ``mid = 'm' || user_id``; ``ts`` = epoch ms; ``is_new`` = ``'2'`` when ``event_id % 97 = 0``, else
    ``'0'`` when ``user_id % 3 = 0 and event_id % 2 = 0``, else ``'1'``; ``start`` for signup, ``page``
    for the rest; ``err`` (holding ``event_id``) for error; ``event_id % 4`` displays for view; one
    action for click. Dirty: ``event_id % 101 = 0`` cut in half; ``event_id % 103 = 0`` has no ``mid``;
    ``event_id % 7 = 3`` has a text for ``err`` (error) or ``actions`` (click), or a number after its
    displays (view).
    """
    eid, uid, typ = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ms = epoch_ms_of("ts")
    is_new = (
        F.when(eid % 97 == 0, F.lit("2"))
        .when((uid % 3 == 0) & (eid % 2 == 0), F.lit("0"))
        .otherwise(F.lit("1"))
    )
    common = F.struct(
        F.when(eid % 103 != 0, F.concat(F.lit("m"), uid.cast("string"))).alias("mid"),
        F.when(eid % 113 != 0, is_new).alias("is_new"),
        uid.cast("string").alias("uid"),
        F.lit("web").alias("ch"),
    )
    start = F.when(typ == "signup", F.struct(F.lit("icon").alias("entry"), F.col("value").alias("loading_time")))
    page = F.when(typ != "signup", F.struct(typ.alias("page_id"), F.col("value").alias("during_time")))
    odd = eid % 7 == 3
    err = F.when(typ == "error", F.when(odd, _v(F.lit("boom"))).otherwise(F.to_variant_object(F.struct(eid.alias("code")))))
    n_disp = (eid % 4).cast("int")
    displays = F.when(
        typ == "view",
        F.concat(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < n_disp),
                lambda i: F.to_variant_object(F.struct((eid * 10 + i).alias("item"), (i + 1).alias("pos"))),
            ),
            F.when(odd, F.array(_v(eid))).otherwise(F.array().cast("array<variant>")),
        ),
    )
    action = F.array(F.struct(F.lit("fav").alias("action_id"), eid.alias("item")))
    actions = F.when(typ == "click", F.when(odd, _v(F.lit("nope"))).otherwise(F.to_variant_object(action)))
    text = F.to_json(
        F.struct(
            common.alias("common"),
            start.alias("start"),
            page.alias("page"),
            err.alias("err"),
            displays.alias("displays"),
            actions.alias("actions"),
            F.col("props").alias("props"),
            F.when(eid % 107 == 0, F.lit("abc").cast("variant"))
            .when(eid % 109 == 0, ms.cast("string").cast("variant"))
            .otherwise(ms.cast("variant")).alias("ts"),
        ),
        {"ignoreNullFields": "true"},
    )
    value = F.when(eid % 101 == 0, F.expr("substring(_t, 1, length(_t) div 2)")).otherwise(F.col("_t"))
    return (
        events.select(eid, uid, typ, F.col("value"), F.col("props"), F.col("ts"))
        .select(eid, text.alias("_t"))
        .select(value.alias("value"), F.lit(0).alias("partition"), eid.alias("offset"))
    )


def null_log_envelope(events: DataFrame) -> DataFrame:
    """Page logs from ``events`` with JSON nulls at every depth: ``common.ch`` null for even ``event_id``;
    ``page.last`` null when ``event_id % 3 = 0``; ``page.deep`` with a null and a member; ``page.list`` with a
    null, an object with a null, and an empty object; ``note`` a text that looks like a null member."""
    eid = F.col("event_id")
    common = F.struct(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("mid"), F.lit("1").alias("is_new"),
        F.when(eid % 2 == 1, F.lit("web")).alias("ch"),
    )
    none = F.lit(None).cast("string")
    item = lambda x, y: F.to_variant_object(F.struct(x.alias("x"), y.alias("y")))
    page = F.struct(
        F.col("event_type").alias("page_id"), F.when(eid % 3 != 0, F.lit("home")).alias("last"),
        F.struct(none.alias("a"), eid.alias("b")).alias("deep"),
        F.array(F.parse_json(F.lit("null")), item(none, eid), item(none, F.lit(None).cast("bigint"))).alias("list"),
    )
    record = F.struct(common.alias("common"), page.alias("page"), F.lit('a "n":null, b').alias("note"), epoch_ms_of("ts").alias("ts"))
    text = F.to_json(record, {"ignoreNullFields": "false"})
    return events.select(text.alias("value"), F.lit(0).alias("partition"), eid.alias("offset"))


def _v(c: Column) -> Column:
    return c.cast("variant")


def _change(database: Column, table: str, typ: Column | str, ts: Column, data: Column) -> Column:
    t = F.lit(typ) if isinstance(typ, str) else typ
    return F.to_json(
        F.struct(database.alias("database"), F.lit(table).alias("table"), t.alias("type"), ts.alias("ts"), data.alias("data"))
    )


def _rec(value: Column, seq: int, offset: Column) -> Column:
    return F.struct(value.alias("value"), F.lit(seq).alias("seq"), offset.alias("offset"))


def part_changes(part: DataFrame, database: str = "gmall") -> DataFrame:
    """Change records of ``part``: seq 0 ``bootstrap-insert`` of every row; seq 1 ``update`` when
    ``p_partkey % 3 = 0`` (name prefixed ``U``, size + 1, or JSON null when ``p_partkey % 6 = 0``); seq 2
    ``delete`` when ``p_partkey % 10 = 0``; seq 3 ``insert`` when ``p_partkey % 20 = 0`` (name prefixed
    ``R``, size null). Markers for the clean step: ``p_partkey % 500 = 1`` adds a foreign-database
    record, ``% 500 = 2`` an unknown-table record, ``% 1000 = 3`` a ``bootstrap-start`` and ``% 1000 = 4``
    a ``bootstrap-complete``. Bad records: ``% 700 = 5`` an insert cut in half, ``% 700 = 6`` an insert
    without ``data``, ``% 700 = 7`` an update whose ``data`` lacks the row key (name prefixed ``X``).
    ``ts`` = 1704067200 + seq; ``offset`` = ``p_partkey * 16 + seq``."""
    k = F.col("p_partkey")
    db = F.lit(database)

    def data(name: Column, size: Column) -> Column:
        return F.create_map(
            F.lit("p_partkey"), _v(k),
            F.lit("p_name"), _v(name),
            F.lit("p_size"), _v(size),
            F.lit("p_brand"), _v(F.col("p_brand")),
            F.lit("p_retailprice"), _v(F.col("p_retailprice")),
        )

    name, size = F.col("p_name"), F.col("p_size")
    null_int = F.lit(None).cast("int")
    ts = lambda s: F.lit(CHANGE_TS0 + s).cast("bigint")
    off = lambda s: k * SEQ_SLOTS + s
    cut = lambda t: F.substring(t, F.lit(1), (F.length(t) / 2).cast("int"))
    recs = F.array(
        _rec(_change(db, "part", "bootstrap-insert", ts(0), data(name, size)), 0, off(0)),
        F.when(k % 3 == 0, _rec(_change(db, "part", "update", ts(1),
               data(F.concat(F.lit("U"), name), F.when(k % 6 != 0, size + 1))), 1, off(1))),
        F.when(k % 10 == 0, _rec(_change(db, "part", "delete", ts(2), data(name, size)), 2, off(2))),
        F.when(k % 20 == 0, _rec(_change(db, "part", "insert", ts(3), data(F.concat(F.lit("R"), name), null_int)), 3, off(3))),
        F.when(k % 500 == 1, _rec(_change(F.lit("other_db"), "part", "insert", ts(4), data(name, size)), 4, off(4))),
        F.when(k % 500 == 2, _rec(_change(db, "unknown_table", "insert", ts(5), data(name, size)), 5, off(5))),
        F.when(k % 1000 == 3, _rec(_change(db, "part", "bootstrap-start", ts(6), F.create_map().cast("map<string,variant>")), 6, off(6))),
        F.when(k % 1000 == 4, _rec(_change(db, "part", "bootstrap-complete", ts(7), F.create_map().cast("map<string,variant>")), 7, off(7))),
        F.when(k % 700 == 5, _rec(cut(_change(db, "part", "insert", ts(8), data(name, size))), 8, off(8))),
        F.when(k % 700 == 6, _rec(_change(db, "part", "insert", ts(9), F.lit(None).cast("map<string,variant>")), 9, off(9))),
        F.when(k % 700 == 7, _rec(_change(db, "part", "update", ts(10),
               F.create_map(F.lit("p_name"), _v(F.concat(F.lit("X"), name)))), 10, off(10))),
    )
    return (
        part.select(F.explode(F.filter(recs, lambda r: r.isNotNull())).alias("r"))
        .select(F.col("r.value").alias("value"), F.lit(PARTITION_PART).alias("partition"), F.col("r.offset").alias("offset"))
    )


def supplier_changes(supplier: DataFrame, database: str = "gmall") -> DataFrame:
    """``bootstrap-insert`` of every supplier row; ``offset = s_suppkey``."""
    data = F.create_map(
        F.lit("s_suppkey"), _v(F.col("s_suppkey")),
        F.lit("s_name"), _v(F.col("s_name")),
        F.lit("s_nationkey"), _v(F.col("s_nationkey")),
        F.lit("s_acctbal"), _v(F.col("s_acctbal")),
    )
    return supplier.select(
        _change(F.lit(database), "supplier", "bootstrap-insert", F.lit(CHANGE_TS0).cast("bigint"), data).alias("value"),
        F.lit(PARTITION_SUPPLIER).alias("partition"),
        F.col("s_suppkey").cast("bigint").alias("offset"),
    )


def nation_changes(nation: DataFrame, database: str = "gmall") -> DataFrame:
    """``bootstrap-insert`` of every nation row; ``offset = n_nationkey``."""
    data = F.create_map(
        F.lit("n_nationkey"), _v(F.col("n_nationkey")),
        F.lit("n_name"), _v(F.col("n_name")),
        F.lit("n_regionkey"), _v(F.col("n_regionkey")),
    )
    return nation.select(
        _change(F.lit(database), "nation", "bootstrap-insert", F.lit(CHANGE_TS0).cast("bigint"), data).alias("value"),
        F.lit(PARTITION_NATION).alias("partition"),
        F.col("n_nationkey").cast("bigint").alias("offset"),
    )


def comment_changes(orders: DataFrame, database: str = "gmall") -> DataFrame:
    """One ``insert`` into ``comment_info`` per order: ``id = o_orderkey``, ``user_id = o_custkey``,
    ``appraise = o_orderstatus``; ``ts`` = 1704067200 + ``o_orderkey % 86400``; ``offset = o_orderkey``."""
    data = F.create_map(
        F.lit("id"), _v(F.col("o_orderkey")),
        F.lit("user_id"), _v(F.col("o_custkey")),
        F.lit("appraise"), _v(F.col("o_orderstatus")),
        F.lit("comment_txt"), _v(F.col("o_orderpriority")),
    )
    ts = (F.lit(CHANGE_TS0) + F.col("o_orderkey") % 86400).cast("bigint")
    return orders.select(
        _change(F.lit(database), "comment_info", "insert", ts, data).alias("value"),
        F.lit(PARTITION_COMMENT).alias("partition"),
        F.col("o_orderkey").cast("bigint").alias("offset"),
    )


def topic_db_envelope(part: DataFrame, supplier: DataFrame, nation: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """The whole ``topic_db`` feed: changes of part, supplier, nation (and comments from orders)."""
    out = part_changes(part).unionByName(supplier_changes(supplier)).unionByName(nation_changes(nation))
    return out.unionByName(comment_changes(orders)) if orders is not None else out


# The config table feed used with the envelopes above. Snapshot rows for part,
# supplier and nation; a create for customer; an update of supplier's columns (note the spaces, which
# the trim must strip); a delete of nation.
CONFIG_FEED = (
    '{"op":"r","before":null,"after":{"source_table":"part","sink_table":"dim_part","sink_family":"info","sink_columns":"p_partkey,p_name,p_size","sink_row_key":"p_partkey"}}',
    '{"op":"r","before":null,"after":{"source_table":"supplier","sink_table":"dim_supplier","sink_family":"info","sink_columns":"s_suppkey,s_name","sink_row_key":"s_suppkey"}}',
    '{"op":"r","before":null,"after":{"source_table":"nation","sink_table":"dim_nation","sink_family":"info","sink_columns":"n_nationkey,n_name","sink_row_key":"n_nationkey"}}',
    '{"op":"c","before":null,"after":{"source_table":"customer","sink_table":"dim_customer","sink_family":"info","sink_columns":"c_custkey,c_name","sink_row_key":"c_custkey"}}',
    '{"op":"u","before":{"source_table":"supplier","sink_table":"dim_supplier","sink_family":"info","sink_columns":"s_suppkey,s_name","sink_row_key":"s_suppkey"},"after":{"source_table":"supplier","sink_table":"dim_supplier","sink_family":"info","sink_columns":"s_suppkey, s_name, s_nationkey","sink_row_key":"s_suppkey"}}',
    '{"op":"d","before":{"source_table":"nation","sink_table":"dim_nation","sink_family":"info","sink_columns":"n_nationkey,n_name","sink_row_key":"n_nationkey"},"after":null}',
)


def config_feed(spark) -> DataFrame:
    """The config change feed as text records ``(value, partition, offset)``."""
    return spark.createDataFrame([(v, 0, i) for i, v in enumerate(CONFIG_FEED)], "value string, partition int, offset bigint")
