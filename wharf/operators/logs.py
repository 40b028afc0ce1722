"""Behaviour-log operators: clean (P2), event time (T1), new-visitor repair (T3), split (T4).

Input of :func:`classify_logs` is a raw text DataFrame with a ``value`` column and a tie-break column
(``offset`` by default) that orders two logs of one device with equal ``ts``. The JSON is parsed once
into a ``log map<string,variant>`` column, so fields the jobs do not know survive to the outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.config import DEFAULT_TZ
from wharf.functions.dates import prev_day, ts_to_date
from wharf.functions.jsonx import (
    as_object,
    as_object_array,
    drop_keys,
    get_long,
    get_string,
    is_object,
    parse_object,
    present,
    put,
    repeats_key,
    to_json_text,
    to_variant_object,
)

LOG = "log"
ROUTE_RECORD = T.StructType([T.StructField("route", T.StringType()), T.StructField("value", T.StringType())])
BAD_PART = T.StructType([T.StructField("reason", T.StringType()), T.StructField("value", T.StringType())])


def parse_once(raw: DataFrame, value_col: str = "value", out: str = LOG) -> DataFrame:
    """Add the parsed JSON object as ``out``, parsing each record exactly once.

    A plain ``select(from_json) -> filter`` lets the optimizer copy the parse into every pushed-down
    predicate; behind a one-row generator the filters stay above it and the plan holds one parse.
    """
    return raw.select("*", F.inline(F.array(F.struct(parse_object(value_col).alias(out)))))


def _field_checks(log: Column) -> Column:
    """The facts the clean rules need, each computed once per log, as one struct."""
    page, start, common, ts = log["page"], log["start"], log["common"], log["ts"]
    return F.struct(
        is_object(page).alias("page_obj"),
        is_object(start).alias("start_obj"),
        is_object(common).alias("common_obj"),
        present(page).alias("page_set"),
        present(start).alias("start_set"),
        present(common).alias("common_set"),
        present(ts).alias("ts_set"),
        get_string(common, "$.mid").alias("mid"),
        get_long(ts).alias("ts"),
    )


def _reason(log: Column, k: Column) -> Column:
    bad_kind = (
        (k["page_set"] & ~k["page_obj"])
        | (k["start_set"] & ~k["start_obj"])
        | (k["common_set"] & ~k["common_obj"])
        | (k["ts_set"] & k["ts"].isNull())
    )
    return (
        F.when(log.isNull(), F.lit("unparseable"))
        .when(repeats_key(log), F.lit("repeated_key"))
        .when(bad_kind, F.lit("bad_field_type"))
        .when(~k["page_obj"] & ~k["start_obj"], F.lit("no_page_or_start"))
        .when(~k["common_obj"], F.lit("no_common"))
        .when(k["mid"].isNull(), F.lit("no_mid"))
        .when(k["ts"].isNull(), F.lit("no_ts"))
    )


def classify_logs(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse once and attach ``reason`` (NULL for a good log), ``mid``, ``ts`` and ``kind``.

    A log is good when it parses to an object, has a ``page`` or ``start`` object, a ``common`` object
    with a non-null ``mid``, and a ``ts`` readable as a long (numeric text is accepted). A log with only
    ``err`` is not good. Anything the upstream parser would throw on is a bad row, never a failure.

    The field checks sit behind a second one-row generator, so the optimizer evaluates each once
    instead of copying it into the filters that follow.
    """
    parsed = parse_once(raw, value_col)
    checked = parsed.select("*", F.inline(F.array(F.struct(_field_checks(F.col(LOG)).alias("_k")))))
    log, k = F.col(LOG), F.col("_k")
    return checked.select(
        *[F.col(c) for c in parsed.columns],
        _reason(log, k).alias("reason"),
        k["mid"].alias("mid"),
        k["ts"].alias("ts"),
        F.when(k["start_obj"], F.lit("start")).when(k["page_obj"], F.lit("page")).alias("kind"),
    )


def log_clean(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Good logs as ``(<raw columns but value>, log, mid, ts, kind)``; ``kind`` is ``start`` or
    ``page`` (start wins), so the split need not test the objects again."""
    c = classify_logs(raw, value_col)
    keep = [x for x in raw.columns if x != value_col]
    return c.where(F.col("reason").isNull()).select(*keep, LOG, "mid", "ts", "kind")


def bad_parts(log: Column, kind: Column) -> Column:
    """Parts of a good log that the split cannot route, as ``array<struct<reason, value>>`` with their JSON
    text: an ``err`` that is no object, and on page logs ``displays``/``actions`` that are no arrays and
    elements of theirs that are no objects. The other parts of the log are routed as usual."""
    empty = F.array().cast(T.ArrayType(BAD_PART))

    def part(reason: str, v: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), F.coalesce(F.to_json(v), F.lit("null")).alias("value"))

    def elements(key: str, reason: str) -> Column:
        found = log[key].try_cast("array<variant>")
        odd = F.transform(F.filter(found, lambda e: as_object(e).isNull()), lambda e: part(reason, e))
        whole = F.when(present(log[key]), F.array(part(f"{key}_not_array", log[key]))).otherwise(empty)
        return F.when((kind == "page") & found.isNull(), whole).when(kind == "page", odd).otherwise(empty)

    err = F.when(present(log["err"]) & ~is_object(log["err"]), F.array(part("err_not_object", log["err"]))).otherwise(empty)
    return F.concat(err, elements("displays", "display_not_object"), elements("actions", "action_not_object"))


def quarantine_records(value_col: str = "value") -> Column:
    """What a classified log gives to the quarantine, as ``array<struct<reason, value>>``: a bad log its
    whole text, a good log its :func:`bad_parts`."""
    whole = F.array(F.struct(F.col("reason").alias("reason"), F.col(value_col).alias("value")))
    return F.when(F.col("reason").isNotNull(), whole).otherwise(bad_parts(F.col(LOG), F.col("kind")))


def log_quarantine(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The raw columns plus ``reason`` of what would otherwise be dropped: bad logs with their text,
    and parts of good logs that the split cannot route with the text of the part."""
    c = classify_logs(raw, value_col)
    rest = [x for x in raw.columns if x != value_col]
    out = c.select(*rest, F.inline(quarantine_records(value_col)).alias("reason", "_part"))
    return out.select(*[F.col("_part").alias(x) if x == value_col else F.col(x) for x in raw.columns], "reason")


def with_event_time(df: DataFrame, watermark: str | None = None, col: str = "event_time") -> DataFrame:
    """Event time from ``ts`` (epoch ms). The watermark, when given, is assigned and nothing reads
    it, as upstream; late rows are never dropped by any operator in this package."""
    out = df.withColumn(col, F.timestamp_millis(F.col("ts")))
    return out.withWatermark(col, watermark) if watermark else out


LATE_BLOCK = 1 << 16  # offsets of a source partition that are ordered together


def with_lateness(clean: DataFrame, disorder_ms: int = 3000) -> DataFrame:
    """``partition, offset, ts`` of every log with ``late``: a log before it in its source partition was more
    than ``disorder_ms`` ahead of it, so a watermark of that disorder had passed it. No log is dropped.

    The greatest time before a log is that of earlier blocks of ``LATE_BLOCK`` offsets (a row per block) or
    that of the logs before it in its own block, so a partition's logs are never ordered in one task."""
    rows = clean.select("partition", "offset", "ts", F.floor(F.col("offset") / LATE_BLOCK).alias("_block"))
    blocks = rows.groupBy("partition", "_block").agg(F.max("ts").alias("_most"))
    before = Window.partitionBy("partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("partition").alias("_p"), F.col("_block").alias("_b"), F.max("_most").over(before).alias("_earlier"))
    within = Window.partitionBy("partition", "_block").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_here", F.max("ts").over(within))
    rows = rows.join(blocks, F.col("partition").eqNullSafe(F.col("_p")) & F.col("_block").eqNullSafe(F.col("_b")))
    late = F.coalesce(F.col("ts") < F.greatest("_earlier", "_here") - disorder_ms, F.lit(False))
    return rows.select("partition", "offset", "ts", late.alias("late"))


def late_by_hour(clean: DataFrame, disorder_ms: int = 3000) -> DataFrame:
    """``hour`` (of the epoch), ``n`` logs and ``n_late`` among them."""
    rows = with_lateness(clean, disorder_ms)
    return rows.groupBy(F.floor(F.col("ts") / 3_600_000).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("late"), 1)).alias("n_late")
    )


def _flag_value(flag_type: str) -> Column:
    if flag_type == "string":
        return F.lit("0").cast("variant")
    if flag_type == "int":
        return F.lit(0).cast("variant")
    raise ValueError(f"flag_type must be 'string' or 'int', not {flag_type!r}")


def first_seen_candidate(log: Column, ts: Column, tz: str) -> Column:
    """The date a log would store for its device when the device has none yet: its own date for flag
    ``1``, the day before for flag ``0``, nothing for any other flag (D3: NULL too)."""
    flag = get_string(log["common"], "$.is_new")
    return F.when(flag == "1", ts_to_date(ts, tz)).when(flag == "0", prev_day(ts, tz))


def repair_condition(flag: Column, prev: Column, cur_dt: Column, rule: str) -> Column:
    """``later_day`` repairs a ``1`` flag when the stored date differs from today; ``same_day`` when
    it equals today (the rule as upstream coded it)."""
    if rule == "later_day":
        hit = prev != cur_dt
    elif rule == "same_day":
        hit = prev == cur_dt
    else:
        raise ValueError(f"rule must be 'later_day' or 'same_day', not {rule!r}")
    return (flag == "1") & prev.isNotNull() & hit


def apply_repair(log: Column, repair: Column, flag_type: str) -> Column:
    """Rewrite ``common.is_new`` to 0 where ``repair`` holds; leave the log untouched elsewhere."""
    new_common = to_variant_object(put(as_object(log["common"]), {"is_new": _flag_value(flag_type)}))
    return F.when(repair, put(log, {"common": new_common})).otherwise(log)


def device_buckets(clean: DataFrame) -> int:
    """Buckets that a device's logs are dealt to: a sixteenth of the shuffle partitions, 16 at least."""
    return max(16, int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)


def fix_is_new(
    clean: DataFrame,
    rule: str = "later_day",
    flag_type: str = "string",
    tz: str = DEFAULT_TZ,
    tie: tuple[str, ...] = ("partition", "offset"),
    salt: int | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Repair the new-visitor flag per device.

    Each device stores one date, set once by its first log (in ``(ts, partition, offset)`` order) whose flag is ``1``
    (that log's date) or ``0`` (the day before). A later ``1`` log is repaired per ``rule``. Every log is
    emitted. Adds ``is_new`` (the flag after repair, as text).

    ``known`` (``mid, dt``, one row per device; a stream's earlier batches) are dates stored already: such a
    device's logs all compare with that date. The result then also has ``sets``: the date that a log
    stores, on the one log of each new device that does.

    Plan: the input is read and parsed once, and its logs are shuffled once, by device and bucket
    (``hash(partition, offset) mod salt``, :func:`device_buckets` by default). That one exchange feeds both
    the keyed minimum ``min(struct((ts, tie), date))`` and the logs that it is joined to. No window runs
    over a device's logs: a device holding a third of all logs lies over ``salt`` partitions, and its
    minimum comes from one row per bucket. A bucket's row goes back to that bucket alone, so a device has
    as many copies as it has buckets with logs (one, for a device with one log).
    """
    salt = device_buckets(clean) if salt is None else salt
    if salt < 1:
        raise ValueError("salt must be >= 1")
    log, ts = F.col(LOG), F.col("ts")
    ties = [c for c in tie if c in clean.columns]
    # A frame that still holds bad logs (a ``reason`` column) passes them through untouched.
    good = F.col("reason").isNull() if "reason" in clean.columns else F.lit(True)
    h = F.xxhash64(*ties)
    # Logs without a device (bad ones riding along) never match; they spread over every partition.
    bucket = F.when(F.col("mid").isNull(), F.pmod(h, F.lit(1 << 30))).otherwise(F.pmod(h, F.lit(salt)))
    dealt = clean.select(
        "mid",
        bucket.cast("int").alias("_bucket"),
        *[F.col(c) for c in clean.columns if c != "mid"],
        F.struct(ts.alias("ts"), *[F.col(c) for c in ties]).alias("_o"),
        F.when(good, first_seen_candidate(log, ts, tz)).alias("_dt"),
        good.alias("_good"),
    ).repartition("mid", "_bucket")
    # Behind a one-row generator both readers of the exchange need all of its columns, so its two
    # occurrences stay the same plan and Spark runs it once.
    rest = [c for c in dealt.columns if c not in ("mid", "_bucket")]
    held = dealt.select("mid", "_bucket", F.inline(F.array(F.struct(*rest))))
    # the keys come out as aggregates, so that no filter on them reaches one reader's side of the exchange
    cells = held.groupBy("mid", "_bucket").agg(
        F.min("mid").alias("_m"), F.min("_bucket").alias("_b"), F.max("_good").alias("_any"),
        F.min(F.when(F.col("_dt").isNotNull(), F.struct("_o", "_dt"))).alias("_first"),
    ).where("_any").select("_m", "_b", "_first")
    cells = cells.select("_m", "_b", F.min("_first").over(Window.partitionBy("_m")).alias("_first"))
    if known is None:
        stored = F.lit(None).cast("string")
    else:
        cells = cells.join(known.select(F.col("mid").alias("_k"), F.col("dt").alias("_stored")), F.col("_m") == F.col("_k"), "left").drop("_k")
        stored = F.col("_stored")
    j = held.join(cells, (F.col("mid") == F.col("_m")) & (F.col("_bucket") == F.col("_b")), "left")
    later = F.when(F.col("_good") & (F.col("_first._o") < F.col("_o")), F.col("_first._dt"))
    prev = F.when(F.col("_good"), F.coalesce(stored, later))
    flag = get_string(log["common"], "$.is_new")
    repair = repair_condition(flag, prev, ts_to_date(ts, tz), rule)
    sets = F.when(F.col("_good") & stored.isNull() & (F.col("_first._o") == F.col("_o")), F.col("_dt"))
    return j.select(
        *[c for c in clean.columns if c != LOG],
        apply_repair(log, repair, flag_type).alias(LOG),
        F.when(repair, F.lit("0")).otherwise(flag).alias("is_new"),
        *([] if known is None else [sets.alias("sets")]),
    )


def _fan_out(log: Column, key: str, route: str) -> Column:
    """T4d/T4e: one record per object element of ``displays``/``actions`` with the log's ``common``,
    ``ts`` and ``page`` put in (overwriting). Other elements go to the quarantine (:func:`bad_parts`)."""
    elems = F.filter(as_object_array(log[key]), lambda e: e.isNotNull())
    extra = {"common": log["common"], "ts": F.col("ts").cast("variant"), "page": log["page"]}
    recs = F.transform(elems, lambda e: F.struct(F.lit(route).alias("route"), to_json_text(put(e, extra)).alias("value")))
    return F.coalesce(recs, F.array().cast(T.ArrayType(ROUTE_RECORD)))


def route_records(log: Column, kind: Column | None = None) -> Column:
    """All records of one log as ``array<struct<route, value>>`` (T4a-T4e). ``kind`` (from the clean
    step) saves testing ``start``/``page`` again."""
    if kind is None:
        is_start = is_object(log["start"])
        is_page = ~is_start & is_object(log["page"])
    else:
        is_start = kind == "start"
        is_page = kind == "page"
    singles = F.array(
        F.struct(F.lit("err").alias("route"), to_json_text(as_object(log["err"])).alias("value")),
        F.struct(F.lit("start").alias("route"), F.when(is_start, to_json_text(drop_keys(log, ["err"]))).alias("value")),
        F.struct(
            F.lit("page").alias("route"),
            F.when(is_page, to_json_text(drop_keys(log, ["err", "displays", "actions"]))).alias("value"),
        ),
    )
    empty = F.array().cast(T.ArrayType(ROUTE_RECORD))
    displays = F.when(is_page, _fan_out(log, "displays", "display")).otherwise(empty)
    actions = F.when(is_page, _fan_out(log, "actions", "action")).otherwise(empty)
    return F.filter(F.concat(singles, displays, actions), lambda r: r["value"].isNotNull())


def split_log(fixed: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """T4: one pass from a log to its records on five routes, as ``(*keep, route, value)``.

    * err: the ``err`` object alone, for start and page logs alike; then ``err`` leaves the log.
    * start: the whole log (less ``err``); start wins over page.
    * page: the log less ``err``, ``displays``, ``actions``.
    * display/action: per element, the element with ``common``, ``ts``, ``page`` put in.

    One generator over an array built per row: no union, no second scan of the input.
    """
    kind = F.col("kind") if "kind" in fixed.columns else None
    return fixed.select(*keep, F.inline(route_records(F.col(LOG), kind)))
