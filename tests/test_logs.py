"""Log clean, repair and split on hand-written logs (FIXTURES §1), including decisions D1-D5."""

import json
import random

from pyspark.sql import functions as F

from wharf.functions.jsonx import get_string
from wharf.operators.logs import LOG, fix_is_new, log_clean, log_quarantine, split_log

GOOD = [
    '{"common":{"mid":"m1","is_new":"1","ch":"web"},"page":{"page_id":"home"},"displays":[{"item":"7"},{"item":"9"}],'
    '"actions":[{"action_id":"fav"}],"err":{"code":5},"ts":1704067207179}',
    '{"common":{"mid":"m2","is_new":"0"},"start":{"entry":"icon"},"ts":1704067207180}',
]
BAD = {
    '{"common":{"mid":"m1"': "unparseable",
    "": "unparseable",
    None: "unparseable",
    '{"page":{"a":1},"ts":1}': "no_common",
    '{"common":{"is_new":"1"},"page":{"a":1},"ts":1}': "no_mid",
    '{"common":{"mid":"x"},"page":{"a":1}}': "no_ts",
    '{"common":{"mid":"x"},"page":{"a":1},"ts":"abc"}': "bad_field_type",
    '{"common":{"mid":"x"},"ts":1}': "no_page_or_start",
    '{"common":{"mid":"x"},"err":{"code":1},"ts":1}': "no_page_or_start",
    '{"common":{"mid":"x"},"page":null,"ts":1}': "no_page_or_start",
    "[1,2]": "unparseable",
}


def raw(spark, values):
    return spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], "value string, partition int, offset bigint")


def routes(spark, values, **kw):
    r = split_log(fix_is_new(log_clean(raw(spark, values)), **kw), keep=["offset"])
    return [(x.offset, x.route, json.loads(x.value)) for x in r.collect()]


def test_clean_keeps_good_and_quarantines_bad(spark):
    vals = GOOD + list(BAD)
    clean = log_clean(raw(spark, vals)).collect()
    assert sorted(r.offset for r in clean) == [0, 1]
    q = {r.offset: r.reason for r in log_quarantine(raw(spark, vals)).collect()}
    for i, v in enumerate(vals[2:], start=2):
        assert q[i] == BAD[v], v


def test_numeric_text_ts_accepted_and_kept_as_text(spark):
    v = '{"common":{"mid":"m2","is_new":"0"},"start":{"entry":"icon"},"ts":"17"}'
    c = log_clean(raw(spark, [v])).collect()
    assert c[0].ts == 17
    out = routes(spark, [v])
    assert out[0][1] == "start" and out[0][2]["ts"] == "17"


def test_split_fixture_line(spark):
    out = routes(spark, GOOD)
    by = {}
    for _, route, rec in out:
        by.setdefault(route, []).append(rec)
    assert by["err"] == [{"code": 5}]
    assert len(by["display"]) == 2 and len(by["action"]) == 1
    page = by["page"][0]
    assert set(page) == {"common", "page", "ts"}
    d = by["display"][0]
    assert d["common"]["mid"] == "m1" and d["ts"] == 1704067207179 and d["page"] == {"page_id": "home"}
    assert by["start"][0]["start"] == {"entry": "icon"} and "err" not in by["start"][0]


def test_split_edges(spark):
    vals = [
        # start wins over page; displays stay inside the start record
        '{"common":{"mid":"a","is_new":"1"},"start":{"e":1},"page":{"p":1},"displays":[{"i":1}],"ts":1}',
        # empty displays, null and non-object elements, a display with its own common
        '{"common":{"mid":"b","is_new":"1"},"page":{"p":1},"displays":[],"actions":[null,5,{"common":"x","a":1}],"ts":2}',
        # missing is_new passes unrepaired (D3)
        '{"common":{"mid":"c"},"page":{"p":1},"ts":3}',
        # a null-valued top-level key is left out of the output
        '{"common":{"mid":"d","is_new":"1"},"page":{"p":1},"extra":null,"other":{"k":[1,2]},"ts":4}',
    ]
    out = routes(spark, vals)
    routes_by = {}
    for off, route, rec in out:
        routes_by.setdefault(off, []).append((route, rec))
    assert [r for r, _ in routes_by[0]] == ["start"]
    assert routes_by[0][0][1]["displays"] == [{"i": 1}]
    b = sorted(r for r, _ in routes_by[1])
    assert b == ["action", "page"]
    act = [rec for r, rec in routes_by[1] if r == "action"][0]
    assert act["common"] == {"mid": "b", "is_new": "1"} and act["a"] == 1
    assert routes_by[2][0][1]["common"] == {"mid": "c"}
    page = routes_by[3][0][1]
    assert "extra" not in page and page["other"] == {"k": [1, 2]}


DAY = 86_400_000
T0 = 1704067200000  # 2024-01-01 00:00 UTC = 08:00 at +08:00


def _replay(rows, rule):
    """Row-at-a-time replay of the upstream state machine (dates at +08:00)."""
    import datetime as dt

    def d(ms):
        return (dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc) + dt.timedelta(hours=8)).strftime("%Y-%m-%d")

    state, out = {}, {}
    for mid, ts, off, flag in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.get(mid)
        new = flag
        if flag == "1":
            if s is not None and ((s != d(ts)) if rule == "later_day" else (s == d(ts))):
                new = "0"
            elif s is None:
                state[mid] = d(ts)
        elif flag == "0" and s is None:
            state[mid] = d(ts - DAY)
        out[off] = new
    return out


def test_fix_is_new_matches_replay_on_shuffled_input(spark):
    for seed in (1, 2, 3):
        rng = random.Random(seed)
        rows = []
        for off in range(400):
            mid = f"m{rng.randrange(12)}"
            ts = T0 + rng.randrange(6) * DAY + rng.randrange(DAY)
            flag = rng.choice(["1", "1", "0", "2", None])
            rows.append((mid, ts, off, flag))
        rng.shuffle(rows)
        vals = []
        for mid, ts, off, flag in rows:
            common = {"mid": mid} if flag is None else {"mid": mid, "is_new": flag}
            vals.append((json.dumps({"common": common, "page": {"p": 1}, "ts": ts}), 0, off))
        df = spark.createDataFrame(vals, "value string, partition int, offset bigint").repartition(4)
        for rule in ("later_day", "same_day"):
            f = fix_is_new(log_clean(df), rule=rule)
            got = {r.offset: r.f for r in f.select("offset", get_string(F.col(LOG)["common"], "$.is_new").alias("f")).collect()}
            assert got == _replay(rows, rule), (seed, rule)


def test_flag_type_int_writes_number(spark):
    vals = [
        '{"common":{"mid":"m","is_new":"1"},"page":{"p":1},"ts":%d}' % T0,
        '{"common":{"mid":"m","is_new":"1"},"page":{"p":1},"ts":%d}' % (T0 + 2 * DAY),
    ]
    out = routes(spark, vals, flag_type="int")
    flags = sorted((o, rec["common"]["is_new"]) for o, r, rec in out if r == "page")
    assert flags == [(0, "1"), (1, 0)]


def test_parse_once_in_optimized_plan(spark):
    df = log_clean(raw(spark, GOOD))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_event_time_never_drops_rows(spark):
    from wharf.operators.logs import with_event_time

    c = with_event_time(log_clean(raw(spark, GOOD)), watermark="3 seconds")
    rows = c.select("ts", "event_time").collect()
    assert len(rows) == 2 and all(r.event_time is not None for r in rows)


def test_split_plan_has_no_python_and_one_generator_pass(spark):
    df = split_log(fix_is_new(log_clean(raw(spark, GOOD))), keep=["offset"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "Union" not in plan


def test_hot_device_is_salted_and_split(spark):
    """One device holds a third of all logs: results equal the replay whatever the number of buckets, and the
    only window runs over a row per device and bucket."""
    n = 6000
    rows, vals = [], []
    for i in range(n):
        mid = "hot" if i % 3 == 0 else f"m{i % 97}"
        flag = "1" if i % 5 else "0"
        ts = T0 + i * 97_000
        rows.append((mid, ts, i, flag))
        vals.append((json.dumps({"common": {"mid": mid, "is_new": flag}, "page": {"p": 1}, "ts": ts}), 0, i))
    df = spark.createDataFrame(vals, "value string, partition int, offset bigint").repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for salt in (1, 2, 40, None):
            f = fix_is_new(log_clean(df), salt=salt).select("offset", "is_new")
            assert {r.offset: r.is_new for r in f.collect()} == _replay(rows, "later_day")
        plan = f._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "_bucket" in plan and "windowspecdefinition(_m" in plan and plan.count("Window [") == plan.count("windowspecdefinition(_m")


def test_one_plan_for_routes_and_quarantine(spark, scratch):
    from wharf.plans.log_job import log_split, log_split_all, run_log_split

    vals = GOOD + [v for v in BAD if v is not None] + [
        # bad (page not an object) but with a flag: must not set the device's stored date
        '{"common":{"mid":"m9","is_new":"1"},"page":5,"ts":%d}' % T0,
        '{"common":{"mid":"m9","is_new":"1"},"page":{"p":1},"ts":%d}' % (T0 + 3 * DAY),
    ]
    df = raw(spark, vals)
    allr = log_split_all(df)
    good = allr.where("route <> 'quarantine'").select("offset", "route", "value")
    ref = log_split(df).select("offset", "route", "value")
    assert good.exceptAll(ref).count() == 0 and ref.exceptAll(good).count() == 0
    q = {r.offset: (r.reason, r.value) for r in allr.where("route = 'quarantine'").collect()}
    exp = {r.offset: (r.reason, r.value) for r in log_quarantine(df).collect()}
    assert q == exp
    m9 = [json.loads(r.value) for r in allr.where("route = 'page' and value like '%m9%'").collect()]
    assert [x["common"]["is_new"] for x in m9] == ["1"]
    plan = allr._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    run_log_split(df, f"{scratch}/out")
    assert spark.read.parquet(f"{scratch}/out").where("route = 'quarantine'").count() == len(exp)


def test_bad_rows_without_device_spread_over_partitions(spark):
    """A third of the input unparseable (NULL device): the one-plan job keeps them whole and spreads
    them over the join's partitions instead of one NULL-key partition."""
    from wharf.plans.log_job import log_split_all

    vals = []
    for i in range(3000):
        if i % 3 == 0:
            vals.append(('{"common":', 0, i))
        else:
            vals.append((json.dumps({"common": {"mid": f"m{i % 50}", "is_new": "1"}, "page": {"p": 1}, "ts": T0 + i}), 0, i))
    df = spark.createDataFrame(vals, "value string, partition int, offset bigint").repartition(8)
    out = log_split_all(df)
    assert out.where("route = 'quarantine'").count() == 1000
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # an input this small would be put together again
    spark.conf.set(key, "false")
    try:
        sizes = (
            out.where("route = 'quarantine'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        )
    finally:
        spark.conf.set(key, "true")
    assert len(sizes) >= 4  # not one partition


def test_nulls_are_left_out_at_every_depth(spark):
    import json
    import random

    from wharf.functions.jsonx import drop_null_members

    rng = random.Random(2)
    texts = ["a", '"n":null,', "{,", "x\\", '":null}', "\n{", '"', ",", 'k":null']

    def value(depth):
        k = rng.random()
        if k < 0.25 or depth > 3:
            return None
        if k < 0.5:
            return rng.choice(texts)
        if k < 0.55:
            return rng.randrange(9)
        if k < 0.8:
            return {rng.choice(["a", "b", 'c"', "{", "n:", "null", "\\"]): value(depth + 1) for _ in range(rng.randrange(4))}
        return [value(depth + 1) for _ in range(rng.randrange(4))]

    def bare(v):
        if isinstance(v, dict):
            return {k: bare(x) for k, x in v.items() if x is not None}
        return [bare(x) for x in v] if isinstance(v, list) else v

    objects = [{"r": value(0), "q": value(0), "z": value(0)} for _ in range(2000)]
    objects += [{}, {"a": None}, {"a": None, "b": None}, {"t": '\n"\\' * 30000, "n": None}]
    df = spark.createDataFrame([(json.dumps(o),) for o in objects], "v string")
    rows = df.select("v", drop_null_members(F.to_json(F.parse_json("v"))).alias("s")).collect()
    assert all(json.loads(r.s) == bare(json.loads(r.v)) for r in rows)


def test_lateness_equals_a_running_maximum_over_blocks(spark, monkeypatch):
    import random

    from wharf.operators import logs

    monkeypatch.setattr(logs, "LATE_BLOCK", 7)
    rng = random.Random(4)
    rows = [(p, o, 10_000 + o * 500 + rng.randrange(-6000, 6000)) for p in (0, 1, None) for o in range(200)]
    rng.shuffle(rows)
    found = logs.with_lateness(spark.createDataFrame(rows, "partition int, offset bigint, ts bigint"), 3000).collect()
    most, wanted = {}, {}
    for p, o, ts in sorted(rows, key=lambda r: r[1]):
        wanted[p, o] = p in most and ts < most[p] - 3000
        most[p] = max(ts, most.get(p, ts))
    assert {(r.partition, r.offset): r.late for r in found} == wanted and 0 < sum(wanted.values()) < len(rows)


def test_repair_reads_and_parses_once_and_shuffles_logs_once(spark, scratch):
    from wharf.plans.log_job import log_split_all
    from wharf.sources.files import text_records

    with open(f"{scratch}/a.txt", "w") as fh:
        for i in range(50):
            fh.write(json.dumps({"common": {"mid": f"m{i % 7}", "is_new": "1"}, "page": {"p": 1}, "ts": T0 + i}) + "\n")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = log_split_all(text_records(spark, f"{scratch}/a.txt"))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert final.count("FileScan") == final.count("from_json") == final.count("ReusedExchange") == 1


def test_each_record_is_written_as_json_once(spark):
    from wharf.functions.jsonx import parse_object, to_json_text

    rows = [('{"a":1,"b":{"c":null,"d":[null]},"e":null}',), ('{"a":"x:null"}',), ("{}",), ("[1]",), (None,)]
    df = spark.createDataFrame(rows, "value string").select("value", parse_object("value").alias("m"))
    out = df.select("value", to_json_text(F.col("m")).alias("t"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
    texts = {r.value: r.t and json.loads(r.t) for r in out.collect()}
    assert texts == {rows[0][0]: {"a": 1, "b": {"d": [None]}}, '{"a":"x:null"}': {"a": "x:null"}, "{}": {}, "[1]": None, None: None}
