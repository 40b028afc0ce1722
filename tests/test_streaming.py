"""Stream = batch for both jobs; restart from checkpoint; replay of a committed batch id."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from wharf.operators.cdc import cdc_clean, config_changes, current_config, dim_changes, parse_config, route, trim
from wharf.operators.dim import apply_changes
from wharf.plans.log_job import log_split
from wharf.sinks.dimstore import DimStore, plan_ddl
from wharf.sources.envelopes import CONFIG_FEED, config_feed, log_envelope, part_changes, supplier_changes
from wharf.sources.files import text_records
from wharf.streaming.dim_stream import dim_sync_batch, start_dim_sync
from wharf.streaming.log_stream import batch_records, known_devices, log_split_batch, start_log_split

SF = "/root/testdata/sf0.001"


def _write_chunks(spark, df, root, bounds):
    """Write ``value`` lines of ``df`` into one file per offset range, oldest mtime first."""
    os.makedirs(f"{root}/flat")
    for i, (lo, hi) in enumerate(bounds):
        tmp = f"{root}/tmp{i}"
        df.where((F.col("offset") >= lo) & (F.col("offset") < hi)).select("value").coalesce(1).write.text(tmp)
        part = [p for p in os.listdir(tmp) if p.startswith("part-")][0]
        dst = f"{root}/flat/f{i}.txt"
        shutil.copy(f"{tmp}/{part}", dst)
        os.utime(dst, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))


def test_log_stream_equals_batch_and_restarts(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 300), (300, 700), (700, 10**9)])
    out, ck = f"{scratch}/out", f"{scratch}/ck"

    def run():
        raw = text_records(spark, f"{scratch}/flat", stream=True, max_files_per_trigger=1)
        q = start_log_split(raw, out, ck, available_now=True)
        q.awaitTermination(600)
        assert q.exception() is None

    run()
    run()  # restart: nothing new, nothing written twice
    s = spark.read.parquet(f"{out}/routes").select("route", "value")
    b = log_split(text_records(spark, f"{scratch}/flat"), keep=("partition", "offset")).select("route", "value")
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0

    # a late file (logs older than everything seen) after a restart: processed, never dropped
    late = [json.dumps({"common": {"mid": "m1", "is_new": "1"}, "page": {"p": 1}, "ts": 1_600_000_000_000 + i}) for i in range(3)]
    with open(f"{scratch}/flat/f9.txt", "w") as fh:
        fh.write("\n".join(late) + "\n")
    os.utime(f"{scratch}/flat/f9.txt", (1_700_001_000, 1_700_001_000))
    n0 = s.count()
    run()
    after = spark.read.parquet(f"{out}/routes")
    assert after.count() == n0 + 3
    # device m1 already has a first-seen date from the earlier batches, so the late '1' logs are repaired
    late_flags = [json.loads(r.value)["common"]["is_new"] for r in after.where(F.col("value").contains("1600000000")).collect()]
    assert late_flags == ["0", "0", "0"]
    told = {r["batch"]: (r["n"], r["late"]) for r in spark.read.parquet(f"{ck}/state/late").collect()}
    assert len(told) == 4 and told[0][1] == 0 and told[3] == (3, 3)  # late logs are counted, and all are there


def test_dim_stream_equals_batch_and_skips_replayed_batch(spark, scratch):
    part = spark.read.parquet(f"{SF}/part.parquet")
    sup = spark.read.parquet(f"{SF}/supplier.parquet")
    changes = part_changes(part).unionByName(supplier_changes(sup))
    # order within a row key = file order: seq 0 in f0, updates in f1, deletes and re-inserts in f2
    seq = F.col("offset") % 16
    staged = changes.withColumn("offset", F.when(F.col("partition") == 1, 0).otherwise(F.when(seq <= 1, seq).otherwise(2)) * 10**9 + F.col("offset"))
    _write_chunks(spark, staged, scratch, [(0, 10**9), (10**9, 2 * 10**9), (2 * 10**9, 10**12)])
    store = DimStore(spark, f"{scratch}/store")
    cfg = lambda: current_config(parse_config(config_feed(spark)))
    raw = text_records(spark, f"{scratch}/flat", stream=True, max_files_per_trigger=1)
    q = start_dim_sync(raw, store, cfg, f"{scratch}/ck", available_now=True, changes=lambda: config_changes(config_feed(spark)))
    q.awaitTermination(600)
    assert q.exception() is None

    expected = apply_changes(dim_changes(trim(route(cdc_clean(changes), cfg()))))
    got = store.snapshot(["dim_part", "dim_supplier"])
    cols = ["sink_table", "row_key", F.to_json("cells").alias("c")]
    e = expected.select(*cols)
    g = got.select(*cols)
    assert g.count() == e.count() > 0
    assert g.exceptAll(e).count() == 0 and e.exceptAll(g).count() == 0
    assert not store.table_exists("dim_nation") and store.table_exists("dim_customer")

    last = store.last_batch()
    before = store.snapshot(["dim_part"]).count()
    again = text_records(spark, f"{scratch}/flat/f2.txt")
    dim_sync_batch(again, last, store, cfg, changes=lambda: config_changes(config_feed(spark)))  # a batch run again
    assert store.last_batch() == last and store.snapshot(["dim_part"]).count() == before
    g = store.snapshot(["dim_part", "dim_supplier"]).select(*cols)
    assert g.exceptAll(e).count() == 0 and e.exceptAll(g).count() == 0


def test_plan_ddl_walks_changes_in_order():
    a = {"source_table": "a", "sink_table": "dim_a", "sink_family": "info", "sink_columns": "x", "sink_row_key": "id"}
    b = dict(a, source_table="b", sink_table="dim_b")
    ev = lambda op, before, after: {"op": op, "before": before, "after": after}
    assert plan_ddl([ev("c", None, a), ev("r", None, b)]) == [("create", "dim_a", "info"), ("create", "dim_b", "info")]
    assert plan_ddl([ev("d", b, None), ev("u", a, dict(a, sink_columns="x,y"))]) == [
        ("drop", "dim_b", None), ("drop", "dim_a", None), ("create", "dim_a", "info")]
    assert plan_ddl([ev("d", a, None), ev("c", None, a)]) == [("drop", "dim_a", None), ("create", "dim_a", "info")]
    assert plan_ddl([ev("u", a, b)]) == [("drop", "dim_a", None), ("drop", "dim_b", None), ("create", "dim_b", "info")]
    assert plan_ddl([ev("u", None, dict(a, sink_family=""))]) == [("drop", "dim_a", None), ("create", "dim_a", None)]


def test_config_feed_fixture_is_valid_json():
    for v in CONFIG_FEED:
        json.loads(v)


def test_store_create_drop_and_batch_dim_job(spark, scratch):
    from wharf.plans.dim_job import dim_sync, run_dim_sync

    store = DimStore(spark, f"{scratch}/s")
    assert store.create_table("dim_x", "it's") and store.table_exists("dim_x")
    assert spark.catalog.tableExists("gmall.dim_x") and spark.table("gmall.dim_x").count() == 0
    assert not store.create_table("dim_x", "info")  # exists: no-op
    assert not store.create_table("dim_y", "") and not store.table_exists("dim_y")  # no family: no table
    assert store.drop_table("dim_x") and not store.table_exists("dim_x")
    assert not store.drop_table("dim_x")  # absent: no-op

    part = spark.read.parquet(f"{SF}/part.parquet")
    cfg = current_config(parse_config(config_feed(spark)))
    raw = part_changes(part)
    store2 = DimStore(spark, f"{scratch}/s2")
    run_dim_sync(raw, cfg, store2, batch_id=0)
    got = store2.snapshot(["dim_part"]).select("row_key", F.to_json("cells").alias("c"))
    exp = dim_sync(raw, cfg).select("row_key", F.to_json("cells").alias("c"))
    assert got.count() == exp.count() > 0 and got.exceptAll(exp).count() == 0


def test_start_log_split_writes_routes_and_quarantine(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 10**9)])
    raw = text_records(spark, f"{scratch}/flat", stream=True)
    q = start_log_split(raw, f"{scratch}/out", f"{scratch}/ck", available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None and not [x for x in spark.streams.active if x.name]
    routes = spark.read.parquet(f"{scratch}/out/routes")
    bad = spark.read.parquet(f"{scratch}/out/quarantine")
    assert set(r.route for r in routes.select("route").distinct().collect()) == {"page", "start", "err", "display", "action"}
    whole = (F.col("event_id") % 101 == 0) | (F.col("event_id") % 103 == 0) | (F.col("event_id") % 107 == 0)
    part = (F.col("event_id") % 7 == 3) & F.col("event_type").isin("error", "click", "view")  # of a good log
    assert bad.where(F.col("reason").rlike("not_(object|array)")).count() == ev.where(~whole & part).count()
    assert bad.count() == ev.where(whole | part).count()


def test_dim_stream_config_change_mid_stream(spark, scratch):
    """Config is re-read every batch: an update drops and recreates its table (D9, rows lost as
    upstream), a delete drops its table and stops its changes."""
    from wharf.sources.kafka import config_change_feed

    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 40")
    sup = spark.read.parquet(f"{SF}/supplier.parquet").where("s_suppkey < 10")
    os.makedirs(f"{scratch}/cfg")
    p_cfg = {"source_table": "part", "sink_table": "dim_part", "sink_family": "info", "sink_columns": "p_partkey,p_name", "sink_row_key": "p_partkey"}
    s_cfg = {"source_table": "supplier", "sink_table": "dim_supplier", "sink_family": "info", "sink_columns": "s_suppkey,s_name", "sink_row_key": "s_suppkey"}
    with open(f"{scratch}/cfg/a.json", "w") as fh:
        fh.write(json.dumps({"op": "r", "before": None, "after": p_cfg, "ts_ms": 1}) + "\n")
        fh.write(json.dumps({"op": "r", "before": None, "after": s_cfg, "ts_ms": 2}) + "\n")
    config = lambda: current_config(parse_config(config_feed_dir()))

    def config_feed_dir():
        return config_change_feed(spark, f"{scratch}/cfg")

    store = DimStore(spark, f"{scratch}/store")
    first = part_changes(part).where(F.col("offset") % 16 == 0).unionByName(supplier_changes(sup))
    dim_sync_batch(first, 0, store, config)
    assert store.snapshot(["dim_part"]).count() == 40 and store.snapshot(["dim_supplier"]).count() == 10

    p2 = dict(p_cfg, sink_columns="p_partkey,p_name,p_size")
    with open(f"{scratch}/cfg/b.json", "w") as fh:
        fh.write(json.dumps({"op": "u", "before": p_cfg, "after": p2, "ts_ms": 3}) + "\n")
        fh.write(json.dumps({"op": "d", "before": s_cfg, "after": None, "ts_ms": 4}) + "\n")
    second = part_changes(part).where(F.col("offset") % 16 == 1).unionByName(supplier_changes(sup))
    dim_sync_batch(second, 1, store, config)
    rows = {r.row_key: dict(r.cells) for r in store.snapshot(["dim_part"]).collect()}
    updated = sorted(int(k) for k in rows)
    assert updated == [k for k in range(40) if k % 3 == 0]  # only this batch's updates survive the recreate
    assert set(rows["3"]) == {"p_partkey", "p_name", "p_size"}
    assert not store.table_exists("dim_supplier") and store.table_exists("dim_part")


def test_store_sees_every_batch_id_and_orders_runs(spark, scratch):
    conf = _one_table(spark)
    first = DimStore(spark, f"{scratch}/s4")
    for i, b in enumerate((0, 5001, 20261200)):
        dim_sync_batch(_dim_raw(spark, [("insert", i, {"id": 1, "x": b})]), b, first, conf)
        assert first.committed(b) and first.read_table("dim_b").first()["cells"]["x"] == str(b)
    assert first.last_batch() == 20261200 and not first.committed(1)
    other = DimStore(spark, f"{scratch}/s4", run=1)  # a new checkpoint: its batch 0 comes after all of run 0
    assert not other.committed(0) and other.last_batch() == -1
    dim_sync_batch(_dim_raw(spark, [("update", 0, {"id": 1, "x": "new"})]), 0, other, conf)
    assert other.read_table("dim_b").first()["cells"]["x"] == "new" and first.last_batch() == 20261200


def _one_table(spark, cols="id,x,y"):
    schema = "source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string, op string"
    return lambda: spark.createDataFrame([("b", "dim_b", "info", cols, "id", "r")], schema)


def test_dim_changes_that_cannot_be_applied_are_quarantined_with_their_text(spark, scratch):
    cfg = [{"op": "r", "source_table": "a", "sink_table": "dim_a", "sink_family": "", "sink_columns": "id", "sink_row_key": "id"},
           {"op": "r", "source_table": "b", "sink_table": "dim_b", "sink_family": "info", "sink_columns": "id", "sink_row_key": "id"}]
    schema = "source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string, op string"
    config = spark.createDataFrame(cfg, schema)
    text = ['{"database":"gmall","table":"%s","type":"insert","ts":1,"data":%s}' % x for x in
            (("a", '{"id":"1"}'), ("b", '{"x":"1"}'), ("b", '{"id":"2"}'))]
    text.append('{"database":"gmall","table":"b","table":"a","type":"insert","ts":1,"data":{"id":"3"}}')
    raw = spark.createDataFrame([(t, 0, i) for i, t in enumerate(text)], "value string, partition int, offset bigint")
    store = DimStore(spark, f"{scratch}/q")
    dim_sync_batch(raw, 0, store, lambda: config)
    bad = {r.value: r.reason for r in spark.read.parquet(f"{scratch}/q/_quarantine").collect()}
    assert bad == {text[0]: "no_table", text[1]: "no_row_key", text[3]: "repeated_key"}
    assert [r.row_key for r in store.snapshot(["dim_b"]).collect()] == ["2"]
    stream = DimStore(spark, f"{scratch}/q", run=1)  # another run with the same batch id
    dim_sync_batch(raw.where("offset = 2").withColumn("value", F.replace("value", F.lit('"2"'), F.lit('"9"'))), 0, stream, lambda: config)
    assert sorted(r.row_key for r in stream.snapshot(["dim_b"]).collect()) == ["2", "9"]


def _dim_raw(spark, records):
    text = [json.dumps({"database": "gmall", "table": "b", "type": typ, "ts": ts, "data": data}) for typ, ts, data in records]
    return spark.createDataFrame([(t, 0, i) for i, t in enumerate(text)], "value string, partition int, offset bigint")


def test_store_appends_what_a_batch_did_and_compacts_apart(spark, scratch):
    """A batch writes its own row keys only; deletes, a batch run again, whole versions and a later DDL read right."""
    conf = lambda cols="id,x,y": _one_table(spark, cols)()
    store = DimStore(spark, f"{scratch}/s")

    def rows(of=None):
        return {r.row_key: dict(r.cells) for r in (of or store).read_table("dim_b").collect()}

    def written(b):
        return spark.read.parquet(f"{scratch}/s/effects/sink_table=dim_b/run=0/batch={b}").count()

    dim_sync_batch(_dim_raw(spark, [("insert", 1, {"id": i, "x": i, "y": 0}) for i in range(500)]), 0, store, conf)
    assert written(0) == 500 and len(rows()) == 500
    dim_sync_batch(_dim_raw(spark, [("update", 2, {"id": 7, "x": None, "y": 5})]), 1, store, conf)
    assert written(1) == 1 and rows()["7"] == {"id": "7", "x": "7", "y": "5"} and len(rows()) == 500
    dim_sync_batch(_dim_raw(spark, [("delete", 3, {"id": 8})]), 2, store, conf)  # a batch of deletes alone
    dim_sync_batch(_dim_raw(spark, [("delete", 4, {"id": 9}), ("insert", 5, {"id": 9, "y": 1})]), 3, store, conf)
    want = rows()
    assert "8" not in want and want["9"] == {"id": "9", "y": "1"} and len(want) == 499
    dim_sync_batch(_dim_raw(spark, [("insert", 6, {"x": 1})]), 4, store, conf)  # nothing to apply
    assert rows() == want and store.committed(4)
    for _ in range(2):  # and once more: the same files
        dim_sync_batch(_dim_raw(spark, [("insert", 7, {"id": "new"})]), 5, store, conf)
    want["new"] = {"id": "new"}
    assert rows() == want and rows(DimStore(spark, f"{scratch}/s")) == want

    assert store.compact() == ["dim_b"] and rows() == want
    assert store.effects(["dim_b"]).select("n").distinct().count() == 1 and store.compact() == []
    dim_sync_batch(_dim_raw(spark, [("update", 8, {"id": 7, "y": 6})]), 6, store, conf)
    want["7"]["y"] = "6"
    assert rows() == want
    # a config update drops and recreates the table: only this batch's rows are there
    dim_sync_batch(_dim_raw(spark, [("insert", 9, {"id": 1, "x": 1})]), 7, store, lambda: conf("id"))
    assert rows() == {"1": {"id": "1"}}
    # a session whose catalog has lost the table finds it again
    spark.sql("DROP TABLE gmall.dim_b")
    assert not store.table_exists("dim_b") and rows(DimStore(spark, f"{scratch}/s")) == {"1": {"id": "1"}}


def _config_file(scratch, name, events):
    os.makedirs(f"{scratch}/cfg", exist_ok=True)
    with open(f"{scratch}/cfg/{name}.json", "w") as fh:
        for ts, op, before, after in events:
            fh.write(json.dumps({"op": op, "before": before, "after": after, "ts_ms": ts}) + "\n")


def test_config_changes_between_two_batches_are_walked_in_order(spark, scratch):
    """Delete and re-create of one config row empties its table, though the config looks the same before and
    after; a renamed source table drops the old sink table and ends the old route; a late change is passed over."""
    from wharf.sources.kafka import config_change_feed

    row = lambda src, sink: {"source_table": src, "sink_table": sink, "sink_family": "info", "sink_columns": "id,x", "sink_row_key": "id"}
    b, c = row("b", "dim_b"), row("c", "dim_c")
    feed = lambda: config_change_feed(spark, f"{scratch}/cfg")
    live, changes = lambda: current_config(parse_config(feed())), lambda: config_changes(feed())
    store = DimStore(spark, f"{scratch}/s")
    keys = lambda t: sorted(r.row_key for r in store.read_table(t).collect())

    def batch(i, table, key):
        rec = json.dumps({"database": "gmall", "table": table, "type": "insert", "ts": i, "data": {"id": key}})
        dim_sync_batch(spark.createDataFrame([(rec, 0, 0)], "value string, partition int, offset bigint"), i, store, live, changes=changes)

    _config_file(scratch, "0", [(10, "r", None, b), (11, "r", None, c)])
    batch(0, "b", "one")
    batch(1, "c", "two")
    assert keys("dim_b") == ["one"] and keys("dim_c") == ["two"]
    _config_file(scratch, "1", [(20, "d", b, None), (21, "c", None, b)])
    batch(2, "b", "three")
    assert keys("dim_b") == ["three"] and keys("dim_c") == ["two"]
    _config_file(scratch, "2", [(30, "u", c, row("c2", "dim_c2"))])
    batch(3, "c2", "four")
    assert not store.table_exists("dim_c") and keys("dim_c2") == ["four"] and keys("dim_c") == []
    batch(4, "c", "five")  # the old name routes nowhere
    assert keys("dim_c2") == ["four"]
    _config_file(scratch, "3", [(15, "d", b, None)])  # older than what has been walked for b
    batch(5, "b", "six")
    assert keys("dim_b") == ["six", "three"]


def test_same_second_changes_keep_the_later_line_in_a_stream(spark, scratch):
    os.makedirs(f"{scratch}/in")
    rec = lambda typ, key, x: json.dumps({"database": "gmall", "table": "b", "type": typ, "ts": 5, "data": {"id": key, "x": x}})
    with open(f"{scratch}/in/a.txt", "w") as fh:
        for k in range(200):
            fh.write(f"{rec('insert', k, 'old')}\n{rec('update', k, 'new')}\n")
    store = DimStore(spark, f"{scratch}/s")
    raw = text_records(spark, f"{scratch}/in", stream=True)
    q = start_dim_sync(raw, store, _one_table(spark), f"{scratch}/ck", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    assert {r.cells["x"] for r in store.read_table("dim_b").collect()} == {"new"}


def test_stream_lines_get_the_positions_of_the_batch_read(spark, scratch):
    import random

    from wharf.sources.files import with_positions

    os.makedirs(f"{scratch}/in")
    for f in range(3):
        with open(f"{scratch}/in/f{f}.txt", "w") as fh:
            fh.write("\n".join(f"{f} {random.Random(f * 1000 + i).random()}" for i in range(500)))
    got = []
    raw = text_records(spark, f"{scratch}/in", stream=True)
    q = raw.writeStream.foreachBatch(lambda b, i: got.extend(map(tuple, with_positions(b).collect()))).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None and sorted(got) == sorted(map(tuple, text_records(spark, f"{scratch}/in").collect()))


def test_stream_repair_needs_no_python_and_spreads_a_hot_device(spark):
    n = 4000
    rows = [(json.dumps({"common": {"mid": "hot", "is_new": "1"}, "page": {"p": i}, "ts": 1_700_000_000_000 + i * 40_000}), 0, i) for i in range(n)]
    batch = spark.createDataFrame(rows, "value string, partition int, offset bigint")
    out = batch_records(batch, spark.createDataFrame([], "mid string, dt string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # a batch this small would be put together again
    spark.conf.set(key, "false")
    try:
        pages = out.where("route = 'page'").withColumn("task", F.spark_partition_id())
        held = [r["count"] for r in pages.groupBy("task").count().collect()]
    finally:
        spark.conf.set(key, "true")
    assert sum(held) == n and len(held) >= 4 and max(held) < n / 2
    assert [(r.value, r.reason) for r in out.where("route = 'device'").collect()] == [("hot", "2023-11-15")]


# ------------------------------------------------------------------ recovery (A3): a job dies at each of its writes


class _Dies(Exception):
    pass


def _die_before(monkeypatch, piece):
    """The first write to a path that holds ``piece`` fails."""
    from pyspark.sql.readwriter import DataFrameWriter

    real, left = DataFrameWriter.parquet, [1]

    def parquet(self, path, *args, **kwargs):
        if piece in path and left[0]:
            left[0] -= 1
            raise _Dies(piece)
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return left


def _rows_of(spark, path, *drop):
    return sorted(repr(r) for r in spark.read.parquet(path).drop(*drop).collect())


@pytest.mark.parametrize("piece", ["/quarantine/batch=1", "/devices/batch=1", "/late/batch=1"])
def test_log_stream_recovers_from_a_death_at_each_write(spark, scratch, monkeypatch, piece):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 300), (300, 700), (700, 10**9)])

    def run(name):
        raw = text_records(spark, f"{scratch}/flat", stream=True, max_files_per_trigger=1)
        q = start_log_split(raw, f"{scratch}/{name}", f"{scratch}/{name}-ck", available_now=True)
        try:
            q.awaitTermination(300)
        except Exception as e:
            assert "_Dies" in str(e)

    run("clean")
    left = _die_before(monkeypatch, piece)
    run("again")
    assert not left[0]
    run("again")
    for sub in ("routes", "quarantine"):
        assert _rows_of(spark, f"{scratch}/again/{sub}") == _rows_of(spark, f"{scratch}/clean/{sub}")
    assert _rows_of(spark, f"{scratch}/again-ck/state/devices", "seen") == _rows_of(spark, f"{scratch}/clean-ck/state/devices", "seen")
    assert _rows_of(spark, f"{scratch}/again-ck/state/late") == _rows_of(spark, f"{scratch}/clean-ck/state/late")


@pytest.mark.parametrize("piece", ["/ddl/run=0/batch=1", "/_quarantine/run=0/batch=1", "/done/run=0/batch=1"])
def test_dim_stream_recovers_from_a_death_at_each_write(spark, scratch, monkeypatch, piece):
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 60")
    seq = F.col("offset") % 16
    staged = part_changes(part).withColumn("offset", F.when(seq <= 1, seq).otherwise(2) * 10**9 + F.col("offset"))
    _write_chunks(spark, staged, scratch, [(0, 10**9), (10**9, 2 * 10**9), (2 * 10**9, 10**12)])
    p = json.loads(CONFIG_FEED[0])["after"]
    events = [(1, "r", None, p), (2, "u", p, dict(p, sink_columns="p_partkey,p_name"))]

    def run(name):
        from wharf.sources.kafka import config_change_feed

        feed = lambda: config_change_feed(spark, f"{scratch}/cfg")
        store = DimStore(spark, f"{scratch}/{name}")
        work = lambda b, i: (_config_file(scratch, "0", events[: 1 + (i > 0)]), dim_sync_batch(
            b, i, store, lambda: current_config(parse_config(feed())), changes=lambda: config_changes(feed())))
        raw = text_records(spark, f"{scratch}/flat", stream=True, max_files_per_trigger=1)
        q = raw.writeStream.foreachBatch(work).option("checkpointLocation", f"{scratch}/{name}-ck").trigger(availableNow=True).start()
        try:
            q.awaitTermination(300)
        except Exception as e:
            assert "_Dies" in str(e)
        return store

    want = run("clean").read_table("dim_part").collect()
    left = _die_before(monkeypatch, piece)
    run("again")
    assert not left[0]
    store = run("again")
    assert len(want) and sorted(map(repr, store.read_table("dim_part").collect())) == sorted(map(repr, want))
    assert _rows_of(spark, f"{scratch}/again/_quarantine") == _rows_of(spark, f"{scratch}/clean/_quarantine")
    assert _rows_of(spark, f"{scratch}/again/ddl") == _rows_of(spark, f"{scratch}/clean/ddl")


def test_effects_of_batches_fold_to_the_table(spark):
    """Batches cut anywhere, applied one after the other, give what one apply of all changes gives."""
    import random

    from wharf.operators.dim import fold_effects, row_effects

    from tests.test_cdc_dim import _changes

    for seed in (3, 4):
        rng = random.Random(seed)
        ops = []
        for _ in range(200):
            rk = f"k{rng.randrange(12)}"
            cells = {c: (None if rng.random() < 0.3 else rng.randrange(99)) for c in rng.sample(["a", "b", "c"], 2)}
            ops.append((rk, "delete", {}) if rng.random() < 0.15 else (rk, "update", cells))
        ch = _changes(spark, ops)
        for null_cells in ("keep_old", "overwrite"):
            parts = [row_effects(ch.where(F.col("offset").between(a, b)), null_cells).withColumn("n", F.lit(a)) for a, b in ((0, 60), (61, 140), (141, 199))]
            got = fold_effects(parts[0].unionByName(parts[1]).unionByName(parts[2]))
            exp = apply_changes(ch, null_cells=null_cells)
            as_rows = lambda d: {r.row_key: dict(r.cells) for r in d.collect()}
            assert as_rows(got) == as_rows(exp), (seed, null_cells)


def test_batch_lines_of_one_file_keep_their_order(spark, scratch):
    import random

    lines = [f"line {random.Random(i).random()}" for i in range(200)]
    with open(f"{scratch}/f.txt", "w") as fh:
        fh.write("\n".join(lines))
    got = text_records(spark, f"{scratch}/f.txt").orderBy("partition", "offset").collect()
    assert [r.value for r in got] == lines


def test_sql_job_over_a_stream(spark, scratch):
    """A2/P5: the same SQL text over the streaming topic view."""
    from wharf.plans.sql_job import comment_info
    from wharf.sources.envelopes import comment_changes

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    staged = comment_changes(orders).unionByName(part_changes(spark.read.parquet(f"{SF}/part.parquet")))
    _write_chunks(spark, staged, scratch, [(0, 10**12)])
    raw = text_records(spark, f"{scratch}/flat", stream=True)
    rows = comment_info(spark, raw)
    assert rows.isStreaming
    q = (rows.select("ts", F.col("data")["id"].alias("id")).writeStream.format("memory").queryName("comments_out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    assert spark.table("comments_out").count() == orders.count()


def test_cli_log_split_batch(spark, scratch):
    from wharf.__main__ import main

    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 10**9)])
    main(["log-split", "--input", f"{scratch}/flat", "--output", f"{scratch}/out"])
    out = spark.read.parquet(f"{scratch}/out")
    routes = {r.route for r in out.select("route").distinct().collect()}
    assert routes == {"page", "start", "err", "display", "action", "quarantine"}


def test_run_stream_template_and_console(spark, scratch, capsys):
    from wharf.config import StreamOptions
    from wharf.operators.logs import log_clean
    from wharf.sinks.routed import print_routes
    from wharf.streaming.runner import run_stream

    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 10**9)])
    raw = text_records(spark, f"{scratch}/flat", stream=True)

    def sink(df, ck):
        return df.select("mid", "ts").writeStream.format("parquet").option("path", f"{scratch}/o").option("checkpointLocation", ck)

    q = run_stream(raw, log_clean, sink, "clean_only", StreamOptions(available_now=True), checkpoint=f"{scratch}/ck")
    q.awaitTermination(600)
    assert q.exception() is None
    assert spark.read.parquet(f"{scratch}/o").count() == log_clean(text_records(spark, f"{scratch}/flat")).count()
    print_routes(spark.createDataFrame([("page", "{}")], "route string, value string"))
    assert "page> {}" in capsys.readouterr().out


def test_log_stream_with_state_ttl(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 10**9)])
    raw = text_records(spark, f"{scratch}/flat", stream=True)
    q = start_log_split(raw, f"{scratch}/o", f"{scratch}/ck", available_now=True, ttl_ms=7 * 24 * 3600 * 1000)
    assert q.awaitTermination(300) and q.exception() is None
    s = spark.read.parquet(f"{scratch}/o/routes").select("route", "value")
    b = log_split(text_records(spark, f"{scratch}/flat")).select("route", "value")
    assert s.count() == b.count() > 0 and s.exceptAll(b).count() == 0
    state = f"{scratch}/ck/state"
    assert known_devices(spark, state, 1, 3_600_000).count() == known_devices(spark, state, 1).count() > 0
    assert known_devices(spark, state, 1, 1).count() == 0  # all are older than a millisecond
    assert known_devices(spark, state, 0).count() == 0  # a batch sees earlier batches only


def test_cli_dim_sync_batch(spark, scratch):
    from wharf.__main__ import main

    part = spark.read.parquet(f"{SF}/part.parquet")
    _write_chunks(spark, part_changes(part), scratch, [(0, 10**12)])
    os.makedirs(f"{scratch}/cfg")
    with open(f"{scratch}/cfg/a.json", "w") as fh:
        for i, v in enumerate(CONFIG_FEED):
            rec = json.loads(v)
            rec["ts_ms"] = i
            fh.write(json.dumps(rec) + "\n")
        fh.write("{broken\n")
    main(["dim-sync", "--input", f"{scratch}/flat", "--config", f"{scratch}/cfg", "--store", f"{scratch}/store", "--batch-id", "0"])
    store = DimStore(spark, f"{scratch}/store")
    refused = spark.read.parquet(f"{scratch}/store/_config_refused").collect()
    assert [(r.value, r.reason) for r in refused] == [("{broken", "no_op")]
    exp = apply_changes(dim_changes(trim(route(cdc_clean(part_changes(part)), current_config(parse_config(config_feed(spark)))))))
    got = store.snapshot(["dim_part"]).select("row_key", F.to_json("cells").alias("c"))
    e = exp.select("row_key", F.to_json("cells").alias("c"))
    assert got.count() == e.count() > 0 and got.exceptAll(e).count() == 0


def _cli(*args):
    """One job in a process of its own, with the session that the job itself makes."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    conf = "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    env = dict(os.environ, PYTHONPATH=root, PYSPARK_SUBMIT_ARGS=conf)
    done = subprocess.run([sys.executable, "-m", "wharf", *args], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_job_session_applies_cluster_settings_that_nothing_else_names():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("from wharf.session import job_session; s = job_session('x'); "
            "print(s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.files.maxPartitionBytes'))")
    env = dict(os.environ, PYTHONPATH=root, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.sql.shuffle.partitions=4 pyspark-shell")
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)
    assert done.stdout.split() == ["4", "256m"], done.stderr[-2000:]


def test_cli_log_stream_in_its_own_process(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    _write_chunks(spark, log_envelope(ev), scratch, [(0, 10**9)])
    _cli("log-stream", "--input", f"{scratch}/flat", "--output", f"{scratch}/out", "--checkpoint", f"{scratch}/ck",
         "--max-files", "1", "--trigger", "1 seconds", "--watermark", "3 seconds", "--available-now")
    got = spark.read.parquet(f"{scratch}/out/routes").select("route", "value")
    exp = log_split(text_records(spark, f"{scratch}/flat")).select("route", "value")
    assert got.count() == exp.count() > 0 and got.exceptAll(exp).count() == 0
    assert spark.read.parquet(f"{scratch}/out/quarantine").count() > 0


def test_cli_dim_stream_with_preload_then_compaction(spark, scratch):
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 60")
    _write_chunks(spark, part_changes(part), scratch, [(0, 300), (300, 10**12)])
    os.makedirs(f"{scratch}/cfg")
    open(f"{scratch}/cfg/a.json", "w").close()  # a feed without a record: the snapshot alone routes
    with open(f"{scratch}/pre.json", "w") as fh:
        fh.write(json.dumps({"source_table": "part", "sink_table": "dim_part", "sink_family": "info", "sink_columns": "p_partkey,p_name,p_size", "sink_row_key": "p_partkey"}))
    _cli("dim-stream", "--input", f"{scratch}/flat", "--config", f"{scratch}/cfg", "--preload", f"{scratch}/pre.json", "--store", f"{scratch}/store",
         "--checkpoint", f"{scratch}/ck", "--max-files", "1", "--available-now")
    store = DimStore(spark, f"{scratch}/store")
    config = spark.read.json(f"{scratch}/pre.json")
    exp = apply_changes(dim_changes(trim(route(cdc_clean(part_changes(part)), config)))).select("row_key", F.to_json("cells").alias("c"))
    got = store.read_table("dim_part").select("row_key", F.to_json("cells").alias("c"))
    assert got.count() == exp.count() > 0 and got.exceptAll(exp).count() == 0
    assert store.effects(["dim_part"]).select("n").distinct().count() == 2
    _cli("dim-compact", "--store", f"{scratch}/store")
    store = DimStore(spark, f"{scratch}/store")
    spark.sql("REFRESH TABLE gmall.dim_part")
    got = store.read_table("dim_part").select("row_key", F.to_json("cells").alias("c"))
    assert store.effects(["dim_part"]).select("n").distinct().count() == 1 and got.count() == exp.count() and got.exceptAll(exp).count() == 0


def test_cli_sql_job(spark, scratch):
    from wharf.__main__ import main
    from wharf.sources.envelopes import comment_changes

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    _write_chunks(spark, comment_changes(orders), scratch, [(0, 10**12)])
    with open(f"{scratch}/q.sql", "w") as fh:
        fh.write("SELECT data['id'] AS id, ts FROM topic_db WHERE `table` = 'comment_info'")
    main(["sql", "--input", f"{scratch}/flat", "--sql", f"{scratch}/q.sql", "--output", f"{scratch}/out"])
    assert spark.read.parquet(f"{scratch}/out").count() == orders.count()


def test_routes_without_a_topic_do_not_reach_kafka(spark):
    from wharf.sinks.routed import kafka_frame

    rows = spark.createDataFrame([("page", "{}"), ("quarantine", "x")], "route string, value string")
    assert [(r.topic, r.value) for r in kafka_frame(rows).collect()] == [("dwd_traffic_page", "{}")]
