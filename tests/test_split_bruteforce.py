"""T4 against a plain-Python split of the same logs (brute force on a random fixture, several seeds)."""

import json
import random
from collections import Counter

from wharf.operators.logs import fix_is_new, log_clean, log_quarantine, split_log
from wharf.plans.log_job import log_split_all


def _drop_nulls(v):
    """Null-valued keys go at every depth; nulls in arrays stay."""
    if isinstance(v, dict):
        return {k: _drop_nulls(x) for k, x in v.items() if x is not None}
    return [_drop_nulls(x) for x in v] if isinstance(v, list) else v


def _split(log):
    """The split rules, row at a time, for a good log whose flag needs no repair."""
    out = []
    if isinstance(log.get("err"), dict):
        out.append(("err", _drop_nulls(log["err"])))
    base = {k: v for k, v in log.items() if k != "err"}
    ts = int(log["ts"])
    if isinstance(log.get("start"), dict):
        out.append(("start", _drop_nulls(base)))
    elif isinstance(log.get("page"), dict):
        out.append(("page", _drop_nulls({k: v for k, v in base.items() if k not in ("displays", "actions")})))
        for key, route in (("displays", "display"), ("actions", "action")):
            elems = log.get(key)
            if not isinstance(elems, list):
                continue
            for e in elems:
                if isinstance(e, dict):
                    rec = {k: v for k, v in e.items() if k not in ("common", "ts", "page")}
                    rec.update(common=log["common"], ts=ts, page=log["page"])
                    out.append((route, _drop_nulls(rec)))
    return out


def _bad_parts(log):
    """The parts of a good log that no route takes, with the reason."""
    out = []
    if log.get("err") is not None and not isinstance(log["err"], dict):
        out.append(("err_not_object", log["err"]))
    if not isinstance(log.get("start"), dict):
        for key, reason in (("displays", "display_not_object"), ("actions", "action_not_object")):
            elems = log.get(key)
            if isinstance(elems, list):
                out += [(reason, e) for e in elems if not isinstance(e, dict)]
            elif elems is not None:
                out.append((f"{key}_not_array", elems))
    return out


def _random_log(rng, i):
    def elem():
        return rng.choice([None, 7, "x", {"item": rng.randrange(9), "pos": None},
                           {"item": 1, "common": "own", "ts": 0, "k": {"n": None}}])

    log = {"common": {"mid": f"m{i}", "is_new": rng.choice(["0", "2", None]), "ch": rng.choice(["a", None])},
           "ts": rng.choice([1704067200000 + i, str(1704067200000 + i)])}
    kind = rng.choice(["page", "start", "both"])
    if kind in ("page", "both"):
        log["page"] = {"page_id": f"p{i % 3}", "extra": None}
    if kind in ("start", "both"):
        log["start"] = {"entry": "icon"}
    if rng.random() < 0.5:
        log["err"] = {"code": i, "msg": None}
    for key in ("displays", "actions"):
        r = rng.random()
        if r < 0.3:
            log[key] = [elem() for _ in range(rng.randrange(4))]
        elif r < 0.4:
            log[key] = None
        elif r < 0.5:
            log[key] = rng.choice(["nope", 7, {"item": 1}, True])
    if "err" not in log and rng.random() < 0.3:
        log["err"] = rng.choice([None, "boom", 5, [1, {"code": 2}]])
    if rng.random() < 0.5:
        log["extra"] = rng.choice([None, {"deep": [1, None]}, 3.5])
    return log


def test_split_matches_bruteforce(spark):
    for seed in (21, 22, 23):
        rng = random.Random(seed)
        logs = [_random_log(rng, i) for i in range(150)]
        # flags "0"/"2"/missing are never repaired, so the split sees the logs as written
        df = spark.createDataFrame([(json.dumps(l), 0, i) for i, l in enumerate(logs)], "value string, partition int, offset bigint")
        got = Counter(
            (r.offset, r.route, json.dumps(json.loads(r.value), sort_keys=True))
            for r in split_log(fix_is_new(log_clean(df)), keep=["offset"]).collect()
        )
        want = Counter(
            (i, route, json.dumps(rec, sort_keys=True)) for i, l in enumerate(logs) for route, rec in _split(l)
        )
        assert got == want, seed
        # what no route takes is in the quarantine, from the operator and from the one-plan job alike
        want = Counter((i, reason, json.dumps(part, sort_keys=True)) for i, l in enumerate(logs) for reason, part in _bad_parts(l))
        for found in (log_quarantine(df), log_split_all(df).where("route = 'quarantine'")):
            got = Counter((r.offset, r.reason, json.dumps(json.loads(r.value), sort_keys=True)) for r in found.collect())
            assert got == want, seed


def _dim_replay(records, config, keep_old=True):
    """Clean, route, trim and apply, record at a time, in (ts, offset) order."""
    parsed = []
    for off, text in enumerate(records):
        try:
            parsed.append((off, json.loads(text)))
        except (TypeError, ValueError):
            continue
    tables = {}
    for off, rec in sorted(parsed, key=lambda x: (x[1].get("ts", 0), x[0])):
        if rec.get("database") != "gmall" or rec.get("type") in ("bootstrap-start", "bootstrap-complete"):
            continue
        data = rec.get("data")
        if not isinstance(data, dict) or rec.get("table") not in config:
            continue
        sink, cols, rk = config[rec["table"]]
        key = data.get(rk)
        if key is None:
            continue
        key = str(key)
        data = {k: v for k, v in data.items() if k in cols}
        t = tables.setdefault(sink, {})
        if rec.get("type") == "delete":
            t.pop(key, None)
            continue
        cells = t.get(key, {})
        for k, v in data.items():
            if v is None:
                if not keep_old:
                    cells.pop(k, None)
            else:
                cells[k] = str(v)
        if cells:
            t[key] = cells
        else:
            t.pop(key, None)
    return {(s, k): c for s, t in tables.items() for k, c in t.items()}


def test_dim_path_matches_bruteforce(spark):
    from wharf.operators.cdc import cdc_clean, current_config, dim_changes, parse_config, route, trim
    from wharf.operators.dim import apply_changes

    feed = [
        json.dumps({"op": "r", "before": None, "after": {"source_table": "a", "sink_table": "dim_a", "sink_family": "f",
                                                        "sink_columns": "id, x, y", "sink_row_key": "id"}}),
        json.dumps({"op": "r", "before": None, "after": {"source_table": "b", "sink_table": "dim_b", "sink_family": "f",
                                                        "sink_columns": "k,z", "sink_row_key": "k"}}),
    ]
    config = {"a": ("dim_a", {"id", "x", "y"}, "id"), "b": ("dim_b", {"k", "z"}, "k")}
    cfg = current_config(parse_config(spark.createDataFrame([(v, 0, i) for i, v in enumerate(feed)], "value string, partition int, offset bigint")))
    for seed in (31, 32, 33):
        rng = random.Random(seed)
        records = []
        for i in range(400):
            table = rng.choice(["a", "a", "b", "c"])
            rk = "id" if table == "a" else "k"
            data = {rk: rng.randrange(12)} if rng.random() < 0.93 else {}
            for col in ("x", "y", "z", "w"):
                if rng.random() < 0.5:
                    data[col] = rng.choice([None, rng.randrange(100), f"s{rng.randrange(5)}"])
            rec = {"database": rng.choice(["gmall"] * 9 + ["other"]), "table": table, "ts": 1700000000 + rng.randrange(50),
                   "type": rng.choice(["insert", "update", "update", "delete", "bootstrap-insert", "bootstrap-start"])}
            r = rng.random()
            if r < 0.9:
                rec["data"] = data
            elif r < 0.95:
                rec["data"] = None
            text = json.dumps(rec)
            records.append(text[: len(text) // 2] if rng.random() < 0.03 else text)
        df = spark.createDataFrame([(v, 0, i) for i, v in enumerate(records)], "value string, partition int, offset bigint").repartition(4)
        for keep_old in (True, False):
            dim = apply_changes(dim_changes(trim(route(cdc_clean(df), cfg))), null_cells="keep_old" if keep_old else "overwrite")
            got = {(r.sink_table, r.row_key): dict(r.cells) for r in dim.collect()}
            assert got == _dim_replay(records, config, keep_old), (seed, keep_old)
