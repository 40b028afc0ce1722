"""DuckDB SQL computing each registered query's answer straight from the warehouse tables, with no
JSON: the envelope rules are applied relationally, so the check is independent of the operators."""

from __future__ import annotations

# Shared CTEs. ``ms`` is floor(epoch microseconds / 1000); dates are at +08:00 (Asia/Shanghai has had
# no clock change since 1991).
_LOGS = """
logs AS (
  SELECT event_id, user_id, event_type, 'm' || user_id AS mid, epoch_us(ts) // 1000 AS ms,
         CASE WHEN event_id % 113 = 0 THEN NULL
              WHEN event_id % 97 = 0 THEN '2'
              WHEN user_id % 3 = 0 AND event_id % 2 = 0 THEN '0' ELSE '1' END AS flag
  FROM events
  WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0
)"""


def _fixed(rule: str) -> str:
    hit = "prev <> dt" if rule == "later_day" else "prev = dt"
    return f"""
dated AS (
  SELECT *, strftime(epoch_ms(ms + 28800000), '%Y-%m-%d') AS dt,
         CASE flag WHEN '1' THEN strftime(epoch_ms(ms + 28800000), '%Y-%m-%d')
                   WHEN '0' THEN strftime(epoch_ms(ms + 28800000 - 86400000), '%Y-%m-%d') END AS cand
  FROM logs
), prevd AS (
  SELECT *, first_value(cand IGNORE NULLS) OVER (
           PARTITION BY mid ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM dated
), fixed AS (
  SELECT *, CASE WHEN flag = '1' AND prev IS NOT NULL AND {hit} THEN '0' ELSE flag END AS is_new
  FROM prevd
)"""


# Parts of good logs that no route takes.
_PARTS = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'err_not_object' WHEN 'click' THEN 'actions_not_array'
                                 ELSE 'display_not_object' END AS reason
FROM logs WHERE event_id % 7 = 3 AND event_type IN ('error', 'click', 'view')"""


LOG_ORACLE: dict[str, str] = {
    "log_clean": f"""WITH {_LOGS}
SELECT event_id, mid, ms AS ts, flag AS is_new,
       CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS kind
FROM logs""",
    "log_quarantine": f"""WITH {_LOGS}
SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'unparseable'
                      WHEN event_id % 107 = 0 THEN 'bad_field_type' ELSE 'no_mid' END AS reason
FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0
UNION ALL {_PARTS}""",
    "fix_is_new_later_day": f"WITH {_LOGS}, {_fixed('later_day')}\nSELECT event_id, mid, dt, is_new FROM fixed",
    "fix_is_new_same_day": f"WITH {_LOGS}, {_fixed('same_day')}\nSELECT event_id, mid, dt, is_new FROM fixed",
    "fix_is_new_int": f"""WITH {_LOGS}, {_fixed('later_day')}
SELECT event_id, is_new, coalesce(flag = '1' AND is_new = '0', false) AS is_number FROM fixed""",
    "split_routes": f"""WITH {_LOGS}
SELECT route, count(*) AS n FROM (
  SELECT 'err' AS route FROM logs WHERE event_type = 'error' AND event_id % 7 <> 3
  UNION ALL SELECT 'start' FROM logs WHERE event_type = 'signup'
  UNION ALL SELECT 'page' FROM logs WHERE event_type <> 'signup'
  UNION ALL SELECT 'display' FROM logs, range(0, 4) r(i) WHERE event_type = 'view' AND i < event_id % 4
  UNION ALL SELECT 'action' FROM logs WHERE event_type = 'click' AND event_id % 7 <> 3
) GROUP BY route""",
    "log_job_routes": f"""WITH {_LOGS}
SELECT route, count(*) AS n FROM (
  SELECT 'err' AS route FROM logs WHERE event_type = 'error' AND event_id % 7 <> 3
  UNION ALL SELECT 'start' FROM logs WHERE event_type = 'signup'
  UNION ALL SELECT 'page' FROM logs WHERE event_type <> 'signup'
  UNION ALL SELECT 'display' FROM logs, range(0, 4) r(i) WHERE event_type = 'view' AND i < event_id % 4
  UNION ALL SELECT 'action' FROM logs WHERE event_type = 'click' AND event_id % 7 <> 3
  UNION ALL SELECT 'quarantine' FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0
  UNION ALL SELECT 'quarantine' FROM ({_PARTS})
) GROUP BY route""",
    "split_err": f"""WITH {_LOGS}
SELECT event_id, event_id AS code, 'code' AS keys FROM logs WHERE event_type = 'error' AND event_id % 7 <> 3""",
    "split_start": f"""WITH {_LOGS}, {_fixed('later_day')}
SELECT event_id, mid, ms AS ts, is_new, 'icon' AS entry, 'common,props,start,ts' AS keys
FROM fixed WHERE event_type = 'signup'""",
    "split_page": f"""WITH {_LOGS}, {_fixed('later_day')}
SELECT event_id, mid, ms AS ts, is_new, event_type AS page_id, 'common,page,props,ts' AS keys
FROM fixed WHERE event_type <> 'signup'""",
    "split_display": f"""WITH {_LOGS}, {_fixed('later_day')}
SELECT event_id, mid, ms AS ts, is_new, event_type AS page_id, event_id * 10 + i AS item, i + 1 AS pos
FROM fixed, range(0, 4) r(i) WHERE event_type = 'view' AND i < event_id % 4""",
    "split_action": f"""WITH {_LOGS}
SELECT event_id, mid, ms AS ts, event_type AS page_id, 'fav' AS action_id, event_id AS item
FROM logs WHERE event_type = 'click' AND event_id % 7 <> 3""",
}

LOG_ORACLE["log_job_records"] = f"""WITH {_LOGS}, {_fixed('later_day')}, f AS (
  SELECT f.*, e.props FROM fixed f JOIN events e USING (event_id)
)
SELECT event_id, 'err' AS route, NULL AS reason, NULL AS part, NULL AS mid, NULL AS uid, NULL AS ch, NULL AS is_new, NULL AS page_id,
       NULL AS entry, NULL AS action_id, NULL AS props, NULL::BIGINT AS ts, NULL::BIGINT AS item, NULL::BIGINT AS pos, event_id AS code
FROM f WHERE event_type = 'error' AND event_id % 7 <> 3
UNION ALL SELECT event_id, 'start', NULL, NULL, mid, user_id::VARCHAR, 'web', is_new, NULL, 'icon', NULL, props, ms, NULL, NULL, NULL
FROM f WHERE event_type = 'signup'
UNION ALL SELECT event_id, 'page', NULL, NULL, mid, user_id::VARCHAR, 'web', is_new, event_type, NULL, NULL, props, ms, NULL, NULL, NULL
FROM f WHERE event_type <> 'signup'
UNION ALL SELECT event_id, 'display', NULL, NULL, mid, user_id::VARCHAR, 'web', is_new, event_type, NULL, NULL, NULL, ms, event_id * 10 + i, i + 1, NULL
FROM f, range(0, 4) r(i) WHERE event_type = 'view' AND i < event_id % 4
UNION ALL SELECT event_id, 'action', NULL, NULL, mid, user_id::VARCHAR, 'web', is_new, event_type, NULL, 'fav', NULL, ms, event_id, NULL, NULL
FROM f WHERE event_type = 'click' AND event_id % 7 <> 3
UNION ALL SELECT event_id, 'quarantine', CASE WHEN event_id % 101 = 0 THEN 'unparseable' WHEN event_id % 107 = 0 THEN 'bad_field_type' ELSE 'no_mid' END,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0
UNION ALL SELECT p.event_id, 'quarantine', p.reason,
       CASE p.reason WHEN 'err_not_object' THEN '"boom"' WHEN 'actions_not_array' THEN '"nope"' ELSE p.event_id::VARCHAR END,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM ({_PARTS}) p"""
LOG_ORACLE["split_nulls"] = """
SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 'ch,is_new,mid' ELSE 'is_new,mid' END AS common_keys,
       CASE WHEN event_id % 3 <> 0 THEN 'deep,last,list,page_id' ELSE 'deep,list,page_id' END AS page_keys, 'b' AS deep_keys,
       '[null,{"y":' || event_id || '},{}]' AS list, 'a "n":null, b' AS note
FROM events"""
LOG_ORACLE["late_logs"] = f"""WITH {_LOGS}, seen AS (
  SELECT ms, max(ms) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM logs
)
SELECT ms // 3600000 AS hour, count(*) AS n, count(*) FILTER (WHERE ms < most - 3000) AS n_late FROM seen GROUP BY 1"""


_PART_CHANGES = """
part_changes AS (
  SELECT 0 AS partition, p_partkey * 16 AS "offset", 'part' AS table_name, 'bootstrap-insert' AS type,
         1704067200 AS ts, p_partkey, p_name AS name, p_size AS size FROM part
  UNION ALL SELECT 0, p_partkey * 16 + 1, 'part', 'update', 1704067201, p_partkey, 'U' || p_name,
         CASE WHEN p_partkey % 6 <> 0 THEN p_size + 1 END FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 0, p_partkey * 16 + 2, 'part', 'delete', 1704067202, p_partkey, p_name, p_size
         FROM part WHERE p_partkey % 10 = 0
  UNION ALL SELECT 0, p_partkey * 16 + 3, 'part', 'insert', 1704067203, p_partkey, 'R' || p_name, NULL
         FROM part WHERE p_partkey % 20 = 0
)"""

CDC_ORACLE: dict[str, str] = {
    "cdc_clean_data": f"""WITH {_PART_CHANGES}, pc AS (
  SELECT partition, "offset", p_partkey, name, size FROM part_changes
  UNION ALL SELECT 0, p_partkey * 16 + 5, p_partkey, p_name, p_size FROM part WHERE p_partkey % 500 = 2
), pp AS (
  SELECT pc.*, p_brand, p_retailprice FROM pc JOIN part USING (p_partkey)
)
SELECT partition, "offset", 'p_partkey' AS "column", p_partkey::VARCHAR AS value, NULL::DOUBLE AS amount FROM pp
UNION ALL SELECT partition, "offset", 'p_name', name, NULL FROM pp
UNION ALL SELECT partition, "offset", 'p_size', size::VARCHAR, NULL FROM pp
UNION ALL SELECT partition, "offset", 'p_brand', p_brand, NULL FROM pp
UNION ALL SELECT partition, "offset", 'p_retailprice', NULL, p_retailprice FROM pp
UNION ALL SELECT 0, p_partkey * 16 + 10, 'p_name', 'X' || p_name, NULL FROM part WHERE p_partkey % 700 = 7
UNION ALL SELECT 1, s_suppkey, 's_suppkey', s_suppkey::VARCHAR, NULL FROM supplier
UNION ALL SELECT 1, s_suppkey, 's_name', s_name, NULL FROM supplier
UNION ALL SELECT 1, s_suppkey, 's_nationkey', s_nationkey::VARCHAR, NULL FROM supplier
UNION ALL SELECT 1, s_suppkey, 's_acctbal', NULL, s_acctbal FROM supplier
UNION ALL SELECT 2, n_nationkey, 'n_nationkey', n_nationkey::VARCHAR, NULL FROM nation
UNION ALL SELECT 2, n_nationkey, 'n_name', n_name, NULL FROM nation
UNION ALL SELECT 2, n_nationkey, 'n_regionkey', n_regionkey::VARCHAR, NULL FROM nation
UNION ALL SELECT 3, o_orderkey, 'id', o_orderkey::VARCHAR, NULL FROM orders
UNION ALL SELECT 3, o_orderkey, 'user_id', o_custkey::VARCHAR, NULL FROM orders
UNION ALL SELECT 3, o_orderkey, 'appraise', o_orderstatus, NULL FROM orders
UNION ALL SELECT 3, o_orderkey, 'comment_txt', o_orderpriority, NULL FROM orders""",
    "dim_route_by_batches": f"""WITH {_PART_CHANGES}, pc AS (
  SELECT partition, "offset", type, ts FROM part_changes
  UNION ALL SELECT 0, p_partkey * 16 + 10, 'update', 1704067210 FROM part WHERE p_partkey % 700 = 7
)
SELECT partition, "offset", 'part' AS table_name, CASE WHEN ts > 1704067201 THEN 'dim_part2' ELSE 'dim_part' END AS sink_table,
       CASE WHEN ts > 1704067201 THEN 'p_partkey,p_name' ELSE 'p_partkey,p_name,p_size' END AS sink_columns, type, (ts > 1704067201)::INT AS batch
FROM pc
UNION ALL SELECT 1, s_suppkey, 'supplier', 'dim_supplier', 's_suppkey,s_name', 'bootstrap-insert', 0 FROM supplier
UNION ALL SELECT 2, n_nationkey, 'nation', 'dim_nation', 'n_nationkey,n_name', 'bootstrap-insert', 0 FROM nation""",
    "cdc_clean": f"""WITH {_PART_CHANGES}
SELECT partition, "offset", table_name, type, ts FROM part_changes
UNION ALL SELECT 0, p_partkey * 16 + 5, 'unknown_table', 'insert', 1704067205 FROM part WHERE p_partkey % 500 = 2
UNION ALL SELECT 0, p_partkey * 16 + 10, 'part', 'update', 1704067210 FROM part WHERE p_partkey % 700 = 7
UNION ALL SELECT 1, s_suppkey, 'supplier', 'bootstrap-insert', 1704067200 FROM supplier
UNION ALL SELECT 2, n_nationkey, 'nation', 'bootstrap-insert', 1704067200 FROM nation
UNION ALL SELECT 3, o_orderkey, 'comment_info', 'insert', 1704067200 + o_orderkey % 86400 FROM orders""",
    "dim_route": f"""WITH {_PART_CHANGES}
SELECT partition, "offset", table_name, 'dim_part' AS sink_table, 'p_partkey,p_name,p_size' AS sink_columns, type
FROM part_changes
UNION ALL SELECT 0, p_partkey * 16 + 10, 'part', 'dim_part', 'p_partkey,p_name,p_size', 'update'
FROM part WHERE p_partkey % 700 = 7
UNION ALL SELECT 1, s_suppkey, 'supplier', 'dim_supplier', 's_suppkey, s_name, s_nationkey', 'bootstrap-insert'
FROM supplier""",
    "dim_trim": f"""WITH {_PART_CHANGES}, pc AS (
  SELECT partition, "offset", 'dim_part' AS sink_table, CAST(p_partkey AS VARCHAR) AS row_key,
         CASE WHEN type = 'delete' THEN 'delete' ELSE 'upsert' END AS change_op, p_partkey, name, size
  FROM part_changes
)
SELECT partition, "offset", sink_table, row_key, change_op, 'p_partkey' AS "column", CAST(p_partkey AS VARCHAR) AS value FROM pc
UNION ALL SELECT partition, "offset", sink_table, row_key, change_op, 'p_name', name FROM pc
UNION ALL SELECT partition, "offset", sink_table, row_key, change_op, 'p_size', CAST(size AS VARCHAR) FROM pc
UNION ALL SELECT 0, p_partkey * 16 + 10, 'dim_part', NULL, 'upsert', 'p_name', 'X' || p_name FROM part WHERE p_partkey % 700 = 7
UNION ALL SELECT 1, s_suppkey, 'dim_supplier', CAST(s_suppkey AS VARCHAR), 'upsert', 's_suppkey', CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT 1, s_suppkey, 'dim_supplier', CAST(s_suppkey AS VARCHAR), 'upsert', 's_name', s_name FROM supplier
UNION ALL SELECT 1, s_suppkey, 'dim_supplier', CAST(s_suppkey AS VARCHAR), 'upsert', 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier""",
}


def _dim_apply(keep_old: bool) -> str:
    size_rows = "p_partkey % 10 <> 0" if keep_old else "p_partkey % 10 <> 0 AND p_partkey % 6 <> 0"
    return f"""
WITH live AS (SELECT * FROM part WHERE p_partkey % 10 <> 0 OR p_partkey % 20 = 0)
SELECT 'dim_part' AS sink_table, CAST(p_partkey AS VARCHAR) AS row_key, 'p_partkey' AS "column",
       CAST(p_partkey AS VARCHAR) AS value FROM live
UNION ALL SELECT 'dim_part', CAST(p_partkey AS VARCHAR), 'p_name',
       CASE WHEN p_partkey % 10 = 0 THEN 'R' || p_name WHEN p_partkey % 3 = 0 THEN 'U' || p_name ELSE p_name END
       FROM live
UNION ALL SELECT 'dim_part', CAST(p_partkey AS VARCHAR), 'p_size',
       CAST(CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 <> 0 THEN p_size + 1 ELSE p_size END AS VARCHAR)
       FROM part WHERE {size_rows} AND p_size IS NOT NULL
UNION ALL SELECT 'dim_supplier', CAST(s_suppkey AS VARCHAR), 's_suppkey', CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'dim_supplier', CAST(s_suppkey AS VARCHAR), 's_name', s_name FROM supplier
UNION ALL SELECT 'dim_supplier', CAST(s_suppkey AS VARCHAR), 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier"""


CDC_ORACLE["cdc_quarantine"] = """
SELECT 0 AS partition, p_partkey * 16 + 8 AS "offset", 'unparseable' AS reason FROM part WHERE p_partkey % 700 = 5
UNION ALL SELECT 0, p_partkey * 16 + 9, 'no_data' FROM part WHERE p_partkey % 700 = 6"""
CDC_ORACLE["dim_quarantine"] = """
SELECT 0 AS partition, p_partkey * 16 + 10 AS "offset", 'dim_part' AS sink_table, 'no_row_key' AS reason
FROM part WHERE p_partkey % 700 = 7"""
CDC_ORACLE["dim_apply"] = _dim_apply(True)
CDC_ORACLE["dim_apply_overwrite"] = _dim_apply(False)
CDC_ORACLE["dim_apply_on_base"] = f"SELECT 'info' AS family, x.* FROM ({_dim_apply(True)}) x"
CDC_ORACLE["dim_apply_by_batches"] = _dim_apply(True)
CDC_ORACLE["dim_apply_by_batches_overwrite"] = _dim_apply(False)
CDC_ORACLE["dim_route_preload"] = f"""WITH {_PART_CHANGES}
SELECT partition, "offset", table_name, 'dim_part' AS sink_table, 'p_partkey,p_name,p_size' AS sink_columns, type
FROM part_changes
UNION ALL SELECT 0, p_partkey * 16 + 10, 'part', 'dim_part', 'p_partkey,p_name,p_size', 'update'
FROM part WHERE p_partkey % 700 = 7
UNION ALL SELECT 1, s_suppkey, 'supplier', 'dim_supplier', 's_suppkey,s_name', 'bootstrap-insert'
FROM supplier, region WHERE r_regionkey = 0"""
CDC_ORACLE["topic_filter"] = """
SELECT 'gmall' AS db_name, 'comment_info' AS table_name, 1704067200 + o_orderkey % 86400 AS ts,
       CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS appraise
FROM orders"""
CDC_ORACLE["lookup_dictionary"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS appraise,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS appraise_name
FROM orders"""
CDC_ORACLE["lookup_nation"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_nationkey AS VARCHAR) AS s_nationkey, n_name AS nation_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""
CDC_ORACLE["date_functions"] = """
WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_id,
       strftime(epoch_ms(ms + 28800000), '%Y-%m-%d') AS dt,
       strftime(epoch_ms(ms + 28800000), '%Y-%m-%d %H:%M:%S') AS dttm,
       strftime(epoch_ms(ms + 28800000), '%Y%m%d') AS part_dt,
       strftime(epoch_ms(ms + 28800000 - 86400000), '%Y-%m-%d') AS prev_dt,
       (ms // 1000) * 1000 AS dttm_ms,
       epoch_ms(CAST(CAST(epoch_ms(ms + 28800000) AS DATE) AS TIMESTAMP)) - 28800000 AS dt_ms
FROM e"""

ORACLE: dict[str, str] = {**LOG_ORACLE, **CDC_ORACLE}
