"""DuckDB SQL for every key of ``plans/queries.py`` (the driver's correctness oracle).

Written independently of the Spark code from the operator definitions: windows
over whole partitions, plain joins and aggregates. The driver pre-registers the
tables as views. Column names and types match the Spark queries.
"""

from __future__ import annotations

# Unicode white-space trim (same class as constants.UNICODE_SPACE_CLASS).
_WS = r"[\t\n\x{0B}\f\r \x{85}\p{Z}]"


def TRIMU(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def NORMMS(x: str) -> str:
    big = f"(COALESCE({x}, 0)::HUGEINT * 1000 + 9223372036854775808::HUGEINT)"
    m = "18446744073709551616::HUGEINT"
    return (f"(CASE WHEN COALESCE({x}, 0) >= 1000000000000 THEN COALESCE({x}, 0) "
            f"ELSE CAST((({big} % {m}) + {m}) % {m} - 9223372036854775808::HUGEINT AS BIGINT) END)")


#: Users divisible by 29 look at products outside the catalog.
PID = "CASE WHEN user_id % 29 = 0 THEN 'X' ELSE 'P' END || json_extract_string(props, '$.k')"


def DEFAULT_SOURCE(x: str) -> str:
    return f"COALESCE(NULLIF({TRIMU(x)}, ''), 'dynamic')"


SPLIT_TS = "TIMESTAMP '2024-01-16 00:00:00'"
CHANGED_SINCE_S = "epoch_us(TIMESTAMP '2024-01-29 00:00:00') // 1000000"
RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"

CTES: list[tuple[str, str]] = [
    ("pe", f"""
SELECT event_id AS event_seq, ts AS arrival_ts,
       CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
       CASE WHEN event_id % 23 = 3 THEN ' ' || ({PID}) || chr(9) ELSE {PID} END AS product_id,
       'U' || CAST(user_id AS VARCHAR) AS user_id,
       CAST(CASE WHEN event_id % 10 = 0 THEN epoch_us(ts) // 1000 - 21600000
                 WHEN event_id % 499 = 7 THEN -9223372036854775808
                 WHEN event_id % 499 = 8 THEN 9223372036854775807
                 WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000
                 ELSE epoch_us(ts) // 1000 END AS BIGINT) AS "timestamp",
       value AS price
FROM events"""),
    ("cmds", f"""
SELECT event_id AS cmd_seq, ts AS cmd_ts,
       {PID} AS product_id,
       CASE WHEN event_type = 'signup' THEN 'set' ELSE 'remove' END AS op,
       CAST(CASE WHEN event_type = 'signup' THEN value END AS DOUBLE) AS override_price,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'campaign' END AS reason
FROM events
WHERE event_type IN ('signup', 'error')"""),
    ("cat", """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_retailprice AS base_price FROM part"""),
    ("ve", f"""
SELECT *, CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 WHEN 'purchase' THEN 5 END AS BIGINT) AS w
FROM pe
WHERE event_type IN ('view', 'cart', 'purchase') AND COALESCE({TRIMU('product_id')}, '') <> ''
  AND COALESCE(price, 0) > 0"""),
    ("vc", f"""
SELECT cmd_seq, cmd_ts,
       CASE WHEN op = 'set' THEN {TRIMU('product_id')} ELSE product_id END AS product_id, op,
       CASE WHEN op = 'set' THEN override_price END AS override_price,
       CASE WHEN op = 'set' THEN COALESCE(NULLIF({TRIMU('reason')}, ''), 'manual override') END AS reason
FROM cmds
WHERE (op = 'set' AND COALESCE(regexp_full_match({TRIMU('product_id')}, '[A-Za-z0-9_-]+'), false)
       AND COALESCE(override_price, 0) > 0)
   OR (op = 'remove' AND COALESCE(regexp_full_match(product_id, '[A-Za-z0-9_-]+'), false))"""),
    ("known", """
SELECT product_id, MIN(since) AS since FROM (
  SELECT product_id, TIMESTAMP '0001-01-01 00:00:00' AS since FROM cat
  UNION ALL
  SELECT product_id, MIN(arrival_ts) AS since FROM ve GROUP BY product_id) k
GROUP BY product_id"""),
    ("eff", """
SELECT cmd_seq, cmd_ts, product_id, op, override_price, reason FROM (
  SELECT *, LAG(op) OVER (PARTITION BY product_id ORDER BY cmd_ts, cmd_seq) AS prev_op
  FROM (
    SELECT v.* FROM vc v
    WHERE v.op = 'set' AND EXISTS (SELECT 1 FROM known k WHERE k.product_id = v.product_id AND k.since < v.cmd_ts)
    UNION ALL
    SELECT * FROM vc WHERE op = 'remove') b) x
WHERE op = 'set' OR prev_op = 'set'"""),
    ("g", f"""
SELECT *,
  CASE WHEN last_op = 'set' THEN 'override_active'
       WHEN last_op = 'remove' AND {NORMMS('"timestamp"')} <= last_ms THEN 'stale_after_removal' END AS gate
FROM (
  SELECT *,
    LAST_VALUE(c_op IGNORE NULLS) OVER w AS last_op,
    LAST_VALUE(c_ms IGNORE NULLS) OVER w AS last_ms
  FROM (
    SELECT event_seq, arrival_ts, event_type, product_id, user_id, "timestamp", price, w,
           {TRIMU('product_id')} AS tid, arrival_ts AS t, 2 AS kind, event_seq AS seq,
           CAST(NULL AS VARCHAR) AS c_op, CAST(NULL AS BIGINT) AS c_ms
    FROM ve
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
           product_id, cmd_ts, 1, cmd_seq, op, epoch_us(cmd_ts) // 1000
    FROM eff) u
  WINDOW w AS (PARTITION BY tid ORDER BY t, kind, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) s
WHERE kind = 2"""),
    ("priced", """
SELECT *, price + sqrt(CAST(demand AS DOUBLE)) * 5.0 AS new_price,
       epoch_us(arrival_ts) // 1000000 AS update_ts
FROM (
  SELECT event_seq, arrival_ts, event_type, product_id, user_id, "timestamp", price, w,
         CAST(SUM(w) OVER (PARTITION BY product_id ORDER BY arrival_ts, event_seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS demand
  FROM g WHERE gate IS NULL) a"""),
    ("hist_core", """
SELECT product_id, new_price AS price, 'dynamic' AS price_source, arrival_ts AS event_time, event_seq AS seq
FROM priced
UNION ALL
SELECT product_id, override_price, 'override', cmd_ts, cmd_seq FROM eff WHERE op = 'set'"""),
    ("base_rows", f"""
SELECT c.product_id, c.base_price AS price, 'base' AS price_source,
       COALESCE(s.first_t - INTERVAL 1 MILLISECOND, {RUN_TS}) AS event_time, CAST(-1 AS BIGINT) AS seq
FROM cat c LEFT JOIN (
  SELECT product_id, MIN(event_time) AS first_t,
         MAX(CASE WHEN {DEFAULT_SOURCE('price_source')} = 'base' THEN 1 ELSE 0 END) AS has_base
  FROM hist_core GROUP BY product_id) s ON c.product_id = s.product_id
WHERE COALESCE(s.has_base, 0) = 0"""),
    ("hist", """
SELECT * FROM hist_core UNION ALL SELECT * FROM base_rows"""),
    ("dt", """
SELECT product_id, CAST(SUM(w) AS BIGINT) AS demand FROM priced GROUP BY product_id"""),
    ("lp_all", """
SELECT product_id, price FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY t DESC, k DESC, s DESC) AS rn FROM (
    SELECT product_id, new_price AS price, arrival_ts AS t, 2 AS k, event_seq AS s FROM priced
    UNION ALL SELECT product_id, override_price, cmd_ts, 1, cmd_seq FROM eff WHERE op = 'set'
    UNION ALL SELECT product_id, base_price, TIMESTAMP '0001-01-01 00:00:00', 0, -1 FROM cat) x) y
WHERE rn = 1"""),
    ("lp", """
SELECT product_id, price FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY t DESC, k DESC, s DESC) AS rn FROM (
    SELECT product_id, new_price AS price, arrival_ts AS t, 2 AS k, event_seq AS s FROM priced
    UNION ALL SELECT product_id, override_price, cmd_ts, 1, cmd_seq FROM eff WHERE op = 'set') x) y
WHERE rn = 1"""),
    ("ls", """
SELECT COALESCE(s.product_id, c.product_id) AS product_id,
       CASE WHEN c.product_id IS NOT NULL THEN COALESCE(s.demand, 0) ELSE s.demand END AS demand,
       CASE WHEN c.product_id IS NOT NULL THEN COALESCE(s.price, c.base_price) ELSE s.price END AS price
FROM (SELECT COALESCE(d.product_id, l.product_id) AS product_id, d.demand, l.price
      FROM dt d FULL OUTER JOIN lp l ON d.product_id = l.product_id) s
FULL OUTER JOIN cat c ON s.product_id = c.product_id"""),
    ("ovr", """
SELECT product_id, override_price, reason, cmd_ts AS set_time FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY cmd_ts DESC, cmd_seq DESC) AS rn FROM eff) x
WHERE rn = 1 AND op = 'set'"""),
    ("ovr_first", f"""
SELECT product_id, override_price, reason, cmd_ts AS set_time FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY cmd_ts DESC, cmd_seq DESC) AS rn
  FROM eff WHERE cmd_ts < {SPLIT_TS}) x
WHERE rn = 1 AND op = 'set'"""),
    ("cp", """
SELECT l.product_id,
       CASE WHEN o.override_price IS NOT NULL THEN o.override_price ELSE l.price END AS price,
       CAST(l.demand AS BIGINT) AS demand,
       CASE WHEN o.override_price IS NOT NULL THEN 'override' ELSE 'dynamic' END AS price_source
FROM ls l LEFT JOIN ovr o ON l.product_id = o.product_id
WHERE l.demand IS NOT NULL AND (o.override_price IS NOT NULL OR l.price IS NOT NULL)
  AND COALESCE(regexp_full_match(l.product_id, '[A-Za-z0-9_-]+'), false)"""),
    ("topn", f"""
SELECT product_id, CAST(rn AS BIGINT) AS rn, price, {DEFAULT_SOURCE('price_source')} AS price_source, event_time
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY event_time DESC, seq DESC) AS rn FROM hist
      WHERE COALESCE(regexp_full_match(product_id, '[A-Za-z0-9_-]+'), false)) x
WHERE rn <= 50"""),
    ("upd", f"""
SELECT event_seq,
       {TRIMU('product_id')} AS product_id,
       new_price, update_ts AS "timestamp"
FROM priced WHERE event_seq % 7 NOT IN (1, 2, 3, 4)"""),
]


#: Product events of the larger stream; its ties are broken by supplier, price, quantity and flag.
LINEITEM = """
SELECT l_orderkey * 100 + l_linenumber AS event_seq, CAST(l_shipdate AS TIMESTAMP) AS arrival_ts,
       CASE l_returnflag WHEN 'A' THEN 'view' WHEN 'R' THEN 'cart' WHEN 'N' THEN 'purchase' ELSE l_returnflag END AS event_type,
       'P' || CAST(l_partkey AS VARCHAR) AS product_id, 'S' || CAST(l_suppkey AS VARCHAR) AS user_id,
       epoch_us(CAST(l_shipdate AS TIMESTAMP)) // 1000 AS "timestamp", l_extendedprice / l_quantity AS price,
       CAST(l_suppkey AS BIGINT) AS t1, CAST(round(l_extendedprice * 100) AS BIGINT) AS t2,
       CAST(round(l_quantity * 100) AS BIGINT) AS t3, ascii(l_returnflag) AS t4
FROM lineitem"""


def _with(lineitem: bool = False) -> str:
    ctes = dict(CTES)
    if lineitem:
        ctes["pe"] = LINEITEM
        ctes["g"] = ctes["g"].replace("price, w,", "price, w, t1, t2, t3, t4,").replace(
            "SELECT NULL, NULL,", "SELECT NULL, NULL, NULL, NULL, NULL, NULL,")
        ctes["priced"] = ctes["priced"].replace("ORDER BY arrival_ts, event_seq", "ORDER BY arrival_ts, event_seq, t1, t2, t3, t4")
        ctes["lp"] = ctes["lp"].replace("event_seq AS s FROM priced", "demand AS s FROM priced")
    return "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in ctes.items()) + "\n"


SELECTS: dict[str, str] = {
    "catalog_prices": "SELECT product_id, base_price FROM cat",
    "price_overrides_snapshot": "SELECT product_id, override_price, COALESCE(reason, '') AS reason, set_time FROM ovr",
    "decode_product_events": """
SELECT event_seq, COALESCE(event_type, '') AS event_type,
       CASE WHEN event_seq % 17 = 0 THEN chr(9) || ' ' ELSE COALESCE(product_id, '') END AS product_id,
       CASE WHEN event_seq % 7 = 0 THEN '' ELSE COALESCE(user_id, '') END AS user_id,
       COALESCE("timestamp", 0) AS "timestamp", COALESCE(price, 0.0) AS price
FROM pe WHERE event_seq % 11 <> 0""",
    "valid_product_events": """
SELECT event_seq, arrival_ts, event_type, product_id, user_id, "timestamp", price FROM ve""",
    "rejected_product_events": f"""
SELECT event_seq, reason FROM (
  SELECT event_seq,
    CASE WHEN event_seq % 11 = 0 THEN 'decode_error'
         WHEN COALESCE(event_type, '') NOT IN ('view', 'cart', 'purchase') THEN 'invalid_event_type'
         WHEN event_seq % 17 = 0 OR COALESCE({TRIMU('product_id')}, '') = '' THEN 'invalid_product_id'
         WHEN COALESCE(price, 0) <= 0 THEN 'invalid_price' END AS reason
  FROM pe) r
WHERE reason IS NOT NULL""",
    "valid_product_id": """
SELECT event_seq, product_id, COALESCE(regexp_full_match(product_id, '[A-Za-z0-9_-]+'), false) AS is_valid
FROM (SELECT event_seq,
        CASE event_seq % 5 WHEN 0 THEN '' WHEN 1 THEN product_id || '$' WHEN 2 THEN product_id || chr(10)
             WHEN 3 THEN ' ' || product_id ELSE product_id END AS product_id
      FROM pe) v""",
    "parse_price_updates": """
SELECT event_seq, 'price_update' AS type, product_id, new_price, "timestamp" FROM upd""",
    "valid_override_commands": "SELECT cmd_seq, op, product_id, override_price, reason FROM vc",
    "known_product_commands": """
SELECT v.cmd_seq, v.product_id FROM vc v
WHERE v.op = 'set' AND EXISTS (
  SELECT 1 FROM (
    SELECT product_id, MIN(since) AS since FROM (
      SELECT product_id, TIMESTAMP '0001-01-01 00:00:00' AS since FROM cat
      UNION ALL SELECT product_id, MIN(arrival_ts) FROM ve GROUP BY product_id) a
    GROUP BY product_id) k
  WHERE k.product_id = v.product_id AND k.since < v.cmd_ts)""",
    "catalog_updates": """
SELECT event_seq, product_id, new_price, "timestamp" FROM upd
WHERE product_id IN (SELECT product_id FROM cat)""",
    "demand_weight": """
SELECT event_seq, CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 WHEN 'purchase' THEN 5 END AS BIGINT) AS value
FROM ve""",
    "compute_price": """
SELECT event_seq, price + sqrt(CAST(SUM(w) OVER (PARTITION BY product_id ORDER BY arrival_ts, event_seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)) * 5.0 AS value
FROM ve""",
    "normalize_event_ms": f'SELECT event_seq, {NORMMS(chr(34) + "timestamp" + chr(34))} AS value FROM pe',
    "update_timestamp_s": "SELECT event_seq, epoch_us(arrival_ts) // 1000000 AS value FROM pe",
    "trim_unicode": f"""
SELECT event_seq, {TRIMU('v')} AS value FROM (
  SELECT event_seq, CASE event_seq % 5
    WHEN 0 THEN ' ' || product_id || chr(9)
    WHEN 1 THEN chr(12288) || product_id || chr(160)
    WHEN 2 THEN chr(11) || '  '
    WHEN 3 THEN chr(133) || product_id || ' x' || chr(10) || chr(13)
    ELSE product_id END AS v
  FROM pe) t""",
    "default_price_source": f"""
SELECT event_seq, {DEFAULT_SOURCE('s')} AS value FROM (
  SELECT event_id AS event_seq, CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN chr(9) || ' ' || chr(9)
    ELSE ' ' || event_type || chr(9) END AS s FROM events) t""",
    "default_override_reason": f"""
SELECT event_seq, COALESCE(NULLIF({TRIMU('r')}, ''), 'manual override') AS value FROM (
  SELECT event_id AS event_seq, CASE WHEN user_id % 4 = 0 THEN NULL WHEN user_id % 4 = 1 THEN '   '
    ELSE ' by ' || CAST(user_id AS VARCHAR) || ': ' || props || ' ' END AS r FROM events) t""",
    "history_limit": f"""
SELECT event_seq, COALESCE(value, 0) AS value, CASE WHEN value IS NULL THEN 'rejected' ELSE 'accepted' END AS status FROM (
SELECT event_seq,
  CASE WHEN t = '' THEN CAST(50 AS BIGINT)
       WHEN regexp_full_match(t, '[+-]?[0-9]+') AND TRY_CAST(t AS BIGINT) > 0
         THEN LEAST(TRY_CAST(t AS BIGINT), CAST(500 AS BIGINT)) END AS value
FROM (
  SELECT event_seq, {TRIMU('raw')} AS t FROM (
    SELECT event_id AS event_seq, CASE
      WHEN event_type = 'view' THEN ' ' || CAST(user_id AS VARCHAR) || chr(9)
      WHEN event_type = 'click' THEN '+' || CAST(user_id AS VARCHAR)
      WHEN event_type = 'purchase' THEN '-' || CAST(user_id AS VARCHAR)
      WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) || '0000000000000000000000'
      WHEN user_id % 2 = 0 THEN ' ' || chr(9) ELSE event_type || CAST(user_id AS VARCHAR) END AS raw
    FROM events) a) b) c""",
    "round_price_2dp": "SELECT event_seq, floor(new_price * 100.0 + 0.5) / 100.0 AS value FROM priced",
    "base_seed_time": """
SELECT product_id, MIN(event_time) - INTERVAL 1 MILLISECOND AS value FROM hist_core GROUP BY product_id""",
    "running_demand": """
SELECT event_seq, product_id, CAST(SUM(w) OVER (PARTITION BY product_id ORDER BY arrival_ts, event_seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS demand
FROM ve""",
    "demand_totals": "SELECT product_id, demand FROM dt",
    "dynamic_price_events": "SELECT event_seq, product_id, demand, new_price, update_ts FROM priced",
    # the streaming engines must produce exactly the batch result
    "stream_pricing": "SELECT event_seq, product_id, demand, new_price, update_ts FROM priced",
    "stream_pricing_stateful": "SELECT event_seq, product_id, demand, new_price, update_ts FROM priced",
    "src_product_events": """
SELECT event_seq, COALESCE(event_type, '') AS event_type, COALESCE(product_id, '') AS product_id,
       COALESCE(user_id, '') AS user_id, "timestamp", COALESCE(price, 0.0) AS price
FROM pe""",
    "src_price_updates": f"""
SELECT event_seq, 'price_update' AS type, {TRIMU('product_id')} AS product_id, new_price, update_ts AS "timestamp" FROM priced""",
    "sink_price_updates": 'SELECT event_seq, product_id, new_price, update_ts AS "timestamp" FROM priced',
    "sink_price_history": "SELECT product_id, price, price_source, event_time FROM hist_core",
    "sink_live_state": "SELECT product_id, demand, price FROM ls",
    "stream_current_price": "SELECT product_id, price, demand, price_source FROM cp",
    "stream_rejected_events": f"""
SELECT event_seq, reason FROM (
  SELECT event_seq,
    CASE WHEN COALESCE(event_type, '') NOT IN ('view', 'cart', 'purchase') THEN 'invalid_event_type'
         WHEN COALESCE({TRIMU('product_id')}, '') = '' THEN 'invalid_product_id'
         WHEN COALESCE(price, 0) <= 0 THEN 'invalid_price' END AS reason
  FROM pe) r
WHERE reason IS NOT NULL""",
    "lineitem_dynamic_price_events": "SELECT event_seq, product_id, demand, new_price, update_ts FROM priced",
    "lineitem_current_price": "SELECT product_id, price, demand, price_source FROM cp",
    "live_price": "SELECT product_id, price FROM lp_all",
    "override_upsert": f"""
SELECT COALESCE(s.product_id, n.product_id) AS product_id,
       CASE WHEN n.product_id IS NOT NULL THEN n.override_price ELSE s.override_price END AS override_price,
       CASE WHEN n.product_id IS NOT NULL THEN n.reason ELSE s.reason END AS reason,
       CASE WHEN n.product_id IS NOT NULL THEN n.cmd_ts ELSE s.set_time END AS set_time
FROM ovr_first s FULL OUTER JOIN (
  SELECT product_id, override_price, reason, cmd_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY cmd_ts DESC, cmd_seq DESC) AS rn
    FROM eff WHERE op = 'set' AND cmd_ts >= {SPLIT_TS}) x WHERE rn = 1) n
ON s.product_id = n.product_id""",
    "override_delete": f"""
SELECT COALESCE(r.product_id, s.product_id) AS product_id,
       CASE WHEN r.product_id IS NULL THEN 'survives' WHEN s.product_id IS NULL THEN 'absent' ELSE 'deleted' END AS outcome
FROM (SELECT DISTINCT product_id FROM vc WHERE op = 'remove' AND cmd_ts >= {SPLIT_TS}) r
FULL OUTER JOIN ovr_first s ON r.product_id = s.product_id""",
    "encode_price_update": 'SELECT event_seq, product_id, new_price, update_ts AS "timestamp" FROM priced',
    "override_state": "SELECT product_id, override_price, set_time FROM ovr",
    "override_intervals": """
SELECT product_id, cmd_ts AS set_at, next_end AS removed_at FROM (
  SELECT *, LEAD(cmd_ts) OVER (PARTITION BY product_id ORDER BY cmd_ts, cmd_seq) AS next_end FROM (
    SELECT * FROM (
      SELECT *, LAG(op) OVER (PARTITION BY product_id ORDER BY cmd_ts, cmd_seq) AS prev FROM eff) a
    WHERE (op = 'set' AND COALESCE(prev, '') <> 'set') OR op = 'remove') m) e
WHERE op = 'set'""",
    "gate_override_active": "SELECT event_seq, product_id FROM g WHERE gate = 'override_active'",
    "gate_stale_after_removal": "SELECT event_seq, product_id FROM g WHERE gate = 'stale_after_removal'",
    "override_history_points": """
SELECT product_id, override_price AS price, 'override' AS price_source, cmd_ts AS event_time
FROM eff WHERE op = 'set'""",
    "seed_live_state": "SELECT product_id, demand, price FROM ls",
    "base_price_history": "SELECT product_id, price, price_source, event_time FROM base_rows",
    "known_products": "SELECT DISTINCT product_id FROM ls WHERE demand IS NOT NULL OR price IS NOT NULL",
    "price_history_topn": "SELECT product_id, rn, price, price_source, event_time FROM topn",
    "history_exists": """
SELECT c.product_id, EXISTS (SELECT 1 FROM hist_core h WHERE h.product_id = c.product_id) AS has_history
FROM cat c""",
    "current_price": "SELECT product_id, price, demand, price_source FROM cp",
    "price_chart_series": """
SELECT s.product_id, pos, floor(price * 100.0 + 0.5) / 100.0 AS price, price_source FROM (
  SELECT b.*, MAX(CASE WHEN price_source = 'override' THEN pos END) OVER (PARTITION BY product_id) AS last_o
  FROM (SELECT t.*, CAST(MAX(rn) OVER (PARTITION BY product_id) - rn + 1 AS BIGINT) AS pos FROM topn t) b) s
LEFT JOIN (SELECT product_id AS ap, true AS active FROM cp WHERE price_source = 'override') a
  ON s.product_id = a.ap
WHERE NOT (COALESCE(a.active, false) AND s.last_o IS NOT NULL) OR s.pos <= s.last_o""",
    "history_source_flags": """
SELECT product_id, bool_or(price_source = 'base') AS has_base, bool_or(price_source = 'override') AS has_override
FROM topn GROUP BY product_id""",
    "changed_product_snapshot": f"""
SELECT product_id, price, demand, price_source FROM cp
WHERE product_id IN (SELECT product_id FROM upd
                     WHERE product_id IN (SELECT product_id FROM cat) AND "timestamp" >= {CHANGED_SINCE_S})""",
}


def oracle_sql() -> dict[str, str]:
    small, large = _with(), _with(lineitem=True)
    for of_stream, key in (("stream_price_history_topn", "price_history_topn"), ("stream_price_chart_series", "price_chart_series"),
                           ("lineitem_price_history_topn", "price_history_topn"),
                           ("lineitem_price_chart_series", "price_chart_series")):
        SELECTS[of_stream] = SELECTS[key]
    return {k: (large if k.startswith("lineitem_") else small) + v.strip() for k, v in SELECTS.items()}
