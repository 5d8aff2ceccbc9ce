"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark plans: the same record derivations as
``sources.tables`` expressed in SQL over the driver's views, then the
reference's semantics in plain SQL. Money is summed as DECIMAL then cast to
DOUBLE; arrays become sorted, joined strings.
"""

from __future__ import annotations

from .. import constants as C
from ..sources import tables as TB
from . import params as P


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _pick(values, idx: str) -> str:
    return f"{_list(values)}[({idx}) % {len(values)} + 1]"


def _named(field: str, idx: str) -> str:
    return f"'{field}_' || (({idx}) % {TB.NAMED_VALUES[field]})"


_EVENT_ID = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in TB.EVENT_ID_OF_TYPE.items()) + " END"

STARTUP = f"""startup AS (
  SELECT 'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         '{C.APP_ID}' AS appid, {_named('area', 'user_id')} AS area,
         {_named('os', 'user_id')} AS os, {_named('channel', 'event_id')} AS channel,
         'startup' AS logtype, {_named('version', 'event_id')} AS version,
         (epoch_us(ts) // 1000) AS ts, strftime(ts, '%Y-%m-%d') AS logdate, strftime(ts, '%H') AS loghour
  FROM events WHERE event_type = 'signup')"""

EVENTLOG = f"""eventlog AS (
  SELECT 'mid_' || CAST(user_id % {TB.EVENT_DEVICES} AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid, '{C.APP_ID}' AS appid,
         {_named('area', 'user_id')} AS area, {_named('os', 'user_id')} AS os,
         'event' AS logtype, {_EVENT_ID} AS eventid,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS pageid,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 + 1 AS VARCHAR) AS nextpageid,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS itemid,
         (epoch_us(ts) // 1000) AS ts, ts AS event_ts, event_id,
         strftime(ts, '%Y-%m-%d') AS logdate, strftime(ts, '%H') AS loghour
  FROM events)"""

_CREATE_TS = ("(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) "
              "+ to_minutes(CAST(o_orderkey % 60 AS INTEGER)) "
              "+ to_seconds(CAST(o_orderkey % 59 AS INTEGER)))")

ORDERINFO = f"""orderinfo AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 34 + 1 AS VARCHAR) AS province_id,
         CASE WHEN c_name IS NULL THEN NULL ELSE substr(c_name, 1, 1) || '**' END AS consignee,
         o_orderpriority AS order_comment,
         regexp_replace(tel, '(\\d{{3}})\\d{{4}}(\\d{{4}})', '\\1****\\2', 'g') AS consignee_tel,
         o_orderstatus AS order_status, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS payment_way,
         CAST(o_custkey AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS img_url,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE) AS total_amount,
         CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS delivery_address,
         create_time, CAST(NULL AS VARCHAR) AS operate_time, CAST(NULL AS VARCHAR) AS tracking_no,
         CAST(NULL AS VARCHAR) AS parent_order_id, CAST(NULL AS VARCHAR) AS out_trade_no,
         CAST(NULL AS VARCHAR) AS trade_body,
         substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour,
         create_ts, (epoch_us(create_ts) // 1000) AS create_ms
  FROM (SELECT *, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS c_name,
               '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS tel,
               {_CREATE_TS} AS create_ts,
               strftime({_CREATE_TS}, '%Y-%m-%d %H:%M:%S') AS create_time
        FROM orders))"""

ORDERDETAIL = """orderdetail AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CAST(l_orderkey AS VARCHAR) AS order_id, 'sku_' || CAST(l_partkey AS VARCHAR) AS sku_name,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS order_price,
         CAST(NULL AS VARCHAR) AS img_url, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
         (epoch_us(l_shipdate) // 1000) AS arrival_ms, l_shipdate AS arrival_ts
  FROM lineitem)"""

USERS = f"""users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name,
         CAST(c_nationkey % 5 + 1 AS VARCHAR) AS user_level,
         strftime(DATE '{TB.BIRTHDAY_BASE}' + CAST(c_custkey % {TB.BIRTHDAY_SPAN_DAYS} AS INTEGER), '%Y-%m-%d') AS birthday,
         {_pick(['M', 'F'], 'c_custkey')} AS gender
  FROM customer WHERE c_mktsegment = '{TB.USER_SEGMENT}')"""

DAU = f"""dau AS (
  SELECT mid, uid, appid, area, os, channel, logtype, version, ts, logdate, loghour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logdate
             ORDER BY ts, uid, appid, area, os, channel, logtype, version, loghour) AS rn
    FROM startup) WHERE rn = 1)"""

_DAU_COLS = "mid, uid, appid, area, os, channel, logtype, version, ts, logdate, loghour"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _age(b: str, as_of: str) -> str:
    d = f"TRY_CAST({b} AS DATE)"
    return (f"CAST((epoch_ms(TIMESTAMP '{as_of}') - epoch_ms(CAST({d} AS TIMESTAMP))) "
            f"// {C.MS_PER_YEAR} AS INTEGER)")


def _kpi_list(date: str) -> str:
    return f"""
  SELECT 1 AS pos, '{C.KPI_DAU[0]}' AS id, '{C.KPI_DAU[1]}' AS name,
         CAST((SELECT count(*) FROM dau WHERE logdate = '{date}') AS VARCHAR) AS value
  UNION ALL SELECT 2, '{C.KPI_NEW_MID[0]}', '{C.KPI_NEW_MID[1]}', '{C.KPI_NEW_MID_VALUE}'
  UNION ALL SELECT 3, '{C.KPI_ORDER_AMOUNT[0]}', '{C.KPI_ORDER_AMOUNT[1]}',
         CAST(CAST(coalesce((SELECT sum(CAST(total_amount AS DECIMAL(16,2))) FROM orderinfo
                             WHERE create_date = '{date}'), 0) AS DOUBLE) AS VARCHAR)"""


def _kpi_json(date: str) -> str:
    return (f"SELECT '{date}' AS date, '[' || string_agg('{{\"id\":\"' || id || '\",\"name\":\"' || name "
            f"|| '\",\"value\":\"' || value || '\"}}', ',' ORDER BY pos) || ']' AS json "
            f"FROM ({_kpi_list(date)})")


ORACLE: dict[str, str] = {
    "startup_parse": _with(STARTUP) + f"SELECT {_DAU_COLS} FROM startup",
    "event_parse": _with(EVENTLOG) + "SELECT mid, uid, appid, area, os, logtype, eventid, pageid, "
                   "nextpageid, itemid, ts, logdate, loghour FROM eventlog",
    "order_parse": _with(ORDERINFO) + "SELECT id, province_id, consignee, order_comment, consignee_tel, "
                   "order_status, payment_way, user_id, img_url, total_amount, expire_time, "
                   "delivery_address, create_time, operate_time, tracking_no, parent_order_id, "
                   "out_trade_no, trade_body, create_date, create_hour FROM orderinfo",
    "detail_parse": _with(ORDERDETAIL) + "SELECT id, order_id, sku_name, sku_id, order_price, img_url, "
                    "sku_num, arrival_ms FROM orderdetail",
    "json_roundtrip": _with(EVENTLOG) + "SELECT mid, uid, appid, area, os, logtype, eventid, pageid, "
                      "nextpageid, itemid, ts, logdate, loghour FROM eventlog",
    "log_time_parts": _with(EVENTLOG) + "SELECT ts, logdate, loghour FROM eventlog",
    "order_time_parts": _with(ORDERINFO) + "SELECT id, create_time, create_date, create_hour FROM orderinfo",
    "mask_name": _with(ORDERINFO) + "SELECT id, consignee FROM orderinfo",
    "mask_phone": _with(ORDERINFO) + "SELECT id, consignee_tel FROM orderinfo",
    "user_age": _with(USERS.replace(f"WHERE c_mktsegment = '{TB.USER_SEGMENT}'", "")) + f"SELECT id, birthday, {_age('birthday', P.AS_OF)} AS user_age FROM users",
    "dau_first_start": _with(STARTUP, DAU) + f"SELECT {_DAU_COLS} FROM dau",
    "dau_new_devices": _with(STARTUP) + f"""
        , seen AS (SELECT DISTINCT mid, logdate FROM startup WHERE loghour < '{P.SEEN_BEFORE_HOUR}')
        , batch AS (SELECT * FROM startup s WHERE loghour >= '{P.SEEN_BEFORE_HOUR}'
                    AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.mid = s.mid AND seen.logdate = s.logdate))
        SELECT {_DAU_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY mid, logdate
                   ORDER BY ts, uid, appid, area, os, channel, logtype, version, loghour) AS rn
          FROM batch) WHERE rn = 1""",
    "dau_total": _with(STARTUP, DAU) + f"SELECT count(*) AS dau FROM dau WHERE logdate = '{P.DAU_DATE}'",
    "dau_by_hour": _with(STARTUP, DAU) + f"SELECT loghour, count(*) AS dau FROM dau "
                   f"WHERE logdate = '{P.DAU_DATE}' GROUP BY loghour",
    "dau_hour_map": _with(STARTUP, DAU) + f"""SELECT string_agg(loghour || ':' || CAST(n AS VARCHAR), ','
                   ORDER BY loghour) AS hour_map FROM (SELECT loghour, count(*) AS n FROM dau
                   WHERE logdate = '{P.DAU_DATE}' GROUP BY loghour)""",
    "amount_total": _with(ORDERINFO) + f"""SELECT CAST(coalesce(sum(CAST(total_amount AS DECIMAL(16,2))), 0)
                    AS DOUBLE) AS order_amount FROM orderinfo WHERE create_date = '{P.ORDER_DATE}'""",
    "amount_total_empty": _with(ORDERINFO) + f"""SELECT CAST(coalesce(sum(CAST(total_amount AS DECIMAL(16,2))), 0)
                    AS DOUBLE) AS order_amount FROM orderinfo WHERE create_date = '{P.EMPTY_ORDER_DATE}'""",
    "amount_by_hour": _with(ORDERINFO) + f"""SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(16,2)))
                      AS DOUBLE) AS order_amount FROM orderinfo WHERE create_date = '{P.ORDER_DATE}'
                      GROUP BY create_hour""",
    "amount_hour_map": _with(ORDERINFO) + f"""SELECT string_agg(create_hour || ':' || CAST(v AS VARCHAR), ','
                       ORDER BY create_hour) AS hour_map FROM (SELECT create_hour,
                       CAST(sum(CAST(total_amount AS DECIMAL(16,2))) AS DOUBLE) AS v FROM orderinfo
                       WHERE create_date = '{P.ORDER_DATE}' GROUP BY create_hour)""",
    "kpi_total": _with(STARTUP, DAU, ORDERINFO) + f"SELECT * FROM ({_kpi_list(P.DAU_DATE)}) "
                 f"UNION ALL SELECT * FROM ({_kpi_list(P.ORDER_DATE)})",
    "kpi_total_json": _with(STARTUP, DAU, ORDERINFO) + _kpi_json(P.DAU_DATE) + " UNION ALL "
                      + _kpi_json(P.ORDER_DATE),
}


# ------------------------------------------------------------- joins

_SALE = """SELECT d.id AS order_detail_id, i.id AS order_id, i.order_status, i.create_time, i.user_id,
       d.sku_id, TRY_CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name,
       substr(i.create_time, 1, 10) AS dt"""
_IN_INTERVAL = (f"d.arrival_ms BETWEEN i.create_ms - {P.JOIN_INTERVAL_MS} "
                f"AND i.create_ms + {P.JOIN_INTERVAL_MS}")
_SALE_INTERVAL = (f"{_SALE} FROM orderinfo i JOIN orderdetail d ON i.id = d.order_id "
                  f"AND {_IN_INTERVAL}")

ORACLE.update({
    "order_detail_full_outer": _with(ORDERINFO, ORDERDETAIL) + """
        SELECT coalesce(i.id, d.order_id) AS order_id, d.id AS order_detail_id,
               coalesce(i.batch, d.batch) AS batch, i.id IS NOT NULL AS has_info,
               d.id IS NOT NULL AS has_detail
        FROM (SELECT id, create_date AS batch FROM orderinfo) i
        FULL OUTER JOIN (SELECT id, order_id, strftime(arrival_ts, '%Y-%m-%d') AS batch
                         FROM orderdetail) d
          ON i.id = d.order_id AND i.batch = d.batch""",
    "sale_join": _with(ORDERINFO, ORDERDETAIL) + f"{_SALE} FROM orderinfo i JOIN orderdetail d "
                 "ON i.id = d.order_id",
    "sale_join_interval": _with(ORDERINFO, ORDERDETAIL) + _SALE_INTERVAL,
    "sale_unmatched": _with(ORDERINFO, ORDERDETAIL) + f"""
        SELECT 'order_info' AS side, i.id AS id, i.id AS order_id FROM orderinfo i
        WHERE NOT EXISTS (SELECT 1 FROM orderdetail d WHERE i.id = d.order_id AND {_IN_INTERVAL})
        UNION ALL
        SELECT 'order_detail', d.id, d.order_id FROM orderdetail d
        WHERE NOT EXISTS (SELECT 1 FROM orderinfo i WHERE i.id = d.order_id AND {_IN_INTERVAL})""",
    "sale_enriched": _with(ORDERINFO, ORDERDETAIL, USERS) + f"""
        SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
               u.gender AS user_gender, {_age('u.birthday', P.AS_OF)} AS user_age,
               u.user_level, s.sku_price, s.sku_name, s.dt
        FROM ({_SALE_INTERVAL}) s JOIN users u ON s.user_id = u.id""",
    "distinct_users": _with(ORDERINFO, ORDERDETAIL) + f"SELECT DISTINCT user_id FROM ({_SALE_INTERVAL})",
    "user_cache_semi": _with(ORDERINFO, ORDERDETAIL, USERS) + f"""
        SELECT * FROM users WHERE id IN (SELECT user_id FROM ({_SALE_INTERVAL}))""",
    "detail_latest_by_key": _with(ORDERDETAIL) + """
        SELECT id, order_id, sku_name, sku_id, order_price, img_url, sku_num, arrival_ms FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, id ORDER BY arrival_ms DESC,
                 sku_name DESC, sku_id DESC, order_price DESC, img_url DESC, sku_num DESC) AS rn
          FROM orderdetail) WHERE rn = 1""",
})


# ------------------------------------------------------------ alerts

_S_US = P.SLIDE_MS * 1000
_W_US = P.WINDOW_MS * 1000
WINDOWED = f"""windowed AS (
  SELECT mid, uid, eventid, itemid, ts, wstart // 1000 AS window_start_ms,
         wstart // 1000 + {P.WINDOW_MS} AS window_end_ms
  FROM (SELECT *, unnest(generate_series(p - {_W_US - _S_US}, p, {_S_US})) AS wstart
        FROM (SELECT *, epoch_us(event_ts) // {_S_US} * {_S_US} AS p FROM eventlog)))"""

_HITS = """hits AS (
  SELECT mid, window_start_ms, window_end_ms,
         count(DISTINCT CASE WHEN eventid = 'coupon' THEN uid END) AS n_uids
  FROM windowed GROUP BY mid, window_start_ms, window_end_ms
  HAVING NOT bool_or(eventid = 'clickItem')
     AND count(DISTINCT CASE WHEN eventid = 'coupon' THEN uid END) >= 3)"""

_DETAILS = """details AS (
  SELECT w.mid, w.window_start_ms, w.window_end_ms,
         array_to_string(list_sort(list_distinct(list(w.uid) FILTER (WHERE w.eventid = 'coupon'))), ',') AS uids,
         array_to_string(list_sort(list_distinct(list(w.itemid) FILTER (WHERE w.eventid = 'coupon'))), ',') AS item_ids,
         string_agg(w.eventid, ',' ORDER BY w.ts, w.eventid, w.uid, w.itemid) AS events
  FROM windowed w JOIN hits h ON w.mid = h.mid AND w.window_start_ms = h.window_start_ms
  GROUP BY w.mid, w.window_start_ms, w.window_end_ms)"""

ORACLE.update({
    "alert_windows": _with(EVENTLOG, WINDOWED) + """SELECT mid, window_start_ms, window_end_ms,
        count(*) AS n_events FROM windowed GROUP BY mid, window_start_ms, window_end_ms""",
    "alert_rule": _with(EVENTLOG, WINDOWED, _HITS) + "SELECT * FROM hits",
    "alert_items": _with(EVENTLOG, WINDOWED, _HITS, _DETAILS)
                   + "SELECT mid, window_start_ms, window_end_ms, uids, item_ids FROM details",
    "alert_events": _with(EVENTLOG, WINDOWED, _HITS, _DETAILS)
                    + "SELECT mid, window_start_ms, window_end_ms, events FROM details",
    "alert_docs": _with(EVENTLOG, WINDOWED, _HITS, _DETAILS) + f"""
        SELECT doc_id, mid, uids, item_ids, events, ts FROM (
          SELECT mid || '_' || CAST(window_end_ms // {P.DOC_BUCKET_MS} AS VARCHAR) AS doc_id, mid,
                 uids, item_ids, events, window_end_ms AS ts,
                 row_number() OVER (PARTITION BY mid || '_' || CAST(window_end_ms // {P.DOC_BUCKET_MS} AS VARCHAR)
                                    ORDER BY window_end_ms DESC) AS rn
          FROM details) WHERE rn = 1""",
})


# ------------------------------------------------- feeds and collector

_TYPE_O = _pick(TB.CHANGE_TYPES, "o_orderkey")
_TYPE_L = _pick(TB.CHANGE_TYPES, "l_orderkey + l_linenumber")
_INSERTS = f"""inserts AS (
  SELECT '{TB.CDC_DATABASE}' AS database, 'order_info' AS "table", {_TYPE_O} AS type, 1 AS n_rows,
         o_orderkey AS change_key FROM orders WHERE {_TYPE_O} = 'INSERT'
  UNION ALL
  SELECT '{TB.CDC_DATABASE}', 'order_detail', {_TYPE_L}, 1, l_orderkey + l_linenumber
  FROM lineitem WHERE {_TYPE_L} = 'INSERT')"""
_CDC_ROWS = f"""cdcrows AS (
  SELECT '{C.ORDER_INFO_TOPIC}' AS topic, CAST(o_orderkey AS VARCHAR) AS key,
         '{{"id":"' || CAST(o_orderkey AS VARCHAR) || '","user_id":"' || CAST(o_custkey AS VARCHAR)
         || '","order_status":"' || o_orderstatus || '","total_amount":"'
         || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) || '","create_time":"'
         || strftime({_CREATE_TS}, '%Y-%m-%d %H:%M:%S') || '","operate_time":""}}' AS value
  FROM orders WHERE {_TYPE_O} = 'INSERT'
  UNION ALL
  SELECT '{C.ORDER_DETAIL_TOPIC}', CAST(l_orderkey AS VARCHAR),
         '{{"id":"' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
         || '","order_id":"' || CAST(l_orderkey AS VARCHAR) || '","sku_id":"' || CAST(l_partkey AS VARCHAR)
         || '","order_price":"' || CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)
         || '","sku_num":"' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '"}}'
  FROM lineitem WHERE {_TYPE_L} = 'INSERT')"""
_STAMPED = """stamped AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'startup_topic' ELSE 'event_topic' END AS topic,
         epoch_us(ts) // 1000 + 1000 AS new_ts,
         strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%d') AS logdate
  FROM events)"""

ORACLE.update({
    "topic_scan": _with(EVENTLOG) + """SELECT mid, uid, eventid, pageid, nextpageid, itemid, ts FROM eventlog""",
    "cdc_insert_only": _with(_INSERTS) + "SELECT * FROM inserts",
    "cdc_rows": _with(_CDC_ROWS) + "SELECT key, value, topic FROM cdcrows",
    "cdc_route": _with(_CDC_ROWS) + "SELECT topic, count(*) AS n FROM cdcrows GROUP BY topic",
    "log_stamp_route": _with(_STAMPED) + """SELECT topic, count(*) AS n_logs, min(new_ts) AS min_ts,
        max(new_ts) AS max_ts, CAST(sum(new_ts) AS BIGINT) AS sum_ts FROM stamped GROUP BY topic""",
    "log_archive_daily": _with(_STAMPED) + "SELECT logdate, new_ts AS ts, topic FROM stamped",
})


# ------------------------------------------- streams equal their batch twins

ORACLE.update({
    "dau_stream": ORACLE["dau_first_start"],
    "alert_stream": ORACLE["alert_docs"],
    "sale_join_stream": ORACLE["sale_join_interval"],
    "sale_enriched_stream": ORACLE["sale_enriched"],
    "sink_upsert_roundtrip": ORACLE["order_parse"],
    "order_stream": ORACLE["order_parse"],
    "sink_append_roundtrip": ORACLE["sale_join_interval"],
})

ORACLE["alert_rule_panes"] = ORACLE["alert_rule"]

# ------------------------------------------------ dead letters, typed stamping

_DIRTY = f"""dirty AS (
  SELECT e.event_id, event_type = 'error' AS bad,
         CASE e.event_id % 3 WHEN 0 THEN 'not json ' || e.event_id WHEN 1 THEN '  '
              ELSE '{{"a":1,"a":2}}' END AS raw,
         l.mid, l.pageid, (epoch_us(e.ts) // 1000) AS ts
  FROM events e JOIN eventlog l ON l.event_id = e.event_id)"""

ORACLE["event_quarantine"] = f"WITH {EVENTLOG}, {_DIRTY}" + """
SELECT event_id, raw AS value FROM dirty WHERE bad AND event_id % 3 < 2"""

ORACLE["log_stamp_rows"] = f"WITH {EVENTLOG}, {_DIRTY}" + f"""
SELECT event_id, CASE WHEN bad THEN '{C.DEAD_TOPIC}' ELSE '{C.EVENT_TOPIC}' END AS topic, bad AS malformed,
       CASE WHEN bad THEN raw END AS raw, CASE WHEN NOT bad THEN ts::VARCHAR END AS ts,
       CASE WHEN NOT bad THEN mid END AS mid, CASE WHEN NOT bad THEN pageid END AS page,
       CASE WHEN NOT bad THEN false END AS page_is_text
FROM dirty"""

# Entries of a keyed buffer as gaps and islands: a put more than the expiry
# after its predecessor begins a new entry.
ORACLE["ttl_cache_state"] = f"""
WITH puts AS (
  SELECT l_orderkey || ':' || l_orderkey || '-' || l_linenumber AS key,
         '{{"id":"' || l_orderkey || '-' || l_linenumber || '","order_id":"' || l_orderkey
         || '","sku_name":"sku_' || l_partkey || '","sku_id":"' || l_partkey || '","order_price":"'
         || CAST(l_extendedprice AS DECIMAL(16,2)) || '","sku_num":"' || CAST(l_quantity AS INTEGER) || '"}}' AS value,
         epoch_us(l_shipdate::TIMESTAMP) // 1000 AS put_ms
  FROM lineitem),
fresh AS (
  SELECT *, CASE WHEN put_ms - lag(put_ms) OVER w <= {P.JOIN_INTERVAL_MS} THEN 0 ELSE 1 END AS first
  FROM puts WINDOW w AS (PARTITION BY key ORDER BY put_ms, value)),
entry AS (SELECT *, sum(first) OVER (PARTITION BY key ORDER BY put_ms, value) AS nth FROM fresh),
last AS (SELECT *, row_number() OVER (PARTITION BY key, nth ORDER BY put_ms DESC, value DESC) AS back FROM entry)
SELECT key, value, put_ms, put_ms + {P.JOIN_INTERVAL_MS} AS expired_ms FROM last WHERE back = 1"""


# ------------------------------------------------ streams of this round

def _statement(key: str, shift: int) -> str:
    """Statements that pass the feed's filters."""
    k = f"({key} + {shift})"
    return f"{_pick(TB.CHANGE_TYPES, k)} = 'INSERT' AND {k} % 5 <> 0 AND {k} % 11 <> 0"


ORACLE["cdc_stream"] = _with(_CDC_ROWS.replace(f"WHERE {_TYPE_O} = 'INSERT'",
                                               f"WHERE {_statement('o_orderkey', 0)} AND o_orderkey % 7 <> 0")
                             .replace(f"WHERE {_TYPE_L} = 'INSERT'", f"WHERE {_statement('l_orderkey', 1)}")
                             ) + "SELECT topic, key, value FROM cdcrows"

ORACLE["sale_unmatched_stream"] = ORACLE["sale_unmatched"]

ORACLE["buffer_drain_stream"] = f"""
SELECT 'sale' AS kind, order_id, order_detail_id AS id FROM ({ORACLE["sale_join_interval"]})
UNION ALL SELECT side, order_id, id FROM ({ORACLE["sale_unmatched"]})"""

ORACLE["dau_new_devices_stream"] = _with(STARTUP) + f"""
SELECT {_DAU_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logdate
           ORDER BY loghour < '{P.SEEN_BEFORE_HOUR}', ts, uid, appid, area, os, channel, logtype, version, loghour) AS rn
  FROM startup) WHERE rn = 1"""

_EDITION = f"""SELECT CAST(c_custkey AS VARCHAR) AS id,
         CAST((c_nationkey + e) % 5 + 1 AS VARCHAR) AS user_level, e,
         strftime(DATE '{TB.BIRTHDAY_BASE}' + CAST((c_custkey + {TB.EDITION_DAYS} * e) % {TB.BIRTHDAY_SPAN_DAYS} AS INTEGER),
                  '%Y-%m-%d') AS birthday, {_pick(['M', 'F'], 'c_custkey')} AS gender
  FROM customer, (VALUES (0), (1)) AS v(e) WHERE c_mktsegment = '{TB.USER_SEGMENT}'"""
ORACLE["sale_versions_stream"] = _with(ORDERINFO, ORDERDETAIL, f"editions AS ({_EDITION})") + f"""
SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
       u.gender AS user_gender, {_age('u.birthday', P.AS_OF)} AS user_age,
       u.user_level, s.sku_price, s.sku_name, s.dt
FROM ({_SALE_INTERVAL}) s JOIN editions u ON s.user_id = u.id
  AND u.e = CASE WHEN epoch_ms(CAST(s.create_time AS TIMESTAMP)) >= {P.USERS_CHANGE_MS} THEN 1 ELSE 0 END"""

ORACLE["doc_generated_ids"] = f"""
WITH d AS (
  SELECT event_id, 'mid_' || (user_id % {TB.EVENT_DEVICES}) AS mid, event_type AS kind,
         strftime(ts, '%Y-%m-%d') AS day, event_id % 2 AS b FROM events),
n AS (
  SELECT *, '{{"mid":"' || mid || '","kind":"' || kind || '","day":"' || day || '"}}' AS content,
         row_number() OVER (PARTITION BY b, mid, kind, day ORDER BY event_id) AS nth FROM d)
SELECT CASE WHEN kind = 'purchase' THEN 'evt_' || event_id
            ELSE sha256('{P.DOC_WRITER}|' || b || '|' || nth || '|' || content) END AS doc_id, mid, kind, day
FROM n"""


# Stamped lines have their fields by name, the collector's time last.
ORACLE["log_intake_stream"] = f"WITH {EVENTLOG}, {_DIRTY}," + f"""
line AS (
  SELECT strftime(e.ts, '%Y-%m-%d') AS day,
         CASE e.event_type WHEN 'error' THEN '{C.DEAD_TOPIC}' WHEN 'signup' THEN '{C.STARTUP_TOPIC}'
              ELSE '{C.EVENT_TOPIC}' END AS topic,
         CASE e.event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'mid_' || e.user_id ELSE l.mid END AS key,
         CASE e.event_type WHEN 'error' THEN d.raw
           WHEN 'signup' THEN '{{"appId":"{C.APP_ID}","area":"' || {_named('area', 'e.user_id')} || '","channel":"'
             || {_named('channel', 'e.event_id')} || '","logType":"startup","mid":"mid_' || e.user_id || '","os":"'
             || {_named('os', 'e.user_id')} || '","uid":"' || e.user_id || '","version":"'
             || {_named('version', 'e.event_id')} || '","ts":' || l.ts || '}}'
           ELSE '{{"appId":"{C.APP_ID}","area":"' || l.area || '","eventId":"' || l.eventid || '","itemId":' || l.itemid
             || ',"logType":"event","mid":"' || l.mid || '","nextPageId":' || l.nextpageid || ',"os":"' || l.os
             || '","pageId":' || l.pageid || ',"uid":"' || l.uid || '","ts":' || l.ts || '}}' END AS value
  FROM events e JOIN eventlog l ON l.event_id = e.event_id JOIN dirty d ON d.event_id = e.event_id)
SELECT topic AS sink, key, value, day FROM line
UNION ALL SELECT 'archive', NULL, value, day FROM line"""
