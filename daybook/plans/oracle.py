"""DuckDB SQL with the same results as each registered query.

``E`` mirrors the fixture adapter (:mod:`daybook.sources.fixtures`): the 22
parsed columns of the wire document that adapter writes for each ``events``
row, computed directly with SQL expressions.
"""

from __future__ import annotations

_KIND = ("CASE event_type WHEN 'signup' THEN 'auth' WHEN 'purchase' THEN 'login' "
         "WHEN 'click' THEN 'visit' WHEN 'view' THEN 'visit' END")
_LEGACY_LABEL = ("CASE event_type WHEN 'signup' THEN '授权' WHEN 'purchase' THEN '登录' "
                 "WHEN 'click' THEN '访问' WHEN 'view' THEN '访问' ELSE event_type END")

E = f"""
WITH B AS (
  SELECT event_id, user_id, ts, event_type, {_KIND} AS dataType FROM events
), E AS (
  SELECT event_id, event_id % 4 AS batch, CAST(ts AS DATE) AS dt, user_id, event_type,
    dataType,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS reportTime,
    'o' || user_id AS openid,
    'n' || (user_id % 10) AS nickname,
    CAST(event_id % 3 AS VARCHAR) AS gender,
    CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'y' || (user_id % 6) END AS city,
    'c' || (user_id % 3) AS country,
    'v' || (user_id % 4) AS province,
    CASE WHEN user_id % 2 = 0 THEN 'zh_CN' ELSE 'en' END AS language,
    CAST(1700000000000 + user_id * 1000 AS VARCHAR) AS subscribeTime,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'u' || user_id END AS unionid,
    CASE WHEN dataType IN ('auth', 'login')
         THEN 30.0 + CAST(event_id % 100 AS DOUBLE) / 4.0 END AS latitude,
    CASE WHEN dataType IN ('auth', 'login')
         THEN 120.0 + CAST(event_id % 64 AS DOUBLE) / 8.0 END AS longitude,
    CASE WHEN dataType IN ('auth', 'login') AND user_id % 5 <> 0 THEN 'id' || user_id END AS userid,
    CASE WHEN dataType IN ('auth', 'login') AND event_id % 4 <> 0 THEN 'p' || user_id END AS phoneNo,
    CASE WHEN dataType = 'login' THEN event_id % 2 = 0 END AS succeed,
    CASE WHEN dataType = 'login' THEN event_id % 3 = 0 END AS firstLogin,
    CASE WHEN dataType = 'visit' AND event_id % 11 <> 0 THEN 'page/' || (event_id % 13) END AS pageUrl,
    CAST(NULL AS VARCHAR) AS pageParam,
    CASE WHEN dataType = 'visit' THEN 't' || (event_id % 3) END AS pageType,
    CASE WHEN dataType = 'visit' THEN 'm' || (event_id % 5) END AS modelId,
    CASE WHEN dataType = 'visit' THEN 's' || (event_id % 2) END AS seriesId
  FROM B
)
"""

FLAT = ("dataType, reportTime, openid, nickname, gender, city, country, province, language, "
        "subscribeTime, unionid, latitude, longitude, userid, phoneNo, succeed, firstLogin, "
        "pageUrl, pageParam, pageType, modelId, seriesId")


def _marked(cols: str) -> str:
    return ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '\\N')" for c in cols.split(","))


LINE = f"concat_ws(';', {_marked(FLAT)})"
DAY = "strftime(dt, '%Y-%m-%d')"

_DOCUMENTED = ("dataType IN ('auth', 'login') AND unionid IS NOT NULL "
               "AND userid IS NOT NULL AND phoneNo IS NOT NULL")
_OBSERVED = ("dataType = 'auth' OR (dataType = 'login' AND coalesce(trim(unionid) <> '', TRUE) "
             "AND coalesce(trim(userid) <> '', TRUE) AND coalesce(trim(phoneNo) <> '', TRUE))")
_ID_COLS = "event_id, dataType, unionid, openid, userid, phoneNo"
_BODY = """'{"unionId":"' || unionid || '","openId":"' || openid || '"}'"""

_BODY_OBSERVED = r"""'{"unionId":"' || coalesce(unionid, '\\N') || '","openId":"' || openid || '"}'"""

_LEGACY_OK = "NOT (event_id % 53 = 0 OR event_id % 59 = 0)"
_WX = ("openid, nickname, gender, coalesce(city, ''), country, province, language, "
       "subscribeTime, unionid")
_ADDR_USER = ("CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), coalesce(userid, ''), "
              "phoneNo")


# a day reported in 2099 counts as the arrival day
_LATE_DAY = ("strftime(CASE WHEN event_id % 1000 = 7 THEN CAST(reportTime AS TIMESTAMP) "
             "+ to_days(CAST(event_id % 11 AS INTEGER)) ELSE CAST(reportTime AS TIMESTAMP) END, '%Y-%m-%d')")


def _legacy_lines(kind: str, fields: str, required: str, guard: str = _LEGACY_OK) -> str:
    return (f"{E} SELECT event_id, concat_ws(',', {fields}) AS line FROM E "
            f"WHERE dataType = '{kind}' AND {required} AND {guard}")


def _pv(where: str = "TRUE") -> str:
    return (f"{E} SELECT {DAY} AS dt, count(*) AS pv FROM E "
            f"WHERE pageUrl IS NOT NULL AND {where} GROUP BY dt")


def _uv() -> str:
    return (f"{E} SELECT {DAY} AS dt, count(DISTINCT unionid) AS uv FROM E "
            "WHERE unionid IS NOT NULL GROUP BY dt")


_LEGACY_LINES = {
    "auth": (f"{_WX}, {_ADDR_USER}", "unionid IS NOT NULL AND phoneNo IS NOT NULL"),
    "login": (f"{_WX}, {_ADDR_USER}, CAST(succeed AS VARCHAR), CAST(firstLogin AS VARCHAR)",
              "unionid IS NOT NULL AND phoneNo IS NOT NULL"),
    "visit": (f"{_WX}, coalesce(pageUrl, ''), '', pageType, modelId, seriesId", "unionid IS NOT NULL"),
}

_FILTER_COUNTS = (
    f"{E}, V AS (SELECT batch, dt, unionid, min(batch) OVER (PARTITION BY dt, unionid) AS first_b "
    "FROM E WHERE unionid IS NOT NULL) "
    "SELECT batch, count(*) AS before_n, CAST(sum(CASE WHEN batch = first_b THEN 1 ELSE 0 END) "
    "AS BIGINT) AS after_n FROM V GROUP BY batch")

# arrivals are four equal spans of the arrival times; a visitor and day is
# added in the first of them, at the time of the span's last row
_SEEN_TTL = """
WITH A AS (
  SELECT event_id, user_id, ts, CAST(ts AS TIMESTAMP) + to_days(CAST(event_id % 11 AS INTEGER)) AS came FROM events
), B AS (SELECT min(epoch_us(came)) AS lo, (max(epoch_us(came)) - min(epoch_us(came))) // 4 + 1 AS width FROM A),
S AS (
  SELECT (epoch_us(came) - lo) // width AS k, came, 'u' || user_id AS unionid, user_id % 7 <> 0 AS named,
         CAST(CASE WHEN event_id % 1000 = 7 THEN came ELSE ts END AS DATE) AS dt
  FROM A, B
), C AS (SELECT k, max(came) AS clock FROM S GROUP BY k),
V AS (SELECT dt, unionid, min(k) AS k FROM S WHERE named GROUP BY dt, unionid),
D AS (SELECT dt, max(clock) AS added FROM V JOIN C USING (k) GROUP BY dt)
SELECT strftime(dt, '%Y-%m-%d') AS dt, unionid FROM V JOIN D USING (dt)
WHERE added >= (SELECT max(clock) FROM C) - INTERVAL 5 DAYS
"""

ORACLE: dict[str, str] = {
    "read_wire_text": f"{E} SELECT dataType, reportTime, openid FROM E",
    "parse_events": f"{E} SELECT event_id, {FLAT} FROM E",
    "encode_line": f"{E} SELECT event_id, {LINE} AS line FROM E",
    "decode_line": f"{E} SELECT event_id, {FLAT} FROM E",
    "quarantine": (
        f"{E} SELECT {DAY} AS dt, CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE 'good' END AS status, "
        "count(*) AS n FROM E GROUP BY 1, 2"),
    "quarantine_rows": (
        "SELECT event_id, 'malformed' AS reason FROM events WHERE event_id % 97 = 0"),
    "identity_eligible": f"{E} SELECT {_ID_COLS} FROM E WHERE {_DOCUMENTED}",
    "identity_eligible_observed": f"{E} SELECT {_ID_COLS} FROM E WHERE {_OBSERVED}",
    "identity_outbox": f"{E} SELECT event_id, {_BODY} AS body FROM E WHERE {_DOCUMENTED}",
    "identity_outbox_observed": f"{E} SELECT event_id, {_BODY_OBSERVED} AS body FROM E WHERE {_OBSERVED}",
    "reply_audit": (
        f"{E} SELECT CAST(CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 500 WHEN 4 THEN 200 END "
        f"AS INTEGER) AS code, count(*) AS n FROM E WHERE {_DOCUMENTED} GROUP BY 1"),
    "page_views": f"{E} SELECT event_id, {DAY} AS dt, pageUrl FROM E WHERE pageUrl IS NOT NULL",
    "visitor_rows": f"{E} SELECT {DAY} AS dt, unionid FROM E WHERE unionid IS NOT NULL",
    "pv_daily": _pv(),
    "uv_daily": _uv(),
    "uv_daily_observed": (
        f"{E} SELECT {DAY} AS dt, CAST(sum(n) AS BIGINT) AS uv FROM ("
        "SELECT dt, batch, count(DISTINCT unionid) AS n FROM E WHERE unionid IS NOT NULL "
        "GROUP BY dt, batch) GROUP BY dt"),
    "batch_dedup": (
        f"{E} SELECT DISTINCT batch, {DAY} AS dt, unionid FROM E WHERE unionid IS NOT NULL"),
    "new_visitors": (
        f"{E} SELECT {DAY} AS dt, unionid FROM ("
        "SELECT DISTINCT dt, unionid FROM E WHERE unionid IS NOT NULL AND batch = 3 "
        "EXCEPT SELECT DISTINCT dt, unionid FROM E WHERE unionid IS NOT NULL AND batch < 3)"),
    "seen_visitors": f"{E} SELECT DISTINCT {DAY} AS dt, unionid FROM E WHERE unionid IS NOT NULL",
    "seen_bucketed": (
        f"{E} SELECT {DAY} AS dt, count(DISTINCT unionid) AS uv, count(DISTINCT unionid) AS amount FROM E "
        "WHERE unionid IS NOT NULL GROUP BY dt"),
    "filter_counts": _FILTER_COUNTS,
    "filter_counts_stream": _FILTER_COUNTS,
    "seen_expire_totals": (
        f"{E} SELECT {DAY} AS dt, count(DISTINCT unionid) + CASE WHEN dt = (SELECT min(dt) FROM E "
        "WHERE unionid IS NOT NULL) THEN 1 ELSE 0 END AS amount FROM E WHERE unionid IS NOT NULL GROUP BY dt"),
    "seen_ttl": _SEEN_TTL,
    "pv_snapshot": (
        f"{E}, N AS (SELECT batch, dt, count(*) AS n FROM E WHERE pageUrl IS NOT NULL GROUP BY 1, 2) "
        f"SELECT batch AS batch_id, {DAY} AS dt, CAST(sum(n) OVER (PARTITION BY dt ORDER BY batch) AS BIGINT) AS amount FROM N"),
    "pv_times": (
        f"{E} SELECT {DAY} AS dt, count(*) AS amount, "
        + ", ".join(f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST({f}(batch) AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS {c}"
                    for f, c in (("min", "create_time"), ("max", "update_time")))
        + " FROM E WHERE pageUrl IS NOT NULL GROUP BY dt"),
    "uv_snapshot": (
        f"{E}, V AS (SELECT dt, unionid, min(batch) AS batch FROM E WHERE unionid IS NOT NULL GROUP BY 1, 2), "
        "N AS (SELECT batch, dt, count(*) AS n FROM V GROUP BY 1, 2) "
        f"SELECT batch AS batch_id, {DAY} AS dt, CAST(sum(n) OVER (PARTITION BY dt ORDER BY batch) AS BIGINT) AS amount FROM N"),
    "pv_daily_stream": _pv().replace("count(*) AS pv", "count(*) AS amount"),
    "uv_daily_stream": _uv().replace("AS uv", "AS amount"),
    "pv_daily_stream_late": f"{E} SELECT {_LATE_DAY} AS dt, count(*) AS amount FROM E WHERE pageUrl IS NOT NULL GROUP BY 1",
    "uv_daily_stream_late": (
        f"{E} SELECT {_LATE_DAY} AS dt, count(DISTINCT unionid) AS amount FROM E WHERE unionid IS NOT NULL GROUP BY 1"),
    **{f"{m}_state_stream": f"{E} SELECT {_LATE_DAY} AS dt, count({what}) AS amount FROM E WHERE {c} IS NOT NULL GROUP BY 1"
       for m, what, c in (("pv", "*", "pageUrl"), ("uv", "DISTINCT unionid", "unionid"))},
    "state_audit": (
        f"{E} SELECT {_LATE_DAY} AS dt, count(DISTINCT unionid) AS amount, count(DISTINCT unionid) AS in_state "
        "FROM E WHERE unionid IS NOT NULL GROUP BY 1"),
    "resume_totals": (
        f"{E} SELECT 'pv' AS kind, {DAY} AS key, count(*) AS amount FROM E WHERE pageUrl IS NOT NULL GROUP BY dt "
        f"UNION ALL SELECT 'uv', {DAY}, count(DISTINCT unionid) FROM E WHERE unionid IS NOT NULL GROUP BY dt "
        f"UNION ALL SELECT 'outbox', event_id || ' ' || {_BODY}, 1 FROM E WHERE {_DOCUMENTED}"),
    "daily_archive": f"{E} SELECT {DAY} AS dt, {LINE} AS line FROM E",
    "archive_merged": f"{E} SELECT {DAY} AS dt, {LINE} AS line FROM E",
    "archive_stream": f"{E} SELECT {DAY} AS dt, {LINE} AS line FROM E",
    "archive_lines": f"{E} SELECT {DAY} AS dt, {LINE} AS line FROM E WHERE event_id % 97 <> 0",
    "offset_ledger": (
        "SELECT 'daybook' AS module, 'daybook-group' AS group_id, 'behavior-events' AS topic, "
        "CAST(user_id % 4 AS INTEGER) AS partition, max(event_id) + 1 AS until_offset "
        "FROM events GROUP BY user_id % 4"),
    "offset_ledger_rollback": (
        "SELECT 'daybook' AS module, 'daybook-group' AS group_id, 'behavior-events' AS topic, "
        "CAST(user_id % 4 AS INTEGER) AS partition, max(event_id) + 1 AS until_offset "
        "FROM events GROUP BY user_id % 4"),
    "starting_offsets": (
        """SELECT '{"behavior-events":{' || string_agg('"' || p || '":' || u, ',' ORDER BY p) """
        """|| '}}' AS starting_offsets FROM (SELECT CAST(user_id % 4 AS VARCHAR) AS p, """
        """max(event_id) + 1 AS u FROM events GROUP BY 1)"""),
    "legacy_guard": (
        f"SELECT {_LEGACY_OK} AS passed, count(*) AS n FROM events GROUP BY 1"),
    **{f"legacy_{k}": _legacy_lines(k, *v) for k, v in _LEGACY_LINES.items()},
    "legacy_stream_lines": " UNION ALL ".join(
        f"SELECT line FROM ({_legacy_lines(k, *v)})" for k, v in _LEGACY_LINES.items()),
    "legacy_batch_lines": " UNION ALL ".join(
        f"SELECT line FROM ({_legacy_lines(k, *v, 'TRUE')})" for k, v in _LEGACY_LINES.items()),
    "legacy_status": (
        f"{E} SELECT {_LEGACY_LABEL} AS label, CASE "
        f"WHEN NOT ({_LEGACY_OK}) THEN 'guard' "
        "WHEN dataType IS NULL THEN 'unknown' "
        "WHEN unionid IS NULL THEN 'bad' "
        "WHEN dataType IN ('auth', 'login') AND phoneNo IS NULL THEN 'bad' "
        "ELSE 'ok' END AS status, count(*) AS n FROM E GROUP BY 1, 2"),
    "legacy_labels": (
        f"{E} SELECT {_LEGACY_LABEL} AS label, dataType, count(*) AS n FROM E GROUP BY 1, 2"),
}
