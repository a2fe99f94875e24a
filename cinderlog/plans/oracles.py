"""SQL that gives the expected rows of each registered query straight from the given tables."""

from __future__ import annotations

from cinderlog.plans.adapter import EXTENSIONS, RAW_EXTENSIONS
from cinderlog.plans.queries import INDEXED_USER, ANY_TERMS, CHANGED_EVERY, SEARCH_NON_ASCII, SEARCH_NUMBERS, SEARCH_PHRASE, SEARCH_TERMS
from cinderlog.schema import PARSER_BY_EXTENSION, TAG_BY_EXTENSION

_A = """a AS (
  SELECT event_id, user_id, ts, value, event_type, CAST(event_id AS VARCHAR) AS log_id,
    concat('host-', user_id % 7) AS host, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_text,
    date_trunc('second', ts) AS ts_sec, epoch_us(date_trunc('second', ts)) AS at_us,
    concat('svc-', user_id % 5) AS service, concat('i-', user_id % 3) AS instance_id,
    concat('ns-', user_id % 2) AS namespace, concat('pod-', user_id % 11) AS pod_name,
    concat('t', user_id) AS trace_id,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' WHEN 'view' THEN 'DEBUG'
                    WHEN 'signup' THEN 'TRACE' ELSE 'INFO' END AS level,
    concat(event_type, ' event, user ', user_id) AS message,
    json_extract_string(props, '$.k') AS attr_k
  FROM events)"""


def _json_line(attributes: str | None = None) -> str:
    attributes = attributes or """'[{"id":', log_id, ',"logId":"', log_id, '","key":"k","value":"', attr_k, '"}]'"""
    return f"""concat('{{"logId":"', log_id, '","host":"', host, '","timestamp":"', ts_text, '","service":"', service,
      '","instanceId":"', instance_id, '","namespace":"', namespace, '","podName":"', pod_name, '","traceId":"', trace_id,
      '","level":"', level, '","message":"', message, '","attributes":', {attributes}, '}}')"""


def _document(stamp: str) -> str:
    return f"""concat('{{"logId":"', log_id, '","host":"', host, '","timestamp":', {stamp}, ',"ingestionTimestamp":null',
      ',"service":"', service, '","instanceId":"', instance_id, '","namespace":"', namespace, '","podName":"', pod_name,
      '","traceId":"', trace_id, '","level":"', level, '","message":"', message, '","attributes":[{{"id":', log_id,
      ',"logId":"', log_id, '","key":"k","value":"', attr_k, '"}}]}}')"""


_EPOCH_DOC = _document("CAST(at_us // 1000000 AS VARCHAR), '.000000000'")
_ISO_DOC = _document("""'"', strftime(ts_sec, '%Y-%m-%dT%H:%M:%S.%fZ'), '"'""")


def _from_a(select: str, more: str = "") -> str:
    return f"WITH {_A} {select} FROM a {more}"


def _case(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def _pick(values: tuple[str, ...]) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[event_id % {len(values)} + 1]"


_REASON = """CASE event_id % 10 WHEN 0 THEN 'empty' WHEN 1 THEN 'not_json_object' WHEN 2 THEN 'unknown_field'
  WHEN 3 THEN 'bad_level' WHEN 4 THEN 'bad_timestamp' WHEN 5 THEN 'bad_attributes' WHEN 6 THEN 'type_mismatch'
  WHEN 7 THEN 'oversize' ELSE 'valid' END"""

_RECORDS = f"""{_A}, r AS (SELECT event_id AS body_id, level, i, concat(log_id, '-', i) AS log_id
  FROM a, unnest(range(0, event_id % 3 + 1)) AS u(i))"""

_LOG_LINE = """concat('[', ts_text, '] [', level, '] [', service, '] [', host, '] logId=', log_id, ' instanceId=', instance_id,
  ' namespace=', namespace, ' podName=', pod_name, ' traceId=', trace_id, ' - ', message, ' | k=', attr_k)"""

_NO_WORD = r"[^\p{L}\p{N}_]"


def _holds(text: str, phrase: str) -> str:
    """Whether the words of the phrase stand in the text, parted by anything that is no word."""
    return f"regexp_matches(lower({text}), '(^|{_NO_WORD}){f'{_NO_WORD}+'.join(phrase.split())}($|{_NO_WORD})')"


_TOKENS = rf"list_filter(regexp_split_to_array(lower(text), '{_NO_WORD}+'), lambda w: w <> '')"
_LEVELS_TAILED = _from_a("SELECT log_id, level, message")


def _score(terms: tuple[str, ...]) -> str:
    wanted = ", ".join(f"'{t}'" for t in sorted(terms))
    return f"CAST(len(list_filter({_TOKENS}, lambda w: list_contains([{wanted}], w))) AS BIGINT)"


def _search(terms: tuple[str, ...], mode: str) -> str:
    joined = f" {'AND' if mode == 'all' else 'OR'} ".join(_holds("text", t) for t in terms)
    return f"SELECT doc_id, {_score(terms)} AS score FROM documents WHERE {joined}"


_METRICS = """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, service, count(*) AS n,
  count(*) FILTER (WHERE level = 'ERROR') AS n_error,
  round(count(*) FILTER (WHERE level = 'ERROR') / count(*)::DOUBLE, 6) AS error_ratio,
  CAST(sum({bytes}) AS BIGINT) AS bytes FROM {source} GROUP BY h, service"""

ORACLES = {
    "src_raw_json": _from_a(f"SELECT {_json_line()} AS value"),
    "tail_log_lines": _LEVELS_TAILED,
    "tail_json_lines": _LEVELS_TAILED,
    "tail_csv_lines": _LEVELS_TAILED,
    "tail_raw_lines": _from_a(f"""SELECT concat('logs.', {_pick(RAW_EXTENSIONS)}) AS tag, concat('c-', user_id % 4) AS client_id,
      {_LOG_LINE} AS value"""),
    "landing_path_columns": _from_a(f"""SELECT log_id, concat('c-', user_id % 4) AS client_id,
      concat_ws('-', substr(md5(log_id), 1, 8), substr(md5(log_id), 9, 4), substr(md5(log_id), 13, 4),
                substr(md5(log_id), 17, 4), substr(md5(log_id), 21, 12)) AS upload_id,
      concat('app_', log_id, '.', {_pick(EXTENSIONS)}) AS file_name, {_pick(EXTENSIONS)} AS ext"""),
    "explode_request_body": f"WITH {_RECORDS} SELECT body_id, log_id, level FROM r",
    "body_quarantine": f"""WITH {_A}, b AS (SELECT event_id AS body_id, concat('[', array_to_string(list_transform(
        range(0, event_id % 3 + 1), lambda i: concat('{{"date":1.5,"logId":"', log_id, '-', i, '","level":"', level,
        '","n":1.10,"x":{{"b":', i, '}}}}')), ','), ']') AS body FROM a)
      SELECT body_id, CASE body_id % 4 WHEN 1 THEN left(body, 20) WHEN 2 THEN concat(left(body, length(body) - 1), ',5]')
        ELSE '{{"a":1}}' END AS raw, CASE body_id % 4 WHEN 1 THEN 'not_json' ELSE 'not_array_of_objects' END AS reason
      FROM b WHERE body_id % 4 > 0""",
    "body_record_count": "SELECT event_id AS body_id, event_id % 3 + 1 AS n FROM events",
    "drop_date_key": f"WITH {_RECORDS} SELECT log_id, CAST(4 AS BIGINT) AS n_keys, false AS has_date FROM r",
    "kafka_payload": f"""WITH {_RECORDS} SELECT log_id,
      concat('{{"logId":"', log_id, '","level":"', level, '","n":1.1,"x":{{"b":', i, '}}}}') AS value FROM r""",
    "bind_log_event": _from_a("""SELECT log_id, host, strftime(ts_sec, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingestion_time, service, instance_id, namespace, pod_name, trace_id,
      level, message, 'k' AS attr_key, attr_k AS attr_value"""),
    "validate_split": _from_a(f"SELECT log_id, event_id % 10 >= 8 AS is_valid, {_REASON} AS reason"),
    "quarantine_counts": _from_a(f"SELECT {_REASON} AS reason, count(*) AS n", "WHERE event_id % 10 < 8 GROUP BY 1"),
    "filter_valid_level": _from_a("SELECT level, count(*) AS n", "WHERE event_id % 10 <> 3 GROUP BY 1"),
    "replay_quarantine": _from_a(
        f"SELECT replace({_REASON}, 'oversize', 'valid') AS reason, count(*) AS n", "WHERE event_id % 10 < 8 GROUP BY 1"),
    "replay_out": _from_a(f"""SELECT log_id, CASE WHEN event_id % 10 >= 7 THEN 'index' ELSE 'quarantine' END AS place,
      CASE WHEN event_id % 10 < 7 THEN {_REASON} END AS reason"""),
    "route_by_extension": _from_a(
        f"SELECT ext, {_case('ext', PARSER_BY_EXTENSION)} AS parser, count(*) AS n",
        ).replace("FROM a", f"FROM (SELECT {_pick((*EXTENSIONS, 'png'))} AS ext FROM a) WHERE ext <> 'png' GROUP BY ext"),
    "filter_by_tag": _from_a(
        f"SELECT {_case('ext', TAG_BY_EXTENSION)} AS tag, count(*) AS n",
        ).replace("FROM a", f"FROM (SELECT {_pick((*EXTENSIONS, 'png'))} AS ext FROM a) WHERE ext LIKE 'y%' GROUP BY ext"),
    "csv_line_match": "SELECT event_id % 10 = 9 AS matched, count(*) AS n FROM events GROUP BY 1",
    "union_all_formats": _from_a("SELECT (['logs.app', 'logs.json', 'logs.csv'])[event_id % 3 + 1] AS tag, log_id, level"),
    "mixed_formats": _from_a("SELECT (['logs.app', 'logs.json', 'logs.csv'])[event_id % 3 + 1] AS tag, log_id, level"),
    "parse_log_line": _from_a("""SELECT ts_text AS timestamp, level, service, host, log_id AS "logId",
      instance_id AS "instanceId", namespace, pod_name AS "podName", trace_id AS "traceId", message,
      concat('k=', attr_k) AS attributes"""),
    "parse_csv_line": _from_a("""SELECT log_id AS "logId", host, ts_text AS timestamp, service,
      instance_id AS "instanceId", namespace, pod_name AS "podName", trace_id AS "traceId", level, message"""),
    "parse_log_time": _from_a("SELECT log_id, at_us AS epoch_us"),
    "normalize_timestamp": _from_a(
        "SELECT log_id, CASE WHEN event_id % 3 = 0 THEN at_us ELSE epoch_us(ts) END AS epoch_us"),
    "parse_attributes": _from_a("SELECT log_id, 'k' AS key, attr_k AS value")
        + " UNION ALL SELECT log_id, 'user', CAST(user_id AS VARCHAR) FROM a WHERE event_id % 3 = 2",
    "event_to_json": _from_a(f"SELECT log_id, {_ISO_DOC} AS value"),
    "bulk_index_actions": _from_a("""SELECT log_id, CAST(0 AS BIGINT) AS seq,
      concat('{"index":{"_index":"logs","_id":"', log_id, '"}}') AS line""")
        + f" UNION ALL SELECT log_id, 1, {_EPOCH_DOC} FROM a",
    "document_size": _from_a(f"SELECT log_id, CAST(strlen({_EPOCH_DOC}) AS BIGINT) AS bytes"),
    "oversize_filter": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, strlen(text) > 8192 AS is_oversize FROM documents",
    "bulk_batches_by_count": _from_a("""SELECT count(*) AS docs, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(0 AS BIGINT) AS over,
      CAST(0 AS BIGINT) AS not_full"""),
    "bulk_batches_by_bytes": _from_a(f"""SELECT count(*) AS docs, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(sum(strlen({_EPOCH_DOC})) AS BIGINT) AS bytes,
      CAST(0 AS BIGINT) AS over_count, CAST(0 AS BIGINT) AS over_bytes, CAST(0 AS BIGINT) AS closed_early"""),
    "doc_timestamp_forms": _from_a("""SELECT log_id, strftime(ts_sec, '%Y-%m-%d %H:%M:%S') AS dt,
      strftime(ts_sec, '%Y-%m-%d') AS d, strftime(ts_sec, '%H:%M:%S') AS t"""),
    "attributes_flat": _from_a("SELECT log_id, 'k' AS key, attr_k AS value")
        + " UNION ALL SELECT log_id, 'user', CAST(user_id AS VARCHAR) FROM a",
    "attributes_nest": _from_a("""SELECT event_id, CASE WHEN event_id % 10 > 0 THEN log_id END AS log_id,
      concat(event_id * 2, ':', log_id, ':user:', user_id, ',', event_id * 2 + 1, ':', log_id, ':k:', attr_k) AS attributes"""),
    "transform_event": _from_a("""SELECT log_id,
      CAST(list_position(['TRACE', 'DEBUG', 'INFO', 'WARN', 'ERROR'], level) - 1 AS BIGINT) AS level_rank,
      strftime(ts_sec, '%Y-%m-%d') AS event_date, CAST(hour(ts_sec) AS BIGINT) AS event_hour"""),
    "enrich_service_dim": _from_a("SELECT log_id, service, r_name AS region", """
      LEFT JOIN nation ON service = concat('svc-', n_nationkey) LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "metrics_per_hour": f"WITH {_A} " + _METRICS.format(
        bytes="strlen(message)", source="(SELECT *, date_trunc('hour', ts_sec) AS h FROM a)"),
    "metrics_stream": f"WITH {_A} " + _METRICS.format(
        bytes="strlen(event_type)", source="(SELECT *, date_trunc('hour', ts) AS h FROM a)"),
    "metrics_sliding": f"WITH {_A} " + _METRICS.format(
        bytes="strlen(message)", source="""(SELECT *, time_bucket(INTERVAL 30 MINUTE, ts_sec) - INTERVAL (30 * back) MINUTE AS h
          FROM a, (VALUES (0), (1)) AS s(back))"""),
    "metrics_session": f"""WITH {_A}, g AS (
      SELECT *, CASE WHEN at_us - lag(at_us) OVER w <= 600000000 THEN 0 ELSE 1 END AS opens FROM a
      WINDOW w AS (PARTITION BY service ORDER BY at_us)), s AS (
      SELECT *, sum(opens) OVER (PARTITION BY service ORDER BY at_us) AS session FROM g)
      SELECT min(at_us) AS start_us, max(at_us) + 600000000 AS end_us, service, count(*) AS n,
        count(*) FILTER (WHERE level = 'ERROR') AS n_error FROM s GROUP BY service, session""",
    "search_terms": _search(SEARCH_TERMS, "all"),
    "search_any_term": _search(ANY_TERMS, "any"),
    "search_phrase": f"SELECT doc_id FROM documents WHERE {_holds('text', SEARCH_PHRASE)}",
    "search_number": f"WITH {_A} " + _search(SEARCH_NUMBERS, "any").replace("text", "message").replace("documents", "a").replace("doc_id", "log_id"),
    "search_non_ascii": _search(tuple(t.lower() for t in SEARCH_NON_ASCII), "any"),
    "search_newest": _from_a("SELECT log_id, at_us AS epoch_us", "WHERE level = 'WARN' ORDER BY at_us DESC, log_id LIMIT 20"),
    "filter_facets": _from_a("SELECT log_id", """WHERE level IN ('WARN', 'ERROR') AND service IN ('svc-1', 'svc-3')
      AND host IN ('host-1', 'host-2', 'host-3') AND ts_sec >= TIMESTAMP '2024-01-05 00:00:00'
      AND ts_sec < TIMESTAMP '2024-01-25 12:00:00'"""),
    "filter_attribute": _from_a("SELECT log_id", "WHERE attr_k = '42'"),
    "agg_by_level": _from_a("SELECT level, count(*) AS n", "GROUP BY level"),
    "top_services": _from_a("SELECT service, count(*) AS n", "GROUP BY service ORDER BY n DESC, service LIMIT 3"),
    "date_histogram": _from_a("SELECT strftime(ts_sec, '%Y-%m-%d') AS bucket, level, count(*) AS n", "GROUP BY 1, 2"),
    "distinct_traces": _from_a("SELECT service, count(DISTINCT trace_id) AS n_distinct", "GROUP BY service"),
    "value_percentiles": _from_a("""SELECT level, round(quantile_cont(value, 0.5), 6) AS p50,
      round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99,
      round(quantile_cont(value, 0.999), 6) AS p99_9""", "GROUP BY level"),
    "percentiles_approx": _from_a("SELECT level, true AS p50, true AS p95, true AS p99_9", "GROUP BY level"),
    "level_service_cube": _from_a("""SELECT coalesce(level, '*') AS level, coalesce(service, '*') AS service,
      CAST(grouping(level, service) AS BIGINT) AS subtotal, count(*) AS n""").replace(
        "FROM a ", "FROM a GROUP BY CUBE (a.level, a.service)").replace("grouping(level, service)", "grouping(a.level, a.service)"),
    "trace_timeline": _from_a(
        "SELECT log_id, at_us - lag(at_us) OVER (PARTITION BY trace_id ORDER BY at_us, log_id) AS gap_us"),
    "context_around_error": f"""WITH {_A}, w AS (
      SELECT log_id, at_us,
        last_value(CASE WHEN level = 'ERROR' THEN at_us END IGNORE NULLS) OVER before AS b_us,
        last_value(CASE WHEN level = 'ERROR' THEN log_id END IGNORE NULLS) OVER before AS b_id,
        first_value(CASE WHEN level = 'ERROR' THEN at_us END IGNORE NULLS) OVER after AS a_us,
        first_value(CASE WHEN level = 'ERROR' THEN log_id END IGNORE NULLS) OVER after AS a_id
      FROM a WINDOW
        before AS (PARTITION BY service ORDER BY at_us, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        after AS (PARTITION BY service ORDER BY at_us, log_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
      n AS (SELECT log_id, CASE WHEN b_us IS NULL THEN false WHEN a_us IS NULL THEN true ELSE at_us - b_us <= a_us - at_us END
              AS use_b, at_us, b_us, b_id, a_us, a_id FROM w)
      SELECT CASE WHEN use_b THEN b_id ELSE a_id END AS error_id, log_id,
        at_us - CASE WHEN use_b THEN b_us ELSE a_us END AS gap_us
      FROM n WHERE abs(at_us - CASE WHEN use_b THEN b_us ELSE a_us END) <= 60000000""",
    "service_health": _from_a("""SELECT service, max(at_us) AS last_seen_us,
      round(count(*) FILTER (WHERE level = 'ERROR') / count(*)::DOUBLE, 6) AS error_share""", "GROUP BY service"),
    "silent_services": _from_a("SELECT service, trace_id, max(at_us) AS last_seen_us", """GROUP BY service, trace_id
      HAVING max(at_us) <= (SELECT max(at_us) FROM a) - 24 * 3600000000"""),
    "uppercase_stream": "SELECT event_id, upper(event_type) AS value FROM events",
    "index_roundtrip": _from_a("SELECT level, count(*) AS n", "GROUP BY level"),
    "archive_roundtrip": _from_a("SELECT strftime(ts_sec, '%Y-%m-%d') AS event_date, count(*) AS n", "GROUP BY 1"),
    "alert_windows": f"WITH {_A} SELECT window_start, service, n, n_error, error_ratio FROM (" + _METRICS.format(
        bytes="strlen(message)", source="(SELECT *, date_trunc('hour', ts_sec) AS h FROM a)")
        + ") WHERE n >= 3 AND error_ratio > 0.4",
    "unusual_counts": f"""WITH {_A}, m AS (
      SELECT date_trunc('hour', ts_sec) AS h, service, count(*) AS n FROM a GROUP BY 1, 2), s AS (
      SELECT *, count(*) OVER w AS k, sum(n) OVER w AS t, sum(n * n) OVER w AS q FROM m
      WINDOW w AS (PARTITION BY service ORDER BY h ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)), z AS (
      SELECT h, service, n, CAST(n * k - t AS DOUBLE) / sqrt(CAST(k * q - t * t AS DOUBLE)) AS z
      FROM s WHERE k = 24 AND k * q - t * t > 0)
      SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, service, n, round(z, 6) AS z FROM z WHERE abs(z) >= 3""",
    "route_by_source": _from_a(
        f"SELECT {_case('ext', TAG_BY_EXTENSION)} AS tag, log_id",
        ).replace("FROM a", f"FROM (SELECT {_pick((*EXTENSIONS, 'png'))} AS ext, log_id FROM a) WHERE ext <> 'png'"),
    "client_lines": _from_a("SELECT log_id", "WHERE user_id % 4 = 1"),
    "index_with_source": _from_a("""SELECT log_id, 'c-2' AS client_id, 'logs.app' AS tag, true AS in_own_folder""",
                                 "WHERE user_id % 4 = 2"),
    "compact_index": _from_a(f"""SELECT strftime(ts_sec, '%Y-%m-%d') AS event_date,
      CAST(ts_sec AS DATE) = (SELECT max(CAST(ts_sec AS DATE)) FROM a) AS as_streamed, count(*) AS n""", "GROUP BY ALL"),
    "archive_proof": f"""WITH {_A}, d AS (
      SELECT CAST(ts_sec AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_id % {CHANGED_EVERY} = 0) AS n_missing
      FROM a GROUP BY 1)
      SELECT strftime(day, '%Y-%m-%d') AS event_date, n, n_missing, n_missing = 0 AS expired,
        CASE WHEN n_missing = 0 THEN 0 ELSE n END AS n_left
      FROM d WHERE day < (SELECT max(day) FROM d)""",
    "archive_twice": _from_a("SELECT log_id, level"),
    "bind_by_version": _from_a("""SELECT CAST(event_id % 2 + 1 AS VARCHAR) AS v, log_id, at_us AS epoch_us, service, level,
      message, CASE WHEN event_id % 2 = 1 THEN host END AS host"""),
    "bind_registered_versions": """WITH j AS (
      SELECT event_id, event_id % 4 AS place, user_id, ts,
        CASE WHEN event_id % 4 = 3 THEN 'unknown_version' WHEN event_id % 7 = 3 THEN 'type_mismatch' END AS reason FROM events)
      SELECT CAST(event_id AS VARCHAR) AS log_id, CAST(place + 1 AS VARCHAR) AS v, reason,
        CASE WHEN reason IS NULL THEN CAST(event_id + CASE place WHEN 1 THEN 5000000000 ELSE 0 END AS BIGINT) END AS id,
        CASE WHEN reason IS NULL THEN concat('svc-', user_id % 5) END AS owner,
        CASE WHEN reason IS NULL THEN CAST(user_id + CASE place WHEN 2 THEN 0.5 ELSE 0 END AS DOUBLE) END AS n,
        CASE WHEN reason IS NULL AND place = 2 THEN strftime(ts, '%Y-%m-%d') END AS at_date
      FROM j""",
    "otel_to_events": _from_a("""SELECT log_id, host, at_us AS epoch_us, service, pod_name, trace_id, level, message,
      'k' AS attr_key, attr_k AS attr_value, CAST(1 AS BIGINT) AS n_attrs"""),
    "otel_quarantine": _from_a("""SELECT log_id,
      [NULL, 'not_json_object', 'no_export', 'type_mismatch', 'empty'][event_id % 5 + 1] AS reason,
      [concat('{"values":[{"stringValue":"', message, '"}]}'), message, concat('{"resourceSpans":[],"id":"', log_id, '"}'),
       concat('{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"severityNumber":"', level, '"}]}]}]}'), ' '][event_id % 5 + 1] AS raw"""),
    "enrich_as_of": _from_a("SELECT log_id, n_name AS owner", """LEFT JOIN nation ON service = concat('svc-', n_nationkey % 5)
      AND ts_sec >= TIMESTAMP '2024-01-01' + to_days(CAST(n_nationkey // 5 * 6 AS INT))
      AND (n_nationkey // 5 >= 4 OR ts_sec < TIMESTAMP '2024-01-01' + to_days(CAST(n_nationkey // 5 * 6 + 5 AS INT)))"""),
    "search_terms_indexed": _from_a("SELECT log_id, CAST(2 AS BIGINT) AS score", f"WHERE event_type = 'purchase' AND user_id = {INDEXED_USER}"),
    "search_phrase_indexed": _from_a("SELECT log_id", f"WHERE user_id = {INDEXED_USER}"),
    "filter_attribute_indexed": _from_a("SELECT log_id", "WHERE attr_k = '42'"),
    "lookup_trace": _from_a("SELECT log_id, at_us - lag(at_us) OVER (ORDER BY at_us, log_id) AS gap_us",
                            f"WHERE user_id = {INDEXED_USER} AND service = 'svc-2'"),
    "rollup_days": f"""WITH {_A}, h AS (SELECT strftime(ts_sec, '%Y-%m-%d') AS day, service, host, count(*) AS n FROM a GROUP BY ALL)
      SELECT strftime(ts_sec, '%Y-%m-%d') AS day, service, count(*) AS n, count(*) FILTER (WHERE level = 'ERROR') AS n_error,
        CAST(sum(strlen(message)) AS BIGINT) AS bytes, true AS traces_near, true AS p95_near,
        (SELECT max(h.n) FROM h WHERE h.day = strftime(a.ts_sec, '%Y-%m-%d') AND h.service = a.service) AS top_host_n
      FROM a GROUP BY ALL""",
    "rollup_late": f"WITH {_A} SELECT window_start, service, n, n_error, bytes FROM (" + _METRICS.format(
        bytes="strlen(message)", source="(SELECT *, date_trunc('hour', ts_sec) AS h FROM a)") + ")",
    "repeated_delivery": _from_a("SELECT log_id, level"),
    "silence_stream": """WITH a AS (SELECT concat('svc-', user_id % 5) AS service, epoch_us(ts) AS at_us FROM events), g AS (
      SELECT service, at_us, lead(at_us) OVER (PARTITION BY service ORDER BY at_us) AS next_us FROM a),
      s AS (SELECT * FROM g WHERE next_us - at_us > 3600000000
        OR next_us IS NULL AND at_us + 3600000000 + 600000000 < (SELECT max(at_us) FROM a))
      SELECT service, 'silent' AS alert, at_us + 3600000000 AS at_us FROM s
      UNION ALL SELECT service, 'back', next_us FROM s WHERE next_us IS NOT NULL""",
}
