"""The same results in SQL, for comparison with another engine."""

from __future__ import annotations

_HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
_START_5MIN = "epoch_ms(time_bucket(INTERVAL '5 minutes', ts))"
_START_DAY = "epoch_ms(time_bucket(INTERVAL '1 day', ts))"
_AFFILIATES = f"""
    SELECT min(page_id) AS id, {_HOST} AS source_domain, round(count(*)::DOUBLE / 100, 2) AS compensation
    FROM pages GROUP BY {_HOST}"""
_COMPOSED = f"""
    SELECT page_id, to_json({{'source_domain': a.source_domain, 'id': a.id::DOUBLE,
        'timestamp': 9223371950454775, 'url': url}})::VARCHAR AS value
    FROM pages p JOIN ({_AFFILIATES}) a ON {_HOST} = a.source_domain"""
_COMPOSED_FIELDS = f"""
    SELECT a.source_domain, a.id::DOUBLE AS id, 9223371950454775 AS "timestamp", url
    FROM pages p JOIN ({_AFFILIATES}) a ON {_HOST} = a.source_domain"""
_COMPOSED_WINDOW = f"""
    SELECT event_id, to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_mktsegment := c_mktsegment,
        "timestamp" := {_START_5MIN} + 299999, event_id := event_id, event_type := event_type))::VARCHAR AS value
    FROM {{source}} JOIN customer ON user_id = c_custkey"""
_HOST_RULE = f"CASE WHEN regexp_matches(url, '^(http|https|ftp)://') THEN {_HOST} END"
_MIXED = """
    SELECT 'page' AS kind, page_id AS id, url FROM pages
    UNION ALL SELECT 'document', doc_id, text FROM documents"""
_LATEST = """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id DESC) = 1"""

_LOOKUP_INNER = """
    SELECT event_id, user_id, s_suppkey, s_name FROM events JOIN supplier ON user_id = s_suppkey"""
_LOOKUP_MANY = """
    SELECT event_id, user_id, o_orderkey, o_totalprice FROM events JOIN orders ON user_id = o_custkey"""
_LOOKUP_ONE = """
    SELECT event_id, user_id, c_custkey, c_name, c_mktsegment FROM events JOIN customer ON user_id = c_custkey"""
_LOOKUP_URL = f"""
    SELECT page_id, to_json({{'id': a.id, 'source_domain': a.source_domain,
        'compensation': a.compensation}})::VARCHAR AS value
    FROM pages p JOIN ({_AFFILIATES} HAVING count(*) >= 2) a ON {_HOST} = a.source_domain"""
_ENRICH_WINDOW = f"""
    SELECT event_id, event_type, c_custkey, c_name, c_mktsegment, {_START_5MIN} + 299999 AS "timestamp"
    FROM events JOIN customer ON user_id = c_custkey"""
_WINDOW_GROUP = f"""
    SELECT {_START_5MIN} AS window_start, user_id, count(*) AS n_events,
        sum(round(value * 100)::BIGINT)::BIGINT AS cents
    FROM events GROUP BY 1, 2"""
_WINDOW_RESULTS = """
    SELECT event_type, count(*) AS n_events FROM events
    WHERE time_bucket(INTERVAL '1 day', ts) = TIMESTAMP '2024-01-15' GROUP BY 1"""
_LATEST_IN_WINDOW = f"""
    SELECT {_START_DAY} AS window_start, user_id, event_id, event_type
    FROM ({_LATEST.format(keys="user_id, time_bucket(INTERVAL '1 day', ts)")})"""
_EVENT_MILLIS = "SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events"
_LABEL = "SELECT event_id, upper(event_type) || '!' AS label FROM events"

ORACLE_SQL = {
    "host_extract": f"SELECT page_id, url, {_HOST} AS host FROM pages",
    "host_strict": f"SELECT page_id, url, {_HOST} AS host FROM pages",
    "host_or_null": f"SELECT kind, id, {_HOST_RULE} AS host FROM ({_MIXED})",
    "dead_letters": f"SELECT kind, id, md5(url) AS digest FROM ({_MIXED}) WHERE {_HOST_RULE} IS NULL",
    "lookup_inner": _LOOKUP_INNER,
    "lookup_inner_merge": _LOOKUP_INNER,
    "distinct_key_lookup": _LOOKUP_INNER,
    "table_round_trip": _LOOKUP_INNER,
    "stream_lookup_inner": _LOOKUP_INNER,
    "lookup_many": _LOOKUP_MANY,
    "lookup_many_merge": _LOOKUP_MANY,
    "stream_lookup_many": _LOOKUP_MANY,
    "lookup_exactly_one": _LOOKUP_ONE,
    "lookup_exactly_one_merge": _LOOKUP_ONE,
    "lookup_collect": """
        SELECT event_id, user_id, o_orderkey AS order_key FROM events LEFT JOIN orders ON user_id = o_custkey""",
    "lookup_match_counts": """
        SELECT event_id, count(o_orderkey) AS n_matches
        FROM events LEFT JOIN orders ON user_id = o_custkey GROUP BY event_id""",
    "lookup_collect_chunked": """
        WITH chunks AS (
            SELECT (max(n) + 4) // 5 AS c FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey))
        SELECT event_id, (o_orderkey % c)::INT AS chunk,
            count(*) OVER (PARTITION BY event_id, o_orderkey % c) AS n_matches, o_orderkey
        FROM events JOIN orders ON user_id = o_custkey, chunks""",
    "lookup_collect_bounded": """
        SELECT event_id, o_orderkey AS order_key, true AS bounded
        FROM events LEFT JOIN orders ON user_id = o_custkey""",
    "distinct_key_lookup_bloom": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
    "fetch_lookup": _LOOKUP_ONE,
    "replaced_table": """
        SELECT version, event_id, CASE version WHEN 0 THEN s_name ELSE upper(s_name) END AS s_name
        FROM events JOIN supplier ON user_id = s_suppkey, (VALUES (0), (1)) v(version)
        WHERE version = 0 OR s_suppkey % 2 = 0""",
    "distinct_key_lookup_many": """
        SELECT o_orderkey, c_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
    "lookup_hooks": """
        SELECT event_id, upper(s_name) AS supplier, s_suppkey + 1 AS next_key
        FROM events JOIN supplier ON s_name = printf('Supplier#%09d', user_id)""",
    "lookup_parameter": """
        SELECT event_id, s_name, (
            SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE supplier)) AS columns
        FROM events JOIN supplier ON user_id = s_suppkey""",
    "parameter_filter": "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "memory_table": """
        SELECT event_id, event_type AS kind,
            CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 50 END::BIGINT AS weight
        FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
    "lookup_url": _LOOKUP_URL,
    "stream_lookup_url": _LOOKUP_URL,
    "compose_url": _COMPOSED,
    "natural_key_url": _COMPOSED,
    "stream_natural_key": _COMPOSED,
    "compose_window": _COMPOSED_WINDOW.format(source="events"),
    "stream_compose_window": _COMPOSED_WINDOW.format(source="events"),
    "stream_compose_on_close": _COMPOSED_WINDOW.format(source="events"),
    "natural_key_latest": _COMPOSED_WINDOW.format(source=f"({_LATEST.format(keys='user_id')})"),
    "enrich_window": _ENRICH_WINDOW,
    "stream_enrich_window": _ENRICH_WINDOW,
    "enrich_global": """
        SELECT event_id, c_custkey, c_name, c_mktsegment, 9223371950454775 AS "timestamp"
        FROM events JOIN customer ON user_id = c_custkey""",
    "row_as_map": """
        SELECT c_custkey, 'c_custkey=' || c_custkey || ';c_mktsegment=' || c_mktsegment
            || ';c_name=' || c_name || ';c_nationkey=' || c_nationkey AS fields
        FROM customer""",
    "row_as_json": """
        SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
            'c_mktsegment': c_mktsegment})::VARCHAR AS value
        FROM customer""",
    "merged_json": """
        SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_nationkey': c_nationkey, 'c_name': upper(c_name),
            'segment': c_mktsegment})::VARCHAR AS value
        FROM customer""",
    "merged_map": """
        SELECT event_id, len(json_keys(props))::BIGINT + 1 AS n_fields, 'replaced' AS k, user_id::VARCHAR AS "user"
        FROM events""",
    "json_parse": """
        SELECT event_id, (props->>'k')::BIGINT AS typed, props->>'k' AS text, (props->>'k')::DOUBLE AS widened,
            json_extract(props, '$.k')::BIGINT AS variant
        FROM events""",
    "typed_access": """
        SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS number,
            o_orderstatus AS status
        FROM orders""",
    "random_key": "SELECT count(*) AS n_keys, count(*) AS n_events, count(*) AS n_well_formed FROM events",
    "event_time_millis": _EVENT_MILLIS,
    "stream_event_millis": _EVENT_MILLIS,
    "window_assign": f"""
        SELECT event_id, {_START_5MIN} AS window_start, {_START_5MIN} + 300000 AS window_end,
            {_START_5MIN} + 299999 AS "timestamp"
        FROM events""",
    "window_address": """
        SELECT event_id, user_id FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
    "stream_window_results": _WINDOW_RESULTS,
    "window_results": _WINDOW_RESULTS,
    "window_group": _WINDOW_GROUP,
    "stream_window_group": _WINDOW_GROUP,
    "window_values": f"SELECT {_START_DAY} AS window_start, user_id, event_id FROM events",
    "stream_window_values": f"SELECT {_START_DAY} AS window_start, user_id, event_id FROM events",
    "group_by_key": "SELECT user_id, event_id FROM events",
    "group_by_key_counts": "SELECT user_id, count(*) AS n_values FROM events GROUP BY user_id",
    "group_by_key_chunked": """
        WITH chunks AS (
            SELECT (max(n) + 39) // 40 AS c FROM (SELECT count(*) AS n FROM events GROUP BY user_id))
        SELECT user_id, (event_id % c)::INT AS chunk, count(*) AS n_values,
            string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS event_ids
        FROM events, chunks GROUP BY 1, 2""",
    "group_by_key_bounded": "SELECT event_type, event_id, true AS bounded FROM events",
    "key_batches_of_type": """
        SELECT event_type, batch, least(500, n - 500 * batch) AS n_events, least(500, n - 500 * batch) AS n_ids
        FROM (SELECT event_type, n, unnest(range((n + 499) // 500)) AS batch
              FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type))""",
    "key_batches_of_user": "SELECT user_id, event_id, true AS bounded FROM events",
    "cogroup_lists_bounded": """
        SELECT user_id AS key, 'event' AS side, event_id AS id, true AS bounded FROM events
        UNION ALL SELECT o_custkey, 'order', o_orderkey, true FROM orders""",
    "cogroup_lists": """
        SELECT user_id AS key, 'event' AS side, event_id AS id FROM events
        UNION ALL SELECT o_custkey, 'order', o_orderkey FROM orders""",
    "cogroup_counts": """
        SELECT key, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right,
            coalesce(left_cents, 0) AS left_cents, coalesce(right_cents, 0) AS right_cents
        FROM (SELECT user_id AS key, count(*) AS n_left, sum(round(value * 100)::BIGINT)::BIGINT AS left_cents
              FROM events GROUP BY 1)
        FULL JOIN (SELECT o_custkey AS key, count(*) AS n_right,
                  sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS right_cents
              FROM orders GROUP BY 1) USING (key)""",
    "stream_cogroup": f"""
        SELECT {_START_DAY} AS window_start, user_id,
            CASE event_type WHEN 'purchase' THEN 'purchase' ELSE 'other' END AS side, event_id
        FROM events""",
    "stream_late_rows": f"""
        WITH n AS (SELECT count(*) AS n FROM events),
        mark AS (
            SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM events, n
            WHERE event_id % 50 <> 7 AND event_id * 4 < 3 * n)
        SELECT {_START_5MIN} AS window_start, count(*) AS n_events FROM events, mark
        WHERE event_id % 50 <> 7 OR time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' > mark
        GROUP BY 1""",
    "stream_late_side": """
        WITH mark AS (SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM events WHERE event_id % 50 <> 7)
        SELECT event_id, event_id % 50 = 7 AND time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= mark AS late
        FROM events, mark""",
    "stream_correlated": f"""
        SELECT event_id, event_type, round(value * 100)::BIGINT AS cents, {_START_5MIN} AS window_start FROM events""",
    "stream_latest": f"""
        SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS millis
        FROM ({_LATEST.format(keys="user_id")})""",
    "latest_event": f"""
        SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS millis
        FROM ({_LATEST.format(keys="user_id")})""",
    "latest_event_in_window": _LATEST_IN_WINDOW,
    "stream_latest_in_window": _LATEST_IN_WINDOW,
    "element_map": _LABEL,
    "element_map_pandas": _LABEL,
    "element_flat_map": """
        SELECT doc_id, md5(line) AS digest, length(line) AS n_chars
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)""",
    "batch_flat_map": """
        SELECT event_id, event_type, output
        FROM (SELECT event_id, event_type,
                  unnest(range(CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN 2 ELSE 1 END)) AS output
              FROM events)""",
    "message_round_trip": _COMPOSED_FIELDS,
    "stream_message_round_trip": _COMPOSED_FIELDS,
}
