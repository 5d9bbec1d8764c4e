"""The expected result of each registered query as ANSI SQL over the given tables.

Results are stated from the keys of the base tables, never by parsing the rendered text again.
"""

_BAD_EVENTS = "(7, 11, 13, 17, 19, 37)"

_REASON = """CASE event_id % 50 WHEN 7 THEN 'arity' WHEN 11 THEN 'arity' WHEN 13 THEN 'null'
  WHEN 17 THEN 'bad_number' WHEN 19 THEN 'bad_timestamp' ELSE 'malformed' END"""

_LOADED_EVENTS = f"""SELECT event_id, user_id,
  CASE event_id % 50 WHEN 29 THEN NULL WHEN 31 THEN 'a,"b' ELSE event_type END AS event_type,
  value, date_trunc('second', ts) AS ts
FROM events WHERE event_id % 50 NOT IN {_BAD_EVENTS}"""

_LOADED_ORDERS = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE o_orderkey % 5 WHEN 0 THEN '  ' || o_orderstatus || ' ' WHEN 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders"""

# Events are spread over files by event_id % 8 and by blocks of 8,000,000 ids.
_EVENT_FILE = "(event_id % 8) * 1000000 + event_id // 8000000"

ORACLES = {
    "load_delimited": _LOADED_EVENTS,
    "load_rejects": f"SELECT event_id, {_REASON} AS reason FROM events WHERE event_id % 50 IN {_BAD_EVENTS}",
    "load_reject_fields": f"""
SELECT event_id, CASE event_id % 50 WHEN 13 THEN 'user_id' WHEN 17 THEN 'value' WHEN 19 THEN 'ts' END AS field
FROM events WHERE event_id % 50 IN {_BAD_EVENTS}""",
    "load_reject_reasons": f"""
SELECT {_REASON} AS reason, count(*) AS n FROM events WHERE event_id % 50 IN {_BAD_EVENTS} GROUP BY 1""",
    "load_counts": f"""
SELECT event_id % 8 AS bucket, count(*) FILTER (WHERE event_id % 50 NOT IN {_BAD_EVENTS}) AS accepted,
  count(*) FILTER (WHERE event_id % 50 IN {_BAD_EVENTS}) AS rejected
FROM events GROUP BY 1""",
    "load_staged": f"""
SELECT event_id, CASE WHEN event_id % 50 IN {_BAD_EVENTS} THEN {_REASON} ELSE 'accepted' END AS outcome FROM events""",
    "load_fail_file": f"""
SELECT event_id, value FROM events
WHERE {_EVENT_FILE} NOT IN (SELECT {_EVENT_FILE} FROM events WHERE event_id % 50 = 17)""",
    "load_delimited_custom_quote": """
SELECT c_custkey, 'a|''' || c_name AS c_name, c_nationkey, c_acctbal FROM customer""",
    "load_strict_types": """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity, l_extendedprice
FROM lineitem WHERE l_suppkey % 9 NOT IN (0, 1)""",
    "load_timestamp_zone": "SELECT event_id, date_trunc('second', ts) + INTERVAL 5 HOUR AS ts FROM events",
    "load_timestamp_lenient": "SELECT event_id, date_trunc('second', ts) + INTERVAL 5 HOUR AS ts FROM events",
    "load_attributes": _LOADED_ORDERS,
    "load_attributes_lenient": """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 0 ELSE o_custkey END AS o_custkey,
  CASE o_orderkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0 WHEN 2 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders""",
    "load_attributes_failures": "SELECT o_orderkey, 'bad_timestamp' AS reason FROM orders WHERE o_orderkey % 13 = 4",
    "load_attributes_successes": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 13 <> 4",
    "upsert_update": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0""",
    "upsert_ignore": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0""",
    "upsert_composite": """
SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'edited' ELSE role END AS role FROM conversations
UNION ALL SELECT conv_id, 1000 AS turn, 'new' AS role FROM conversations WHERE turn = 0""",
    "upsert_dup_in_load": """
SELECT o_orderkey, 'update' AS mode, o_totalprice * 2 AS o_totalprice FROM orders
UNION ALL SELECT o_orderkey, 'ignore' AS mode, o_totalprice FROM orders""",
    "upsert_hot_key": """
SELECT key, l_extendedprice, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY key
    ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) AS place
  FROM (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_orderkey END AS key FROM lineitem) AS keyed) AS placed
WHERE place = 1""",
    "append_keyless": """
SELECT o_orderkey, count(*) AS n
FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders) AS twice GROUP BY 1""",
    "conform_to_table": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "conform_types": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "table_load_and_update": f"""
SELECT * FROM ({_LOADED_EVENTS}) AS loaded WHERE event_id % 2 <> 0
UNION ALL SELECT CASE WHEN event_id % 2 = 0 THEN event_id ELSE -event_id END AS event_id, user_id, 'update' AS event_type,
  value, date_trunc('second', ts) AS ts FROM events""",
    "table_insert_log": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0""",
    "upsert_touched_buckets": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 100 = 1 OR o_orderkey = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders""",
    "table_two_writers": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 10000000000 + o_orderkey, o_custkey, o_totalprice FROM orders""",
    "change_feed_commit_log": """
SELECT o_orderkey, o_totalprice, 1 AS batch FROM orders WHERE o_orderkey % 2 <> 0
UNION ALL SELECT -o_orderkey, o_totalprice + 1, 2 FROM orders WHERE o_orderkey % 3 <> 0""",
    "replicated_lookup": """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "stream_batch_cap": f"""
SELECT count(*) FILTER (WHERE event_id % 50 NOT IN {_BAD_EVENTS}) AS accepted,
  CAST(ceil(count(DISTINCT {_EVENT_FILE}) / 2.0) AS BIGINT) AS batches FROM events""",
    "stream_load_rows": _LOADED_EVENTS,
    "stream_load_attributes": _LOADED_ORDERS,
    "stream_two_sources": _LOADED_ORDERS,
    "page_records_all": "SELECT conv_id, turn, role FROM conversations",
    "page_records_numbered": """
SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 50 AS page FROM conversations""",
    "export_file_names": "SELECT '.csv' AS ending, CAST(1 AS BIGINT) AS headers, count(*) AS n, true AS capped FROM events",
    "change_feed_new_rows": "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 3 <> 0",
    "change_feed_json": """
SELECT event_id, value, CAST(event_id % 3 AS INTEGER) AS batch FROM events WHERE event_id % 3 <> 0""",
    "export_delimited": """
SELECT event_id, CASE event_id % 40 WHEN 1 THEN chr(9) || '"x' || chr(10) || 'y' WHEN 2 THEN NULL ELSE event_type END AS event_type,
  value FROM events""",
    "export_typed_header": """
SELECT pos, cell, n FROM (VALUES (0, 'event_id|long|primary_key'), (1, 'user_id|long'), (2, 'event_type|string|nullable'),
  (3, 'value|double'), (4, 'ts|long|timestamp')) AS t(pos, cell)
JOIN (SELECT 0 AS p, count(event_id) AS n FROM events UNION ALL SELECT 1, count(user_id) FROM events
  UNION ALL SELECT 2, count(event_type) FROM events WHERE event_id % 40 <> 2
  UNION ALL SELECT 3, count(value) FROM events UNION ALL SELECT 4, count(ts) FROM events) AS counted ON pos = p""",
    "export_round_trip": "SELECT event_id, user_id, event_type, value, date_trunc('millisecond', ts) AS ts FROM events",
    "export_json": """
SELECT event_id, CASE WHEN event_id % 40 = 2 THEN NULL ELSE event_type END AS event_type, value, TRUE AS has_type_key
FROM events""",
    "export_rejects": f"""
SELECT event_id, CASE event_id % 50 WHEN 7 THEN 3 WHEN 11 THEN 5 ELSE 4 END AS delimiters
FROM events WHERE event_id % 50 IN {_BAD_EVENTS}""",
    "load_blank_lines": """
WITH outcomes AS (
  SELECT 'accepted' AS outcome, count(*) AS n FROM orders
  UNION ALL SELECT 'malformed', count(*) FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 'arity', count(*) FROM orders WHERE o_orderkey % 5 = 1)
SELECT has_header, outcome, n FROM outcomes, (VALUES (true), (false)) AS h(has_header) WHERE n > 0""",
    "load_failed_files": "SELECT event_id % 8 AS bucket, count(*) AS rejected FROM events WHERE event_id % 50 = 17 GROUP BY 1",
    "load_timestamp_two_digit_year": "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders",
    "load_timestamp_hour_twelve": """
SELECT event_id, date_trunc('second', ts) - CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS ts
FROM events""",
    "stream_load_rejects": f"SELECT event_id FROM events WHERE event_id % 50 IN {_BAD_EVENTS}",
    "stream_attribute_failures": "SELECT o_orderkey FROM orders WHERE o_orderkey % 13 = 4",
    "table_retry_after_other_load": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 10000000000 + o_orderkey, o_custkey, o_totalprice FROM orders""",
    "collection_tables": "SELECT n_nationkey, n_name FROM nation",
    "feed_read_counts": "SELECT event_id % 3 AS part, count(*) AS n FROM events GROUP BY 1",
    "change_feed_after_failed_load": "SELECT event_id, user_id, event_type, value FROM events",
    "export_raw_cells": """
SELECT event_id || ',' || CASE event_id % 40 WHEN 1 THEN '"a' || chr(10) || 'b"' WHEN 2 THEN '"c' || chr(13) || 'd"'
  WHEN 3 THEN '"e""f"' WHEN 4 THEN '' ELSE event_type END AS record FROM events""",
    "groupby_having": "SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 70",
    "stat_percentile": "SELECT event_type, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1",
    "filter_in_list": "SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')",
    "filter_not_in_list": "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')",
    "filter_in_list_table": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "filter_not_in_list_table": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "page_records": """
SELECT event_id, user_id, (SELECT count(*) FROM events WHERE event_id > 499) > 100 AS has_more
FROM events WHERE event_id > 499 ORDER BY event_id LIMIT 100""",
}
