"""The result each query must have, stated directly over the tables."""

_LATE = """event_id >= (SELECT coalesce(max(b.event_id) + 1, 0) FROM events b
    WHERE b.ts < TIMESTAMP '2024-01-15 00:00:00' AND b.user_id % 4 = e.user_id % 4)"""

_PURCHASES = """SELECT event_id AS id, event_type AS name, user_id AS user
    FROM events WHERE event_type = 'purchase'"""

# The hash of a key of up to eleven digits, word by word: M multiplies, F folds.
_M = "((({0}) * 1540483477) & 4294967295)"
_F = "xor({0}, ({0}) >> {1})"
_WORD = "(ord(substr(k, {0}, 1)) + 256 * ord(substr(k, {1}, 1)) + 65536 * ord(substr(k, {2}, 1)) + 16777216 * ord(substr(k, {3}, 1)))"


def _mixed(state: str, start: int) -> str:
    word = _M.format(_WORD.format(*range(start, start + 4)))
    return f"xor({_M.format(state)}, {_M.format(_F.format(word, 24))})"


_REST = "(" + " + ".join(f"CASE WHEN n % 4 > {i} THEN {256**i} * ord(substr(k, n // 4 * 4 + {i + 1}, 1)) ELSE 0 END" for i in range(3)) + ")"
_MURMUR2 = f"""WITH
    a AS (SELECT event_id, cast(user_id AS varchar) AS k, cast(length(cast(user_id AS varchar)) AS bigint) AS n FROM events),
    b AS (SELECT *, xor(2538058380, n) AS h FROM a),
    c AS (SELECT event_id, k, n, CASE WHEN n >= 4 THEN {_mixed('h', 1)} ELSE h END AS h FROM b),
    d AS (SELECT event_id, k, n, CASE WHEN n >= 8 THEN {_mixed('h', 5)} ELSE h END AS h FROM c),
    e AS (SELECT event_id, CASE WHEN n % 4 > 0 THEN {_M.format(f"xor(h, {_REST})")} ELSE h END AS h FROM d),
    f AS (SELECT event_id, {_M.format(_F.format('h', 13))} AS h FROM e)
    SELECT event_id, cast(({_F.format('h', 15)} & 2147483647) % 4 AS integer) AS "partition" FROM f"""

ORACLES = {
    "topic_scan": """SELECT cast(user_id AS varchar) AS key, props AS value,
        'event_props' AS topic, cast(user_id % 4 AS integer) AS "partition", event_id AS "offset",
        epoch_us(ts) AS timestamp_us FROM events""",
    "delimited_source": _PURCHASES,
    "avro_source": """SELECT l_orderkey AS "order", CASE WHEN l_linestatus = 'F' THEN l_returnflag || '/' || l_linestatus END AS remark,
        CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS quantity, l_linestatus AS status,
        cast(round(l_extendedprice * 100) AS integer) AS price,
        cast(epoch(date_trunc('day', l_shipdate)) / 86400 AS integer) + 1 AS second_day,
        l_partkey AS part FROM lineitem""",
    "json_source": """SELECT event_id AS "offset",
        cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS integer) AS k FROM events""",
    "json_map_filter": """SELECT c_name AS holder FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "json_schema_source": """SELECT cast(c_custkey AS varchar) AS account, c_name AS holder,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance FROM customer""",
    "start_earliest": """SELECT cast(user_id % 4 AS integer) AS "partition", event_id AS "offset"
        FROM events""",
    "start_latest": f"""SELECT cast(user_id % 4 AS integer) AS "partition", event_id AS "offset"
        FROM events e WHERE {_LATE}""",
    "start_specific_offsets": """SELECT cast(user_id % 4 AS integer) AS "partition",
        event_id AS "offset" FROM events
        WHERE event_id >= CASE user_id % 4 WHEN 0 THEN 23 WHEN 1 THEN 500 ELSE 0 END""",
    "start_latest_stream": f"""SELECT cast(user_id % 4 AS integer) AS "partition", event_id AS "offset"
        FROM events e WHERE {_LATE}""",
    "start_group_offsets": f"""SELECT cast(user_id % 4 AS integer) AS "partition",
        event_id AS "offset" FROM events e WHERE {_LATE}""",
    "delimited_ragged": """SELECT o_orderkey AS id, o_orderpriority AS priority,
        CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS customer,
        CASE WHEN o_orderstatus = 'F' THEN 'F' END AS status FROM orders""",
    "delimited_map": """SELECT l_orderkey AS id, l_returnflag AS flag, l_linestatus AS status,
        '' AS mark, '' AS blank, cast(NULL AS varchar) AS missing, cast(4 AS integer) AS entries
        FROM lineitem""",
    "delimited_types": """SELECT o_orderkey AS id, cast(o_custkey AS integer) AS customer,
        o_totalprice AS price, o_orderkey AS big,
        cast(epoch(date_trunc('day', o_orderdate)) / 86400 AS integer) AS day,
        strftime(o_orderdate, '%H:%M:%S') AS clock, epoch_us(o_orderdate) AS moment_us,
        o_orderstatus = 'F' AS filled, o_totalprice AS price_double FROM orders""",
    "delimited_custom_delims": """SELECT p_partkey AS id, p_name AS name, p_brand AS brand,
        p_type AS type, p_size AS size FROM part""",
    "delimited_permissive": """SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey END AS id,
        CASE WHEN l_returnflag = 'R' THEN cast(l_quantity AS integer) END AS amount
        FROM lineitem""",
    "avro_permissive": """SELECT c_custkey AS "offset",
        CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS key,
        CASE WHEN c_custkey % 3 <> 0 AND c_acctbal >= 0 THEN c_name END AS name
        FROM customer""",
    "json_permissive": """SELECT c_custkey AS "offset",
        CASE WHEN c_custkey % 3 <> 0 THEN cast(c_custkey AS varchar) END AS account,
        CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS holder FROM customer""",
    "map_lookup_filter": """SELECT l_orderkey AS "order", CASE WHEN l_linestatus = 'F' THEN l_returnflag || '/' || l_linestatus END AS remark,
        l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'R'""",
    "array_element": """SELECT vec_id AS id, cast(embedding[1] AS double) AS first,
        cast(embedding[3] AS double) AS third, cast(NULL AS double) AS past_the_end, label
        FROM embeddings""",
    "struct_field": """SELECT c_custkey AS key,
        CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS label,
        CASE WHEN c_mktsegment <> 'HOUSEHOLD' AND c_acctbal >= 0 THEN c_nationkey END AS nation
        FROM customer""",
    "map_struct_field": """SELECT l_orderkey AS "order", l_partkey AS part
        FROM lineitem WHERE l_linenumber = 3""",
    "array_struct_field": """SELECT l_orderkey AS "order", l_returnflag AS flag
        FROM lineitem WHERE l_linestatus = 'F'""",
    "nested_conjunction": """SELECT l_orderkey AS "order", l_quantity AS quantity,
        'A/F' AS remark FROM lineitem
        WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber BETWEEN 2 AND 4""",
    "nullable_fields": """SELECT c_custkey AS key,
        CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS nation,
        CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS balance,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS tag,
        CASE WHEN c_mktsegment <> 'FURNITURE' AND c_acctbal >= 0 THEN c_nationkey END
            AS first_code,
        CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_nationkey END AS second_code,
        CASE WHEN c_mktsegment <> 'FURNITURE' THEN cast(2 AS integer) END AS codes,
        c_mktsegment = 'HOUSEHOLD' AS no_segment FROM customer""",
    "project_columns": "SELECT event_id AS id, event_type AS name FROM events",
    "select_star": """SELECT cast(c_custkey AS varchar) AS account, c_name AS holder FROM customer""",
    "field_mapping": """SELECT c_custkey AS customer,
        CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS account,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS country FROM customer""",
    "schema_narrowing": """SELECT l_orderkey AS "order", CASE WHEN l_linestatus = 'F' THEN l_returnflag || '/' || l_linestatus END AS remark,
        CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS quantity FROM lineitem""",
    "catalog_query": """SELECT c_name AS holder FROM customer
        WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal > 30""",
    "avro_roundtrip": """SELECT c_custkey AS number, c_name AS kind, c_nationkey AS visitor
        FROM customer""",
    "avro_documents": "SELECT doc_id AS id, text, lang FROM documents",
    "json_roundtrip": "SELECT doc_id, text, lang, n_chars FROM documents",
    "filter_gt_le_route": """SELECT 'above' AS topic, c_name AS holder FROM customer
            WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal > 30
        UNION ALL SELECT 'up_to', c_name FROM customer
            WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal <= 30
        UNION ALL SELECT 'all', c_name FROM customer""",
    "insert_into_sink": """SELECT c_name AS holder FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "fanout_multi_sink": """SELECT event_id AS id, event_type AS name, 'actions' AS sink FROM events
        UNION ALL SELECT event_id, event_type, 'purchases' FROM events
            WHERE event_type = 'purchase'""",
    "fixed_partitioning": """SELECT event_id, event_type, true AS writer_keeps_to_it
        FROM events""",
    "custom_partitioning": """SELECT cast(user_id % 4 AS integer) AS "partition", event_id
        FROM events""",
    "stream_equals_batch": _PURCHASES,
    "stream_to_avro_topic": """SELECT event_id AS number, event_type AS kind,
        cast(user_id AS integer) AS visitor FROM events""",
    "proctime_column": """SELECT event_id AS id, event_type AS name, true AS after_sending,
        true AS now FROM events""",
    "rowtime_watermark": "SELECT event_id AS id, epoch_us(ts) AS moment_us FROM events",
    "rowtime_from_envelope": """SELECT epoch_us(ts) AS sent_us,
        cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS integer) AS k FROM events""",
    "catalog_table": """SELECT cast(c_custkey AS varchar) AS account, c_name AS holder
        FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal <= 30""",
    "route_avro_required": """SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unknown' ELSE 'known' END AS topic,
            c_name AS holder, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance
            FROM customer
        UNION ALL SELECT 'every', c_name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END
            FROM customer""",
    "print_rows": """SELECT cast(c_custkey AS varchar) AS account, c_name AS holder FROM customer""",
    "fanout_two_queries": """SELECT event_id AS id, event_type AS name FROM events
        WHERE event_type IN ('purchase', 'view')""",
    "delimited_select_star": """SELECT event_id AS id, event_type AS name, user_id AS "user",
        'eventType=purchase;userId=' || user_id AS event FROM events WHERE event_type = 'purchase'""",
    "json_variant_paths": """SELECT l_orderkey AS "order", l_returnflag AS flag,
        cast(epoch(date_trunc('day', l_shipdate)) / 86400 AS integer) + 1 AS second_day, l_partkey AS part,
        cast(NULL AS bigint) AS missing FROM lineitem WHERE l_returnflag = 'R'""",
    "json_variant_schema": """SELECT event_id AS "offset",
        cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS integer) AS k FROM events""",
    "json_schema_constraints": """SELECT c_custkey AS "offset", reason, CASE WHEN reason IS NULL THEN c_name END AS holder
        FROM (SELECT *, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'balance: required'
            WHEN c_custkey > 999 THEN 'account: maxLength' WHEN c_acctbal < 0 THEN 'balance: minimum'
            WHEN c_acctbal >= 9000 THEN 'balance: exclusiveMaximum'
            WHEN c_nationkey >= 20 THEN 'attributes.country: not'
            WHEN c_mktsegment = 'FURNITURE' THEN 'attributes.segment: enum' END AS reason FROM customer)""",
    "rejected_messages": """SELECT c_custkey AS "offset", reason,
        CASE WHEN reason IS NULL THEN cast(c_custkey AS varchar) END AS account, CASE WHEN reason IS NULL THEN c_name END AS holder,
        CASE WHEN reason IS NULL AND c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance
        FROM (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN 'no bytes' WHEN c_custkey % 3 = 0 THEN 'no JSON object'
            WHEN c_custkey % 7 = 0 THEN 'field balance: not a decimal(38,18)' END AS reason FROM customer)""",
    "rejected_stream": """SELECT event_id AS id, CASE WHEN event_id % 4 <> 0 THEN cast(user_id AS integer) END AS "user",
        CASE WHEN event_id % 4 = 0 THEN 'column user: not a int: nobody' END AS reason FROM events""",
    "fanout_exactly_once": """SELECT 'sent' AS topic, event_id AS id, event_type AS name, cast(NULL AS bigint) AS "user" FROM events
        UNION ALL SELECT 'purchases', event_id, NULL, user_id FROM events WHERE event_type = 'purchase'""",
    "stream_without_repeats": """SELECT cast(user_id % 4 AS integer) AS "partition", event_id AS "offset",
        epoch_us(ts) AS timestamp_us FROM events""",
    "group_offsets_observed": f"""SELECT cast(user_id % 4 AS integer) AS "partition",
        event_id AS "offset" FROM events e WHERE {_LATE}""",
    "start_by_index": """SELECT cast(user_id % 4 AS integer) AS "partition",
        event_id AS "offset" FROM events
        WHERE event_id >= CASE user_id % 4 WHEN 0 THEN 23 WHEN 1 THEN 500 ELSE 0 END""",
    "catalog_function": """SELECT event_id AS "offset", cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS integer) AS k
        FROM events WHERE event_id >= 500 AND user_id % 4 = 2
        AND cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS integer) > 30""",
    "schema_evolution": """SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 10000000000 END AS key, c_name AS name,
        cast(c_nationkey AS bigint) AS nation, CASE WHEN c_custkey % 2 = 0 THEN 'unknown' ELSE c_mktsegment END AS segment,
        CASE WHEN c_custkey % 2 = 0 THEN cast(c_nationkey AS double) ELSE c_acctbal END AS score FROM customer""",
    "keyed_partitioning": _MURMUR2,
}
