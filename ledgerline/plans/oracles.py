"""For each registered query, the SQL that must give the same rows."""

_EVENTS = """
events_in AS (
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
           user_id, event_type, value, props
    FROM events
)"""

_RAW = (
    _EVENTS
    + """,
raw AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
                WHEN event_id % 103 = 0 THEN NULL
                ELSE event_time END AS event_time,
           CASE WHEN event_id % 83 = 0 THEN '3.7'
                WHEN event_id % 73 = 0 THEN NULL
                ELSE CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN event_id % 79 = 0 THEN 'NaN' ELSE event_type END AS event_type,
           CASE WHEN event_id % 97 = 0 THEN 'abc'
                WHEN event_id % 89 = 0 THEN 'NaN'
                ELSE CAST(value AS VARCHAR) END AS value,
           props
    FROM events_in
),
checked AS (
    SELECT *, concat_ws(',',
        CASE WHEN event_id IS NULL OR try_cast(event_id AS BIGINT) IS NULL
             THEN 'event_id not valid' END,
        CASE WHEN event_time IS NULL OR try_cast(event_time AS TIMESTAMP) IS NULL
             THEN 'event_time not valid' END,
        CASE WHEN user_id IS NOT NULL AND trunc(try_cast(user_id AS DOUBLE)) IS NULL
             THEN 'user_id not valid' END,
        CASE WHEN lower(event_type) = 'nan' THEN 'event_type not valid' END,
        CASE WHEN value IS NOT NULL
                  AND (try_cast(value AS DOUBLE) IS NULL OR isnan(try_cast(value AS DOUBLE)))
             THEN 'value not valid' END,
        CASE WHEN lower(props) = 'nan' THEN 'props not valid' END
    ) AS "dataTypeValidationErrors"
    FROM raw
)"""
)

_CAST_COLUMNS = """
    CAST(event_id AS BIGINT) AS event_id, event_time,
    CAST(CAST(trunc(CAST(user_id AS DOUBLE)) AS BIGINT) AS VARCHAR) AS user_id, event_type,
    CAST(value AS DOUBLE) AS value, props"""

_HOUR_COLUMNS = """
    strftime(CAST(event_time AS TIMESTAMP), '%Y') AS year,
    strftime(CAST(event_time AS TIMESTAMP), '%m') AS month,
    strftime(CAST(event_time AS TIMESTAMP), '%d') AS day,
    strftime(CAST(event_time AS TIMESTAMP), '%H') AS hour"""

_ORDERS = """
orders_in AS (
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
           o_custkey, o_orderstatus, o_totalprice
    FROM orders
)"""

_LATEST = """
users_in AS (
    SELECT user_id, CAST(floor(epoch(ts)) AS DOUBLE) AS event_time, event_id, event_type, value
    FROM events
),
latest AS (
    SELECT user_id, event_time, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rn
        FROM users_in)
    WHERE rn = 1
)"""

_PARTS = """
parts_in AS (
    SELECT l_partkey, CAST(epoch(l_shipdate) AS DOUBLE) AS event_time,
           l_orderkey * 100 + l_linenumber AS line, l_quantity, l_extendedprice, l_returnflag
    FROM lineitem
)"""

_HISTORY = f"WITH {_EVENTS} SELECT *, {_HOUR_COLUMNS} FROM events_in"
_BY_DATE = f"WITH {_EVENTS} SELECT *, left(event_time, 10) AS event_time_trunc FROM events_in"
_OUTCOMES = """
    SELECT *, CASE WHEN event_id % 100 = 0
                   THEN 'refused ' || CAST(event_id AS VARCHAR) END AS online_ingestion_error
    FROM events_in"""

_FAILED = f"""
    WITH {_EVENTS} SELECT * FROM ({_OUTCOMES}) WHERE online_ingestion_error IS NOT NULL"""
_VALID_HISTORY = f"""
    WITH {_RAW},
    cast_rows AS (
        SELECT {_CAST_COLUMNS} FROM checked WHERE "dataTypeValidationErrors" = '')
    SELECT *, {_HOUR_COLUMNS} FROM cast_rows"""

ORACLES = {
    "feature_definitions": """
        SELECT CAST(position AS INTEGER) AS position, feature_name, feature_type, n_values
        FROM (
            SELECT 0 AS position, 'p_partkey' AS feature_name, 'Integral' AS feature_type,
                   count(p_partkey) AS n_values FROM part
            UNION ALL SELECT 1, 'p_name', 'String', count(p_name) FROM part
            UNION ALL SELECT 2, 'p_brand', 'String', count(p_brand) FROM part
            UNION ALL SELECT 3, 'p_type', 'String', count(p_type) FROM part
            UNION ALL SELECT 4, 'p_size', 'Integral', count(p_size) FROM part
            UNION ALL SELECT 5, 'p_retailprice', 'Fractional', count(p_retailprice) FROM part)
    """,
    "schema_name_report": """
        SELECT event_id, 'value;' AS name, 'invalid character' AS rule
        FROM events WHERE event_id % 11 = 0
        UNION ALL
        SELECT event_id, 'hour', 'reserved' FROM events WHERE event_id % 13 = 0
        UNION ALL
        SELECT event_id, 'k' || json_extract_string(props, '$.k'), 'unknown'
        FROM events WHERE event_id % 17 = 0 AND json_extract_string(props, '$.k') IS NOT NULL
        UNION ALL
        SELECT event_id, 'Event_Type', 'unknown' FROM events WHERE event_id % 19 = 0
        UNION ALL
        SELECT event_id, 'event_type', 'repeated' FROM events WHERE event_id % 19 = 0
        UNION ALL
        SELECT event_id, 'event_time', 'missing' FROM events WHERE event_id % 7 = 0
    """,
    "group_catalog": """
        SELECT * FROM (
            SELECT 'group-' || c_custkey AS name,
                   concat_ws(',',
                       CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 5 <> 0
                            THEN 'OnlineStore' END,
                       CASE WHEN c_custkey % 4 <> 0 THEN 'OfflineStore' END) AS target_stores,
                   c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AS online_enabled,
                   c_custkey % 4 <> 0 AS offline_enabled,
                   c_custkey % 4 = 1 AS is_hour_table,
                   c_custkey % 4 = 2 AS is_v2_table
            FROM customer
            WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0)
        WHERE target_stores <> ''
    """,
    "resource_id_parse": r"""
        WITH ids AS (
            SELECT c_custkey,
                CASE WHEN c_custkey % 13 = 0 THEN 'group-' || c_custkey
                     WHEN c_custkey % 17 = 0
                     THEN 'arn:cloud:features:region-1:' || c_custkey
                          || ':feature-group/short-account'
                     WHEN c_custkey % 19 = 0
                     THEN 'arn:cloud:features:region-1:'
                          || lpad(CAST(c_custkey AS VARCHAR), 12, '0') || ':feature-group/'
                     WHEN c_custkey % 23 = 0
                     THEN 'arn:cloud:features:region-1:'
                          || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
                          || ':feature-group/outer/inner'
                     ELSE 'arn:cloud' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '-cn' END
                          || ':features:region-' || c_nationkey || ':'
                          || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
                          || ':feature-group/' || c_name END AS resource_id
            FROM customer),
        matched AS (
            SELECT *, regexp_full_match(resource_id,
                'arn:cloud[a-z-]*:features:[a-z0-9-]*:[0-9]{12}:feature-group/.*') AS is_valid
            FROM ids)
        SELECT c_custkey, resource_id, is_valid,
               CASE WHEN is_valid THEN nullif(split_part(resource_id, '/', 2), '') END
                   AS group_name,
               CASE WHEN is_valid THEN split_part(resource_id, ':', 4) END AS region,
               CASE WHEN is_valid THEN split_part(resource_id, ':', 5) END AS account,
               CASE WHEN is_valid THEN split_part(resource_id, ':', 2) END AS partition
        FROM matched
    """,
    "row_validation_errors": f"""
        WITH {_RAW} SELECT event_id, "dataTypeValidationErrors" FROM checked
    """,
    "invalid_rows": f"""
        WITH {_RAW} SELECT * FROM checked WHERE "dataTypeValidationErrors" <> ''
    """,
    "invalid_row_report": f"""
        WITH {_RAW} SELECT event_id, "dataTypeValidationErrors" FROM checked
        WHERE "dataTypeValidationErrors" <> ''
        ORDER BY event_id, "dataTypeValidationErrors" LIMIT 20
    """,
    "validated_cast": f"""
        WITH {_RAW} SELECT {_CAST_COLUMNS} FROM checked WHERE "dataTypeValidationErrors" = ''
    """,
    "orders_validated_cast": f"WITH {_ORDERS} SELECT * FROM orders_in",
    "audit_columns": """
        SELECT event_id, false AS is_deleted, true AS same_time FROM events
    """,
    "event_time_partitions": f"""
        WITH {_EVENTS} SELECT event_id, {_HOUR_COLUMNS} FROM events_in
    """,
    "numeric_event_time_partitions": """
        SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
               strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
        FROM events
    """,
    "offline_partitioned_write": _HISTORY,
    "offline_partition_read": f"""
        SELECT * FROM ({_HISTORY})
        WHERE year = '2024' AND month = '01' AND day = '15' AND hour = '10'
    """,
    "offline_date_append": _BY_DATE,
    "offline_date_read": f"SELECT * FROM ({_BY_DATE}) WHERE event_time_trunc = '2024-01-15'",
    "time_sliced_ingest": _HISTORY,
    "record_projection": f"""
        WITH {_RAW},
        pairs AS (
            SELECT event_id, 0 AS i, 'event_id' AS feature_name, event_id AS value_as_string
            FROM raw
            UNION ALL SELECT event_id, 1, 'event_time', event_time FROM raw
            UNION ALL SELECT event_id, 2, 'user_id', user_id FROM raw
            UNION ALL SELECT event_id, 3, 'event_type', event_type FROM raw
            UNION ALL SELECT event_id, 4, 'value', value FROM raw
            UNION ALL SELECT event_id, 5, 'props', props FROM raw)
        SELECT event_id,
               CAST(row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS INTEGER)
                   AS position,
               feature_name, value_as_string
        FROM pairs WHERE value_as_string IS NOT NULL
    """,
    "online_put_outcomes": f"WITH {_EVENTS} {_OUTCOMES}",
    "failed_records": _FAILED,
    "failed_record_count": f"""
        WITH {_EVENTS} SELECT count(online_ingestion_error) AS n_failed FROM ({_OUTCOMES})
    """,
    "online_ingest": f"""
        WITH {_RAW}
        SELECT CAST(event_id AS BIGINT) AS event_id, unnest(
            CASE WHEN "dataTypeValidationErrors" = '' THEN ['online', 'offline']
                 ELSE ['failed'] END) AS store
        FROM checked
    """,
    "latest_per_record": f"WITH {_LATEST} SELECT * FROM latest",
    "online_lookup": f"""
        WITH {_LATEST} SELECT * FROM latest
        WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
    "bounded_repartition": f"WITH {_ORDERS} SELECT * FROM orders_in",
    "ingest_reconciliation": f"""
        WITH {_ORDERS},
        copied AS (
            SELECT o_orderkey, event_time, o_custkey, o_orderstatus,
                   CASE WHEN o_orderkey % 90 = 1 THEN o_totalprice + 1
                        ELSE o_totalprice END AS o_totalprice
            FROM orders_in WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 50000)),
        stored AS (
            SELECT * FROM copied
            UNION ALL SELECT * FROM copied WHERE o_orderkey % 70 = 2
            UNION ALL SELECT -o_orderkey - 1, event_time, o_custkey, o_orderstatus, o_totalprice
            FROM copied WHERE o_orderkey % 110 = 3)
        SELECT (SELECT count(*) FROM orders_in) AS n_sent,
               (SELECT count(*) FROM stored) AS n_stored,
               (SELECT count(*) FROM (SELECT o_orderkey FROM orders_in
                    EXCEPT SELECT o_orderkey FROM stored)) AS n_missing,
               (SELECT count(*) FROM (SELECT o_orderkey FROM stored
                    EXCEPT SELECT o_orderkey FROM orders_in)) AS n_extra,
               (SELECT count(*) FROM (SELECT o_orderkey FROM stored
                    GROUP BY o_orderkey HAVING count(*) > 1)) AS n_duplicate,
               (SELECT count(DISTINCT o_orderkey) FROM (
                    SELECT * FROM orders_in EXCEPT ALL SELECT * FROM stored)
                WHERE o_orderkey IN (SELECT o_orderkey FROM stored)) AS n_changed
    """,
    "stored_reconciliation": """
        SELECT count(*) AS n_sent, count(*) AS n_stored, CAST(0 AS BIGINT) AS n_missing,
               CAST(0 AS BIGINT) AS n_extra, CAST(0 AS BIGINT) AS n_duplicate,
               CAST(0 AS BIGINT) AS n_changed
        FROM events
    """,
    "streaming_ingest": _VALID_HISTORY,
    "streaming_quarantine": f"""
        WITH {_RAW} SELECT * FROM checked WHERE "dataTypeValidationErrors" <> ''
    """,
    "csv_inferred_source": """
        SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal,
               c_mktsegment
        FROM customer
    """,
    "lineitem_row_errors": """
        SELECT concat_ws(',',
                   CASE WHEN line % 37 = 0 THEN 'l_quantity not valid' END,
                   CASE WHEN line % 41 = 0 OR l_extendedprice > 50000
                        THEN 'l_extendedprice not valid' END
               ) AS "dataTypeValidationErrors",
               count(*) AS n_rows
        FROM (SELECT l_orderkey * 100 + l_linenumber AS line, l_extendedprice FROM lineitem)
        GROUP BY 1
    """,
    "lineitem_latest": f"WITH {_PARTS} SELECT * EXCLUDE (rn) FROM (" """
        SELECT *, row_number() OVER (
            PARTITION BY l_partkey ORDER BY event_time DESC, line DESC, l_quantity DESC,
                l_extendedprice DESC, l_returnflag DESC) AS rn
        FROM parts_in)
        WHERE rn = 1
    """,
    "lineitem_reconciliation": f"WITH {_PARTS}," """
        stored AS (SELECT * FROM parts_in WHERE l_returnflag <> 'R')
        SELECT (SELECT count(*) FROM parts_in) AS n_sent,
               (SELECT count(*) FROM stored) AS n_stored,
               (SELECT count(*) FROM (SELECT l_partkey FROM parts_in
                    EXCEPT SELECT l_partkey FROM stored)) AS n_missing,
               CAST(0 AS BIGINT) AS n_extra,
               (SELECT count(*) FROM (SELECT l_partkey FROM stored
                    GROUP BY l_partkey HAVING count(*) > 1)) AS n_duplicate,
               (SELECT count(DISTINCT l_partkey) FROM (
                    SELECT * FROM parts_in EXCEPT ALL SELECT * FROM stored)
                WHERE l_partkey IN (SELECT l_partkey FROM stored)) AS n_changed
    """,
    "accepted_history": f"SELECT * FROM ({_HISTORY}) WHERE event_id % 100 <> 0",
    "online_merge": f"WITH {_LATEST} SELECT * FROM latest",
    "streaming_merge": f"""
        WITH {_RAW} SELECT {_CAST_COLUMNS} FROM checked WHERE "dataTypeValidationErrors" = ''
    """,
    "streaming_merge_quarantine": f"""
        WITH {_RAW} SELECT event_id, "dataTypeValidationErrors" AS error FROM checked
    """,
    "streaming_date_ingest": _BY_DATE,
    "widened_reconciliation": """
        SELECT count(*) AS n_sent, count(*) FILTER (WHERE o_orderkey % 50 <> 7) AS n_stored,
               count(*) FILTER (WHERE o_orderkey % 50 = 7) AS n_missing,
               CAST(0 AS BIGINT) AS n_extra, CAST(0 AS BIGINT) AS n_duplicate,
               CAST(0 AS BIGINT) AS n_changed
        FROM orders
    """,
    "restarted_ingest": _HISTORY,
    "refused_then_ingested": _VALID_HISTORY,
    "history_range": f"""
        WITH {_EVENTS}
        SELECT events_in.*, layout
        FROM events_in, (VALUES ('events'), ('events_by_date')) AS layouts(layout)
        WHERE CAST(event_time AS TIMESTAMP) >= TIMESTAMP '2024-01-09 05:30:00'
          AND CAST(event_time AS TIMESTAMP) < TIMESTAMP '2024-01-17 12:15:00'
    """,
    "streamed_put_failures": _FAILED,
    "history_differences": f"""
        WITH {_EVENTS},
        marked AS (
            SELECT *, substr(event_time, 12, 2) < '06' AS early FROM events_in),
        findings AS (
            SELECT event_id, event_time, unnest(CASE
                WHEN event_id % 29 = 1 THEN [
                    {{'difference': 'missing', 'column': NULL, 'sent': NULL, 'stored': NULL}}]
                WHEN event_id % 41 = 2 THEN [
                    {{'difference': 'repeated', 'column': NULL, 'sent': '1', 'stored': '2'}}]
                ELSE list_filter([
                    CASE WHEN event_id % 31 = 3 AND event_type IS DISTINCT FROM 'retyped'
                         THEN {{'difference': 'changed', 'column': 'event_type',
                               'sent': event_type, 'stored': 'retyped'}} END,
                    CASE WHEN event_id % 37 = 4 AND user_id IS DISTINCT FROM -event_id
                         THEN {{'difference': 'changed', 'column': 'user_id',
                               'sent': CAST(user_id AS VARCHAR),
                               'stored': CAST(-event_id AS VARCHAR)}} END],
                    lambda x: x IS NOT NULL) END) AS f
            FROM marked WHERE early)
        SELECT event_id, event_time, f.difference AS difference, f."column" AS "column",
               f.sent AS sent, f.stored AS stored
        FROM findings
    """,
    "deleted_records": f"""
        WITH {_LATEST}
        SELECT user_id, event_id, 'online' AS store FROM latest
        WHERE user_id IS NOT NULL AND (user_id % 5 <> 0 OR event_time > 1705752000)
        UNION ALL
        SELECT user_id, event_id, 'history' FROM users_in WHERE user_id IS NOT NULL
        UNION ALL
        SELECT DISTINCT user_id, -1, 'deletion' FROM users_in WHERE user_id % 5 = 0
    """,
    "online_touched_merge": f"WITH {_LATEST} SELECT * FROM latest",
    "compacted_history": _HISTORY,
    "streamed_missing": f"""
        WITH {_EVENTS},
        lost AS (
            SELECT *, CAST(event_time AS TIMESTAMP) AS moment,
                   substr(event_time, 12, 2) < '06' AND event_id % 29 = 1 AS is_lost
            FROM events_in),
        passed AS (
            SELECT least(max(moment), max(moment) FILTER (WHERE NOT is_lost))
                   - INTERVAL 2 DAY AS until
            FROM lost)
        SELECT event_id, event_time, user_id, event_type, value, props
        FROM lost, passed WHERE is_lost AND moment <= until
    """,
}
