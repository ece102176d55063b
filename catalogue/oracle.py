"""DuckDB equivalents of the queries, by key."""

from __future__ import annotations

DAY = "2024-01-15"
RUN_TIME = "2024-02-01 03:00:00"

_DT = "strftime(ts, '%Y-%m-%d')"
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
_SECOND = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_EVENT = "event_id, user_id, event_type, value, props"

_MIXED = f"""CASE WHEN event_type IN ('click', 'error') THEN strftime(ts, '%Y%m%d')
       WHEN event_type = 'view' THEN {_DT} ELSE {_SECOND.format('ts')} END"""

_CUSTOMERS = """
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
               CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal AS VARCHAR) AS balance,
               CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment
        FROM customer"""

_DIRTY = f"""CASE WHEN user_id % 11 = 0 THEN NULL
       WHEN event_type = 'error' THEN {_SECOND.format('ts')} || ' +'
       WHEN event_type = 'view' THEN regexp_replace({_SECOND.format('ts')}, '-01-', '-13-', 'g')
       ELSE {_SECOND.format('ts')} END"""

# Exactly the format, then a real date: the parser alone would let some text pass.
_PARSED = r"""CASE WHEN regexp_full_match(t, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')
       THEN try_strptime(t, '%Y-%m-%d %H:%M:%S') END"""

_CLEAN = r"replace(replace({}, chr(13), ''), chr(10), '')"

_CREATED = "CASE WHEN event_type <> 'error' THEN ts - to_days(CAST(user_id % 10 AS INTEGER)) END"

_CHANGED = f"""SELECT DISTINCT strftime(created, '%Y-%m-%d') AS date
    FROM (SELECT *, {_CREATED} AS created FROM events)
    WHERE {_DT} = '{DAY}' AND value > 50 AND created IS NOT NULL"""


def _shifted(amount: str) -> str:
    return _SECOND.format(f"p {amount}")


def _column(name: str, kind: str, comment: str, length: str) -> str:
    comment = comment.replace("'", "''")  # as the statement writes it
    line = f"`{name}` {kind} COMMENT '{comment}'".replace("'", "''")
    return f"SELECT '{name}' AS col_name, '{line}' AS definition, max(length({length})) AS longest FROM orders"


_DDL = " UNION ALL ".join(
    [
        _column("o_orderkey", "bigint", "the order's key", "CAST(o_orderkey AS VARCHAR)"),
        _column("o_custkey", "bigint", "", "CAST(o_custkey AS VARCHAR)"),
        _column("o_orderstatus", "varchar(256)", "", "o_orderstatus"),
        _column("o_totalprice", "decimal(16,4)", "", "CAST(CAST(o_totalprice AS DECIMAL(16,4)) AS VARCHAR)"),
        _column("o_orderdate", "varchar(128)", "", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"),
        _column("o_orderpriority", "varchar(256)", "", "o_orderpriority"),
    ]
)


ORACLE: dict[str, str] = {
    "load_all": f"SELECT *, '{DAY}' AS dt FROM customer",
    "split_by_quantiles": """
        SELECT l_orderkey, l_linenumber, l_extendedprice,
               CAST(CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 10 <> 1 THEN l_partkey END AS VARCHAR) AS l_key,
               1 AS n_splits, true AS even
        FROM lineitem""",
    "load_new": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               {_SECOND.format('o_orderdate')} AS o_orderdate, o_orderpriority,
               strftime(o_orderdate, '%Y-%m-%d') AS dt
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-09'""",
    "load_new_and_change": f"""
        WITH days AS (
            SELECT strftime(d, '%Y-%m-%d') AS dt
            FROM generate_series(DATE '1998-10-01', DATE '1998-10-07', INTERVAL 1 DAY) g(d))
        SELECT l_orderkey, l_linenumber, o_custkey, l_extendedprice,
               {_SECOND.format('o_orderdate')} AS o_orderdate,
               {_SECOND.format('l_shipdate')} AS l_shipdate, dt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN days ON strftime(o_orderdate, '%Y-%m-%d') = dt
                  OR strftime(l_shipdate, '%Y-%m-%d') = dt""",
    "load_new_iso_text": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created, value, {_DT} AS dt FROM events
        WHERE {_DT} BETWEEN '2024-01-03' AND '2024-01-09' AND event_id % 5 <> 0""",
    "load_new_closed_second": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events
        WHERE {_DT} BETWEEN '2024-01-03' AND '2024-01-28'
          AND ts <= date_trunc('day', ts) + INTERVAL 86399 SECOND""",
    "load_new_and_change_closed_second": f"""
        SELECT {_EVENT}, {_TS}, strftime(updated, '%Y-%m-%d %H:%M:%S.%f') AS updated, '{DAY}' AS dt
        FROM (SELECT *, ts + to_hours(CAST(event_id % 72 AS BIGINT)) AS updated FROM events)
        WHERE ts BETWEEN TIMESTAMP '{DAY} 00:00:00' AND TIMESTAMP '{DAY} 23:59:59'
           OR updated BETWEEN TIMESTAMP '{DAY} 00:00:00' AND TIMESTAMP '{DAY} 23:59:59'""",
    "load_range_derive_dt": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-07 00:00:00' AND TIMESTAMP '2024-01-11 23:59:59'
           OR ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-07 00:00:00'""",
    "scan_by_dt": f"SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events WHERE {_DT} = '{DAY}'",
    "range_project_allowlist": """
        WITH allowed AS (
            SELECT c_custkey AS institution FROM customer WHERE c_acctbal > 0
            UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
        SELECT event_id, user_id, event_type, value
        FROM events JOIN allowed ON user_id = institution
        WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'""",
    "csv_all_string_load": _CUSTOMERS,
    "xlsx_all_string_load": _CUSTOMERS,
    "cn_date_to_dt": f"""
        SELECT event_id,
               CASE event_type
                 WHEN 'click' THEN year(ts) || '年' || month(ts) || '月' || day(ts) || '日'
                 WHEN 'view' THEN year(ts) || '|' || month(ts) || '|' || day(ts)
                 WHEN 'error' THEN props
                 ELSE {_SECOND.format('ts')} END AS fill_in_time,
               CASE WHEN event_type <> 'error' THEN {_DT} END AS dt
        FROM events""",
    "multi_format_day_match": f"""
        SELECT '{DAY}' AS dt, event_id, month, value
        FROM (SELECT *, {_MIXED} AS month FROM events)
        WHERE month = '{DAY}' OR month = '20240115'
           OR strftime(TRY_CAST(month AS TIMESTAMP), '%Y-%m-%d') = '{DAY}'""",
    "load_mixed_day_range": f"""
        SELECT event_id, {_MIXED} AS month, value, {_DT} AS dt FROM events
        WHERE {_DT} BETWEEN '2024-01-10' AND '2024-01-20'""",
    "day_range": """
        WITH span AS (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders),
             days AS (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY)) AS d FROM span),
             per_day AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
        SELECT strftime(d, '%Y-%m-%d') AS dt, coalesce(n, 0) AS n
        FROM days LEFT JOIN per_day ON CAST(d AS DATE) = day""",
    "text_to_epoch_ms": f"""
        SELECT event_id, coalesce(epoch_ms({_PARSED}), 0) AS ms
        FROM (SELECT *, {_DIRTY} AS t FROM events)""",
    "text_to_epoch_ms_lenient": """
        SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN 0
                              ELSE epoch_ms(date_trunc('second', ts)) END AS ms
        FROM events""",
    "epoch_ms_to_text": f"""
        SELECT event_id, ms, {_SECOND.format('make_timestamp_ms(ms)')} AS t
        FROM (SELECT event_id,
                     epoch_ms(date_trunc('minute', ts)) + event_id % 60000 AS ms FROM events)""",
    "shift_time": f"""
        SELECT event_id,
               {_shifted('- INTERVAL 15 MINUTE')} AS back_quarter,
               {_shifted('+ INTERVAL 15 MINUTE')} AS next_quarter,
               {_shifted('- INTERVAL 1 HOUR')} AS back_hour,
               {_shifted('- INTERVAL 24 HOUR')} AS back_day,
               {_shifted('- INTERVAL 168 HOUR')} AS back_week
        FROM (SELECT event_id, {_PARSED} AS p FROM (SELECT *, {_DIRTY} AS t FROM events))""",
    "is_valid_timestamp": f"""
        SELECT event_id, t, CASE WHEN {_PARSED} IS NOT NULL THEN 1 ELSE 0 END AS valid
        FROM (SELECT *, {_DIRTY} AS t FROM events)""",
    "iso_weekday": "SELECT o_orderkey, isodow(o_orderdate) AS weekday FROM orders",
    "stream_windows": f"""
        SELECT {_DT} AS dt, {_SECOND.format("time_bucket(INTERVAL 6 HOUR, ts)")} AS window_start, event_type,
               count(*) AS n, sum(value) AS total, max(event_id) AS last_id
        FROM events GROUP BY ALL""",
    "tumbling_window_start": f"""
        SELECT event_id,
               {_SECOND.format("time_bucket(INTERVAL 1 DAY, ts, INTERVAL '-8 hours')")} AS window_start
        FROM events""",
    "strip_newlines": f"""
        SELECT doc_id, {_CLEAN.format('text || chr(13) || chr(10) || lang')} AS text, source, n_chars
        FROM documents""",
    "strip_newlines_pages": f"""
        SELECT page_id, {_CLEAN.format('url')} AS url, {_CLEAN.format('html')} AS html FROM pages""",
    "blank_to_null": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN o_orderstatus END AS status,
               o_orderpriority
        FROM orders""",
    "strip_last_suffix": """
        SELECT event_id,
               'log_' || event_type || '_' || year(ts)
                   || CASE WHEN event_type = 'view' THEN ':_docx' ELSE '' END AS "index",
               'log_' || event_type
                   || CASE WHEN event_type = 'view' THEN ':_docx' ELSE '' END AS base
        FROM events""",
    "export_stamped": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt, '{RUN_TIME}' AS last_update_time FROM events
        WHERE {_DT} BETWEEN '2024-01-10' AND '2024-01-12'""",
    "union_by_position": """
        SELECT c_custkey AS col0, CAST(c_nationkey AS BIGINT) AS col1 FROM customer
        UNION ALL SELECT CAST(s_nationkey AS BIGINT), s_suppkey FROM supplier""",
    "union_by_name": """
        SELECT c_custkey AS col0, CAST(c_nationkey AS BIGINT) AS col1 FROM customer
        UNION ALL SELECT s_suppkey, CAST(s_nationkey AS BIGINT) FROM supplier""",
    "sink_replace_day": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN {_DT} = '{DAY}' THEN value ELSE -1.0 END AS value, props, {_TS}, {_DT} AS dt
        FROM events""",
    "sink_replace_day_date": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN {_DT} IN ('{DAY}', '2024-01-17') THEN value ELSE -1.0 END AS value, props, {_TS}, {_DT} AS dt
        FROM events""",
    "sink_replace_day_empty": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events WHERE {_DT} <> '{DAY}'""",
    "sink_replace_range": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN {_DT} BETWEEN '2024-01-10' AND '2024-01-20' THEN value ELSE -1.0 END AS value,
               props, {_TS}, {_DT} AS dt
        FROM events
        WHERE {_DT} NOT BETWEEN '2024-01-10' AND '2024-01-20' OR event_type <> 'error'""",
    "sink_replace_table": "SELECT * FROM part",
    "sink_ignore_existing": f"SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events",
    "snapshot_per_day": """
        SELECT s.*, d.dt
        FROM supplier s, (VALUES ('2024-01-01'), ('2024-01-02'), ('2024-01-03')) d(dt)""",
    "evolve_add_columns": f"""
        SELECT {_EVENT},
               CASE WHEN {_DT} = '{DAY}' THEN CAST(isodow(ts) AS VARCHAR) END AS weekday,
               {_TS}, {_DT} AS dt
        FROM events""",
    "evolve_widen_types": f"""
        WITH e AS (SELECT *, {_DT} AS dt, {_DT} = '{DAY}' AS wide FROM events)
        SELECT 'external' AS kind,
               CAST(CASE WHEN wide THEN event_id + 1099511627776 ELSE event_id END AS VARCHAR) AS event_id,
               CAST(CAST(CASE WHEN wide THEN user_id * 1.0625 ELSE user_id * 1.25 END AS DECIMAL(20, 4)) AS VARCHAR) AS amount,
               CAST(NULL AS VARCHAR) AS happened, dt
        FROM e
        UNION ALL
        SELECT 'managed',
               CASE WHEN wide THEN 'e' || (event_id + 1099511627776) ELSE CAST(event_id AS VARCHAR) END,
               CAST(CAST(CASE WHEN wide THEN user_id * 1.0625 ELSE user_id * 1.25 END AS DECIMAL(20, 4)) AS VARCHAR),
               CASE WHEN wide THEN {_SECOND.format('ts')} ELSE dt || ' 00:00:00' END, dt
        FROM e""",
    "snapshot_as_of": """
        SELECT o_orderkey,
               CASE WHEN o_custkey % 4 = d.n AND o_orderkey % 3 = 0 THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, d.dt
        FROM orders, (VALUES (0, '2024-01-01'), (1, '2024-01-02'), (2, '2024-01-03'), (3, '2024-01-04')) d(n, dt)
        WHERE o_orderkey % 5 <= d.n + 2 AND o_orderkey % 7 <> d.n""",
    "evolve_fill_missing": f"""
        SELECT event_id, CASE WHEN {_DT} <> '{DAY}' THEN CAST(user_id AS VARCHAR) END AS user_id, event_type, value,
               CASE WHEN {_DT} <> '{DAY}' THEN props ELSE '' END AS props, {_TS}, {_DT} AS dt
        FROM events""",
    "evolve_drop_new": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN {_DT} = '{DAY}' THEN value + 1 ELSE value END AS value, props,
               {_DT} AS dt, {_TS}
        FROM events""",
    "column_comments": """
        SELECT 'c_custkey' AS col_name, 'customer key' AS comment, count(c_custkey) AS n_values
        FROM customer
        UNION ALL SELECT 'c_name', '', count(c_name) FROM customer
        UNION ALL SELECT 'c_nationkey', '', count(c_nationkey) FROM customer
        UNION ALL SELECT 'c_acctbal', 'account balance', count(c_acctbal) FROM customer
        UNION ALL SELECT 'c_mktsegment', '', count(c_mktsegment) FROM customer""",
    "align_to_target": """
        SELECT o_custkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_name,
               CAST(NULL AS VARCHAR) AS c_nationkey, o_totalprice AS c_acctbal,
               o_orderpriority AS c_mktsegment
        FROM orders""",
    "schema_to_ddl": _DDL,
    "relational_rows": f"""
        SELECT l_orderkey, l_linenumber,
               CAST(CAST(l_extendedprice AS DECIMAL(16,4)) AS DOUBLE) AS l_extendedprice,
               l_returnflag, {_SECOND.format('l_shipdate')} AS l_shipdate
        FROM lineitem""",
    "changed_days": f"""
        SELECT DISTINCT strftime(created, '%Y-%m-%d') AS ct
        FROM (SELECT *, {_CREATED} AS created FROM events)
        WHERE {_DT} = '{DAY}' AND created IS NOT NULL""",
    "changed_days_by_digest": f"""
        SELECT 2 AS run, dt, CASE WHEN dt = last THEN 0 ELSE n END AS n
        FROM (SELECT {_DT} AS dt, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors,
                     max({_DT}) OVER () AS last FROM events GROUP BY 1)
        WHERE dt = last OR dt = '{DAY}' AND errors > 0""",
    "changed_days_sql": f"{_CHANGED} ORDER BY date",
    "propagate_changed_days": f"""
        WITH changed AS ({_CHANGED})
        SELECT event_id, user_id, event_type,
               CASE WHEN c.date IS NOT NULL THEN value ELSE -1.0 END AS value, props, {_TS},
               CASE WHEN c.date IS NOT NULL THEN '{RUN_TIME}' ELSE '2024-01-31 03:00:00' END
                   AS last_update_time,
               {_DT} AS dt
        FROM events LEFT JOIN changed c ON c.date = {_DT}""",
    "upsert_by_key": """
        WITH batch AS (
            SELECT o_custkey * 2 AS c_custkey,
                   arg_max(struct_pack(
                       segment := CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END,
                       price := o_totalprice), (o_orderdate, o_orderkey)) AS latest
            FROM orders GROUP BY 1)
        SELECT * REPLACE (CAST(c_nationkey AS VARCHAR) AS c_nationkey)
        FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
        UNION ALL
        SELECT c_custkey, NULL, NULL, latest.price, latest.segment FROM batch""",
    "upsert_blank_typed": f"""
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 2 <> 0 THEN '7' WHEN o_orderkey % 3 <> 0 THEN '9' END AS o_rank,
               CASE WHEN o_orderkey % 2 <> 0 OR o_orderkey % 3 <> 0
                    THEN {_SECOND.format('o_orderdate')} END AS o_orderdate
        FROM orders""",
    "upsert_by_key_hours": f"""
        SELECT event_id,
               CASE WHEN moved OR changed THEN value + 1 ELSE value END AS value,
               CASE WHEN moved THEN '2024-01-16' ELSE dt END AS dt, dh
        FROM (SELECT *, dt = '{DAY}' AND dh = '05' AS moved,
                     dt = '{DAY}' AND dh = '07' AND event_id % 2 = 0 AS changed
              FROM (SELECT event_id, value, {_DT} AS dt, strftime(ts, '%H') AS dh FROM events
                    WHERE {_DT} BETWEEN '2024-01-14' AND '2024-01-16'))""",
    "sink_swap_location": f"""
        SELECT {_EVENT}, {_TS}, strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS dt FROM events WHERE {_DT} <> '{DAY}'""",
    "sink_replace_range_outside": f"""
        SELECT event_id, user_id, event_type, CASE WHEN event_type = 'click' THEN value + 2 ELSE value END AS value,
               props, {_TS}, {_DT} AS dt
        FROM events
        WHERE event_type = 'click' OR event_type = 'view' AND {_DT} NOT BETWEEN '{DAY}' AND '2024-01-18'""",
    "upsert_pruned": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN moved THEN 0.0 WHEN user_id % 50 = 1 THEN value + 1 ELSE value END AS value, props, {_TS},
               CASE WHEN moved THEN strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') ELSE {_DT} END AS dt
        FROM (SELECT *, {_DT} = '{DAY}' AND event_type = 'error' AS moved FROM events)""",
    "upsert_by_key_days": f"""
        SELECT event_id, user_id, event_type,
               CASE WHEN moved THEN value + 1 ELSE value END AS value, props, {_TS},
               CASE WHEN moved THEN strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') ELSE {_DT} END AS dt
        FROM (SELECT *, ({_DT} = '{DAY}' OR event_type = 'error') AS moved FROM events)""",
    "word_count": r"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "last_value_by_key": """
        SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type
        FROM events GROUP BY user_id""",
    "drop_partition_range": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events
        WHERE {_DT} NOT BETWEEN '2024-01-05' AND '2024-01-10'""",
    "drop_partition_range_long": f"""
        SELECT {_EVENT}, {_TS}, {_DT} AS dt FROM events
        WHERE {_DT} NOT BETWEEN '2024-01-05' AND '2024-01-16'""",
    "list_partitions": f"SELECT DISTINCT 'dt=' || {_DT} AS partition FROM events",
    "retention_clean": f"""
        SELECT event_type || 's' AS table_name, {_DT} AS dt, count(*) AS n
        FROM events WHERE event_type IN ('click', 'view') AND {_DT} > '2024-01-12' GROUP BY ALL
        UNION ALL
        SELECT 'unpartitioned', {_DT}, count(*) FROM events GROUP BY ALL""",
    "drop_all_tables": """
        SELECT 'supplier' AS table_name, count(*) AS n_rows, CAST(0 AS INTEGER) AS "left" FROM supplier
        UNION ALL SELECT 'part', count(*), 0 FROM part
        UNION ALL SELECT 'customer', count(*), 0 FROM customer""",
    "multi_table_load": f"""
        SELECT 'ods_vendor' AS table_name, s_suppkey AS key, '{DAY}' AS dt FROM supplier
        UNION ALL SELECT 'ods_part', p_partkey, '{DAY}' FROM part
        UNION ALL SELECT 'ods_customer', c_custkey, '{DAY}' FROM customer""",
    "copy_table": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus,
               {_SECOND.format('l_shipdate')} AS l_shipdate
        FROM lineitem""",
    "export_csv": f"""
        SELECT {_EVENT}, {_DT} AS dt FROM events
        WHERE {_DT} BETWEEN '2024-01-10' AND '2024-01-12'""",
    "export_range_csv": f"""
        SELECT {_EVENT}, {_SECOND.format('ts')} AS created FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'""",
    "export_json_docs": f"SELECT *, '{RUN_TIME}' AS last_update_time FROM documents",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
