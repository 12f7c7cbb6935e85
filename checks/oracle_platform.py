"""DuckDB SQL for the calendar, dimension, load, migration and run-log queries."""

from __future__ import annotations

from checks.oracle_reports import payment, summary_by_stage, txn_revenue, with_roles, summary_by_stage

DAYS = "days AS (SELECT DISTINCT local_day AS d FROM txn_all)"
QUARTER = "'Q' || quarter(d) || ' ' || strftime(d, '%Y')"
WEEK = "strftime(d, '%G%V')"
DAY = "strftime({}, '%Y-%m-%d')"
LEVEL = {
    "day": ("d", "d"),
    "week": ("CAST(date_trunc('week', d) AS DATE)", "first + 6"),
    "month": ("CAST(date_trunc('month', d) AS DATE)", "last_day(first)"),
    "quarter": ("CAST(date_trunc('quarter', d) AS DATE)", "last_day(CAST(first + INTERVAL 2 MONTH AS DATE))"),
    "year": ("CAST(date_trunc('year', d) AS DATE)", "last_day(CAST(first + INTERVAL 11 MONTH AS DATE))"),
}
PERSONS = """
    keymap AS (SELECT c_custkey AS old_id, c_custkey * 3 + 1000000 AS new_id FROM customer WHERE c_acctbal >= 0)"""
NATIONS = """
    nations AS (SELECT CAST(n_nationkey AS BIGINT) + 100 AS id, CAST(n_nationkey AS VARCHAR) AS code, n_name AS title,
                       CAST(n_nationkey % 7 = 0 AS INTEGER) AS is_deleted FROM nation)"""
PARTS = """
    parts AS (SELECT p_partkey + 5000 AS id, 'P' || p_partkey AS code, CAST(p_partkey % 10 = 0 AS INTEGER) AS is_deleted FROM part)"""
LINES = """
    coded AS (SELECT l_orderkey, l_linenumber, 'P' || l_partkey AS part_code, l_suppkey AS supplier_code,
                     CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_suppkey % 27 AS VARCHAR) END AS nation_code,
                     '  ' || (l_suppkey % 25) || ' ' AS padded_code FROM lineitem)"""
CODES = """
    code_rows AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN ''
                         WHEN o_orderkey % 13 = 0 THEN (o_orderkey % 28) || ';;' || (o_custkey % 30)
                         WHEN o_orderkey % 17 <> 0 THEN (o_orderkey % 28) || ';' || (o_custkey % 30) || ';' || (o_orderkey % 5)
                         END AS codes FROM orders)"""
TOKENS = "[x FOR x IN string_split_regex(codes, '[,;]') IF x <> '']"
HISTORY = """
    history AS (SELECT event_id AS id, user_id AS stmt_id, strftime(ts, '%Y-%m-%d %H:%M') AS run_at,
                       CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
                       CAST(floor(value) AS BIGINT) AS insert_rows FROM events)"""
LATEST = "row_number() OVER (PARTITION BY stmt_id ORDER BY run_at DESC, id DESC)"
RUN_LOG = """
    run_log AS (SELECT event_id AS id, 'Job_' || event_type AS job_name,
                       CASE WHEN event_id % 9 <> 0 THEN 'Mart_' || upper(event_type[1]) || event_type[2:] || '_' || (user_id % 10) END AS table_name,
                       ts AS created_at FROM events)"""
REGISTRY = """
    registry AS (SELECT p_partkey AS id, CAST(p_partkey % 7 AS VARCHAR) AS job_type, p_brand AS schema_name,
                        lower(p_type) || '_' || p_partkey AS table_name, 'sql/' || p_name AS sql_path,
                        p_partkey % 3 <> 0 AS is_active FROM part)"""
IMPORTED = """
    cleaned AS (SELECT o_orderkey AS row_number, CAST(o_orderkey % 8 AS VARCHAR) AS job_type,
                       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority ELSE '' END AS schema_name,
                       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 't' || o_custkey END AS table_name,
                       CASE WHEN o_orderkey % 17 <> 0 THEN 'sql/' || o_orderstatus ELSE '' END AS sql_path,
                       CASE WHEN o_orderkey % 19 <> 0 THEN [true, true, false, false, true][CAST(o_orderkey % 5 + 1 AS INTEGER)] END AS is_active
                FROM orders),
    checked AS (SELECT *, array_to_string([x FOR x IN [
                    CASE WHEN job_type NOT IN ('1', '2', '3', '4', '5') THEN 'Loại job không hợp lệ (phải là 1-5)' END,
                    CASE WHEN schema_name = '' THEN 'Schema name không được rỗng' END,
                    CASE WHEN table_name = '' THEN 'Table name không được rỗng' END,
                    CASE WHEN sql_path = '' THEN 'SQL Path không được rỗng' END,
                    CASE WHEN is_active IS NULL THEN 'is_active không hợp lệ (phải là TRUE/FALSE)' END] IF x IS NOT NULL], ', ') AS errors
                FROM cleaned)"""
MART = """
    mart AS (SELECT checkout_toll_id, strftime(local_day, '%Y') AS year, strftime(local_day, '%m') AS month,
                    strftime(local_day, '%d') AS day, COUNT(*) AS n, CAST(SUM(total_amount) AS DOUBLE) AS amount FROM txn_all GROUP BY ALL)"""
HANDOVER = """
    records AS (SELECT o_orderkey AS record_id, CASE WHEN o_custkey % 50 <> 0 THEN 'G' || (o_custkey % 40) END AS giver,
                       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS rank, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS post,
                       CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 7 END AS office_id, strftime(o_orderdate, '%Y-%m') AS signed_on FROM orders)"""
DATE_TEXTS = """
    texts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                     WHEN o_orderkey % 5 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 5 = 2 THEN strftime(o_orderdate, '%Y/%m/%d')
                     WHEN o_orderkey % 35 = 3 THEN '31/02/2020' WHEN o_orderkey % 35 = 8 THEN '99/99/2020'
                     WHEN o_orderkey % 35 = 13 THEN '1/2/2020' WHEN o_orderkey % 35 = 18 THEN ''
                     WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%d/%m/%Y') END AS date_text FROM orders)"""
REFERENCES = [
    ("lineitem", "orders", "l_orderkey", "o_orderkey"), ("lineitem", "part", "l_partkey", "p_partkey"),
    ("lineitem", "supplier", "l_suppkey", "s_suppkey"), ("orders", "customer", "o_custkey", "c_custkey"),
    ("customer", "nation", "c_nationkey", "n_nationkey"), ("supplier", "nation", "s_nationkey", "n_nationkey"),
    ("nation", "region", "n_regionkey", "r_regionkey"),
]


def days(body: str) -> str:
    return with_roles("txn_all", f", {DAYS} {body}")


def utc_ranges(level: str) -> str:
    first, last = LEVEL[level]
    return days(f""",
        firsts AS (SELECT DISTINCT {first} AS first FROM days),
        local AS (SELECT first, CAST(unnest(generate_series(first, {last.replace('d', 'first') if level == 'day' else last}, INTERVAL 1 DAY)) AS DATE) AS d FROM firsts),
        ranges AS (SELECT first, d - 1 AS u, '17' AS hour_start, '23' AS hour_end FROM local
                   UNION ALL SELECT first, d, '00', '16' FROM local)
        SELECT {DAY.format('first')} AS period_start, strftime(u, '%Y') AS year, strftime(u, '%m') AS month, strftime(u, '%d') AS day,
               hour_start, hour_end FROM ranges""")


def code_list(by_position: bool) -> str:
    ids = "listagg(n.id, ',' ORDER BY t.pos)" if by_position else "listagg(DISTINCT n.id, ',' ORDER BY n.id)"
    out = "'[' || coalesce(ids, '') || ']'" if by_position else "'[' || ids || ']'"
    return f"""WITH {CODES}, {NATIONS},
        tokens AS (SELECT o_orderkey, unnest({TOKENS}) AS code, generate_subscripts({TOKENS}, 1) AS pos FROM code_rows),
        lists AS (SELECT o_orderkey, {ids} AS ids FROM tokens t JOIN nations n ON n.code = t.code GROUP BY o_orderkey)
        SELECT c.o_orderkey, codes, {out} AS id_list FROM code_rows c LEFT JOIN lists l ON c.o_orderkey = l.o_orderkey"""


def key_remap(kind: str) -> str:
    return f"""WITH {PERSONS}
        SELECT o_orderkey, coalesce(new_id, -1) AS person_id, o_orderstatus
        FROM orders {'JOIN' if kind == 'inner' else 'JOIN customer ON c_custkey = o_custkey LEFT JOIN'} keymap ON old_id = o_custkey"""


def platform_sql() -> dict[str, str]:
    """SQL per platform query."""
    grades = ", ".join(f"coalesce(g{i}.id, -1) AS grade_{i}_id" for i in range(1, 8))
    grade_joins = " ".join(
        f"LEFT JOIN nations g{i} ON g{i}.code = CAST((o_orderkey * {i} + o_custkey) % 29 AS VARCHAR)" for i in range(1, 8)
    )
    edges = " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{p}' AS parent WHERE EXISTS (SELECT 1 FROM {c} JOIN {p} ON {fk} = {pk})" for c, p, fk, pk in REFERENCES
    )
    out = {
        "scan_fact_detail": with_roles("detail", """
            SELECT transport_trans_id, stage_id, price_id, price_type, CAST(price_amount AS DOUBLE) AS price_amount, year, month, day, hour
            FROM detail"""),
        "dim_load_cached": "SELECT 'dim_toll' AS view_name, COUNT(*) AS n FROM nation UNION ALL SELECT 'dim_vehicle', COUNT(*) FROM customer",
        "dim_stage_closed": with_roles("stage_closed", """
            SELECT stage_id, stage_code, stage_name, cycle_id, cycle_name, checkin_toll_id, checkin_toll_name, checkout_toll_id,
                   checkout_toll_name, status, boo FROM stage_closed"""),
        "dim_stage_closed_lanes": with_roles("stage_closed lane", """
            SELECT stage_id, stage_code, stage_name, cycle_id, cycle_name, checkin_toll_id, checkin_toll_name, checkout_toll_id,
                   checkout_toll_name, status, boo, a.toll_lane_id AS checkin_lane_id, a.lane_name AS checkin_lane_name,
                   b.toll_lane_id AS checkout_lane_id, b.lane_name AS checkout_lane_name
            FROM stage_closed LEFT JOIN lane a ON a.toll_id = checkin_toll_id LEFT JOIN lane b ON b.toll_id = checkout_toll_id"""),
        "dim_cycle_lane": with_roles("toll lane", """
            SELECT t.cycle_id, 'C' || t.cycle_id AS cycle_code, cycle_name, t.toll_id, toll_name, lane_code, lane_name
            FROM toll t LEFT JOIN lane l ON l.toll_id = t.toll_id"""),
        "copy_columns": "SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0",
        "job_select": f"WITH {REGISTRY} SELECT * FROM registry WHERE is_active AND job_type = '3' ORDER BY id",
        "mart_feed_projection": with_roles("txn_all", """
            SELECT transport_trans_id, etag_number, vehicle_id, checkin_toll_id, checkin_lane_id, 1997 AS year, 10 AS month, 15 AS day
            FROM txn_all"""),
        "detail_base_join": with_roles("detail_all txn_all stage_closed", """
            SELECT d.transport_trans_id, d.stage_id, price_id, price_type, price_ticket_type, CAST(price_amount AS DOUBLE) AS price_amount,
                   vehicle_id, checkout_channel, charge_status, CAST(total_amount AS DOUBLE) AS total_amount, stage_name, s.cycle_name,
                   s.checkin_toll_name, s.checkout_toll_name
            FROM detail_all d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id JOIN stage_closed s ON d.stage_id = s.stage_id"""),
        "period_attributes": days(f"""
            SELECT strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day, {QUARTER} AS quarter, {WEEK} AS week,
                   {DAY.format('d')} AS date_str FROM days"""),
        "partition_hour_filter": with_roles("detail_all", """
            SELECT year, month, day, hour, COUNT(*) AS n, CAST(SUM(price_amount) AS DOUBLE) AS amount FROM detail_all
            WHERE event_time >= TIMESTAMP '1997-09-30 17:00:00' AND event_time < TIMESTAMP '1997-12-31 17:00:00' GROUP BY ALL"""),
        "level_dispatch": f"""WITH {REGISTRY}
            SELECT job_type, CASE job_type WHEN '1' THEN 'day' WHEN '2' THEN 'week' WHEN '3' THEN 'month' WHEN '4' THEN 'quarter'
                   WHEN '5' THEN 'year' ELSE 'day' END AS time_level, COUNT(*) AS jobs FROM registry GROUP BY ALL""",
        "period_labels": days(f"""
            SELECT strftime(d, '%Y%m%d') || '00' AS datetime_id, {DAY.format('d')} AS date, {WEEK} AS week_id, strftime(d, '%Y-%m') AS month_id,
                   strftime(d, '%Y') || '-Q' || quarter(d) AS quarter_id, strftime(d, '%Y') AS year_id FROM days"""),
        "dim_date": days(f""",
            bounds AS (SELECT min(d) AS a, max(d) AS b FROM days),
            calendar AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
            SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, {DAY.format('d')} AS date_name, day(d) AS day, isodow(d) AS day_of_week,
                   dayofyear(d) AS day_of_year, {WEEK} AS week_id, weekofyear(d) AS week_of_year,
                   {DAY.format("date_trunc('week', d)")} AS week_start_date, {DAY.format("date_trunc('week', d) + INTERVAL 6 DAY")} AS week_end_date,
                   strftime(d, '%Y-%m') AS month_id, month(d) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short_name,
                   {DAY.format("date_trunc('month', d)")} AS month_start_date, {DAY.format('last_day(d)')} AS month_end_date,
                   strftime(d, '%Y') || '-Q' || quarter(d) AS quarter_id, quarter(d) AS quarter, {QUARTER} AS quarter_name,
                   {DAY.format("date_trunc('quarter', d)")} AS quarter_start_date,
                   {DAY.format("last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE))")} AS quarter_end_date,
                   strftime(d, '%Y') AS year_id, year(d) AS year FROM calendar"""),
        "csv_roundtrip": txn_revenue("day", "lane"),
        "csv_single_part": payment("checkout_channel AS payment_channel", level="month"),
        "normalize_partitions": with_roles("txn_all", f", {MART} SELECT * FROM mart"),
        "mart_overwrite": with_roles("txn_all", f", {MART} SELECT * REPLACE (CASE WHEN year = '1997' THEN n + 1000 ELSE n END AS n) FROM mart"),
        "mart_guard": with_roles("txn", f""", {MART}
            SELECT 'mart_rows' AS result, true AS to_mart, COUNT(*) AS n FROM mart
            UNION ALL SELECT 'payment_channel', false, COUNT(*) FROM (SELECT DISTINCT local_day, checkout_channel FROM txn)"""),
        "retention_expired": with_roles("txn_all", f", {MART} SELECT DISTINCT year, month, day FROM mart WHERE year || month || day <= '19990131'"),
        "full_refresh_counts": """SELECT COUNT(*) FILTER (o_orderstatus <> 'P') AS deleted, COUNT(*) AS inserted, COUNT(*) AS rows_after FROM orders""",
        "source_target_counts": """
            SELECT 'lineitem' AS table_name, s AS source_rows, t AS target_rows, s - t AS missing_rows
            FROM (SELECT COUNT(*) AS s FROM lineitem), (SELECT COUNT(*) AS t FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10))""",
        "clear_order": f"""
            WITH RECURSIVE edges AS ({edges}),
            chain(table_name, step) AS (SELECT DISTINCT child, 1 FROM edges
                UNION ALL SELECT e.parent, c.step + 1 FROM chain c JOIN edges e ON e.child = c.table_name)
            SELECT table_name, max(step) AS step FROM chain GROUP BY table_name""",
        "key_remap_inner": key_remap("inner"),
        "key_remap_left": key_remap("left"),
        "multi_code_lookup": f"""WITH {LINES}, {NATIONS}, {PARTS}
            SELECT l_orderkey, l_linenumber, p.id AS part_id, s_suppkey + 9000 AS supplier_id, coalesce(n.id, -1) AS nation_id,
                   n.title AS nation_title, m.id AS place_id
            FROM coded LEFT JOIN parts p ON p.code = part_code LEFT JOIN supplier ON s_suppkey = supplier_code
            LEFT JOIN nations n ON n.code = nation_code LEFT JOIN nations m ON m.code = trim(padded_code)""",
        "role_playing_lookup": f"WITH {NATIONS} SELECT o_orderkey, {grades} FROM orders {grade_joins}",
        "lookup_live_rows": f"""WITH {LINES}, {NATIONS}, {PARTS}
            SELECT l_orderkey, l_linenumber, part_code, coalesce(p.id, -1) AS part_id, coalesce(n.id, -1) AS nation_id
            FROM coded LEFT JOIN parts p ON p.code = part_code AND p.is_deleted = 0
            LEFT JOIN nations n ON n.code = nation_code AND n.is_deleted = 0""",
        "text_key_join": f"""WITH {LINES}
            SELECT l_orderkey, l_linenumber, padded_code, coalesce(s_suppkey + 9000, -1) AS supplier_id
            FROM coded LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = trim(padded_code)""",
        "explode_codes": f"""WITH {CODES}
            SELECT o_orderkey, unnest({TOKENS}) AS code FROM code_rows
            UNION ALL SELECT o_orderkey, NULL FROM code_rows WHERE codes IS NULL OR len({TOKENS}) = 0""",
        "code_list_by_position": code_list(True),
        "code_list_distinct": code_list(False),
        "normalize_date_text": f"""WITH {DATE_TEXTS}
            SELECT *, CASE WHEN regexp_full_match(date_text, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN strftime(try_strptime(date_text, '%d/%m/%Y'), '%Y-%m-%d')
                           WHEN regexp_full_match(date_text, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN date_text END AS iso_date,
                   CASE WHEN regexp_full_match(date_text, '\\d{{2}}/\\d{{2}}/\\d{{4}}')
                        THEN strftime(try_strptime(date_text, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') END AS start_time FROM texts""",
        "split_by_content": """
            SELECT c_custkey, CASE WHEN NOT regexp_matches(v, '\\p{L}') THEN v END AS id_number,
                   CASE WHEN regexp_matches(v, '\\p{L}') THEN v END AS passport
            FROM (SELECT c_custkey, coalesce(CASE c_custkey % 4 WHEN 0 THEN '0' || c_custkey WHEN 1 THEN 'Đ' || c_custkey END,
                         CASE WHEN c_custkey % 4 <> 3 THEN c_mktsegment || c_custkey END) AS v FROM customer)""",
        "compose_text": """
            SELECT o_orderkey, coalesce(a, '') || ', ' || coalesce(b, '') || ', ' || coalesce(c, '') AS address,
                   coalesce(a, '') || chr(10) || coalesce(b, '') AS remark
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS b,
                         CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS c FROM orders)""",
        "lenient_number": """
            SELECT o_orderkey, CAST(TRY_CAST(trim(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || 'x' WHEN 1 THEN CAST(o_orderkey AS VARCHAR)
                   WHEN 2 THEN ' ' || (o_orderkey % 100) || '.5 ' END) AS DECIMAL(18,4)) AS DOUBLE) AS number FROM orders""",
        "null_safe_arithmetic": """
            SELECT o_orderkey, CAST(total - coalesce(paid, 0) AS DOUBLE) AS left_to_pay, CAST(coalesce(paid, 0) + coalesce(extra, 0) AS DOUBLE) AS received
            FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
                         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,2)) END AS paid,
                         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(10 AS DECIMAL(18,2)) END AS extra FROM orders)""",
        "truncate_text": "SELECT doc_id, substring(text, 1, 1000) AS note FROM documents",
        "wrap_id": f"""WITH {LINES}, {NATIONS}
            SELECT l_orderkey, l_linenumber, '[' || coalesce(CAST(n.id AS VARCHAR), '') || ']' AS nation_list
            FROM coded LEFT JOIN nations n ON n.code = nation_code""",
        "header_detail_count": """
            SELECT o_orderkey, o_orderstatus, o_custkey, COUNT(l_orderkey) AS line_count
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY ALL""",
        "distinct_header_link": f"""WITH {HANDOVER},
            headers AS (SELECT giver, signed_on, rank, post, office_id, min(record_id) AS id FROM records GROUP BY ALL)
            SELECT r.record_id, h.id AS header_id FROM records r JOIN headers h ON r.giver = h.giver AND r.signed_on = h.signed_on
                   AND coalesce(r.rank, '##') = coalesce(h.rank, '##') AND coalesce(r.post, '##') = coalesce(h.post, '##')
                   AND coalesce(r.office_id, -1) = coalesce(h.office_id, -1)""",
        "id_map_detail": f"""WITH {HANDOVER},
            old AS (SELECT record_id AS old_id, giver, signed_on FROM records WHERE giver IS NOT NULL),
            new AS (SELECT giver, signed_on, min(old_id + 700000) AS new_id FROM old WHERE (old_id + 700000) % 2 = 0 GROUP BY ALL)
            SELECT new_id, l_partkey, l_linenumber FROM lineitem JOIN old ON old_id = l_orderkey
            JOIN new ON new.giver = old.giver AND new.signed_on = old.signed_on""",
        "multi_key_lookup": """
            SELECT o_orderkey, o_custkey AS person_id, year(o_orderdate) AS year_of, CAST(money AS DOUBLE) AS money
            FROM orders LEFT JOIN (SELECT o_custkey AS c, year(o_orderdate) AS y, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS money
                                   FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) ON c = o_custkey AND y = year(o_orderdate)""",
        "audit_columns": f"""WITH {PERSONS}, {NATIONS}
            SELECT o_orderkey AS id, new_id AS person_id, coalesce(n.id, -1) AS office_id, substring(o_orderpriority, 1, 5) AS note,
                   CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, TIMESTAMP '2024-06-01 12:00:00' AS creation_time,
                   '1' AS creator_user_id, CAST(NULL AS VARCHAR) AS last_modification_time, CAST(NULL AS VARCHAR) AS last_modifier_user_id,
                   0 AS is_deleted, CAST(NULL AS VARCHAR) AS deleter_user_id, CAST(NULL AS VARCHAR) AS deletion_time
            FROM orders JOIN keymap ON old_id = o_custkey
            LEFT JOIN nations n ON n.code = CAST(o_custkey % 27 AS VARCHAR) AND n.is_deleted = 0""",
        "cast_and_label": """
            SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year_text, 'Đợt đặc xá ' || strftime(o_orderdate, '%Y') AS round_name,
                   CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS reviewed_at FROM orders""",
        "dictionary_copy": """
            SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS title, 1 AS state, TIMESTAMP '2024-06-01 12:00:00' AS creation_time, 0 AS is_deleted
            FROM part""",
        "run_log_append": f"""WITH {RUN_LOG}
            SELECT id, job_name, CASE WHEN id % 3 = 1 THEN 'INFO' ELSE 'ERROR' END AS error_level,
                   CAST(least(8000, length(job_name) * (id % 1500)) AS BIGINT) AS message_length FROM run_log""",
        "latest_failed_runs": f"""WITH {HISTORY}
            SELECT * EXCLUDE rn FROM (SELECT *, {LATEST} AS rn FROM history) WHERE rn = 1 AND status = 'error' ORDER BY run_at DESC, id DESC""",
        "latest_success_runs": f"""WITH {HISTORY}
            SELECT * EXCLUDE rn FROM (SELECT *, {LATEST} AS rn FROM history WHERE status = 'success') WHERE rn = 1 ORDER BY run_at DESC, id DESC""",
        "job_history": f"WITH {HISTORY} SELECT * FROM history WHERE stmt_id = 7 ORDER BY run_at DESC, id DESC",
        "all_history": f"WITH {HISTORY} SELECT * FROM history ORDER BY run_at DESC, id DESC",
        "log_search_page": f"""WITH {RUN_LOG}, hits AS (SELECT * FROM run_log WHERE lower(coalesce(table_name, '')) LIKE '%click%')
            SELECT *, (SELECT COUNT(*) FROM hits) AS total, CAST(greatest(ceil((SELECT COUNT(*) FROM hits) / 50.0), 1) AS BIGINT) AS total_pages
            FROM hits ORDER BY id DESC LIMIT 50 OFFSET 50""",
        "log_search_deep_page": f"""WITH {RUN_LOG}
            SELECT *, (SELECT COUNT(*) FROM run_log) AS total, CAST(ceil((SELECT COUNT(*) FROM run_log) / 40.0) AS BIGINT) AS total_pages
            FROM run_log ORDER BY id DESC LIMIT 40 OFFSET 440""",
        "log_purge_date": f"WITH {RUN_LOG} SELECT * FROM run_log WHERE CAST(created_at AS DATE) <> DATE '2024-01-15'",
        "validate_job_rows": f"WITH {IMPORTED} SELECT * REPLACE (CAST(is_active AS VARCHAR) AS is_active), errors = '' AS valid FROM checked",
        "assign_ids": f"""WITH {IMPORTED}
            SELECT row_number, job_type, schema_name, table_name,
                   (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY row_number) AS id FROM checked WHERE errors = ''""",
        "job_preview": """
            SELECT id, CASE WHEN length(line) > 180 THEN substring(line, 1, 180) || '...' ELSE line END AS preview
            FROM (SELECT doc_id AS id, trim(replace(replace(text, chr(13), ''), chr(10), ' '), ' ') AS line FROM documents) ORDER BY id""",
        "top_500": f"WITH {HISTORY} SELECT * FROM history ORDER BY id DESC LIMIT 500",
        "bulk_delete_ids": f"""WITH {REGISTRY}
            SELECT id, job_type, table_name FROM registry
            WHERE id NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)""",
        "dedupe_pairs": """
            SELECT l_partkey AS target, l_suppkey AS source, l_orderkey, l_linenumber, copies
            FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS rn
                  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COUNT(*) AS copies FROM lineitem GROUP BY ALL)) WHERE rn = 1""",
    }
    channels, stages = payment("checkout_channel AS payment_channel", level="month"), summary_by_stage()
    out["run_batch_status"] = f"""
        WITH months AS (SELECT 'month 1995-01-01..2001-12-31' AS period, 'day 2030-01-01..2030-01-01' AS empty_day)
        SELECT 'payment_channel' AS job_name, period, 'success' AS status, (SELECT COUNT(*) FROM ({channels})) AS rows_inserted, 'csv' AS published FROM months
        UNION ALL SELECT 'transaction_summary', period, 'success', (SELECT COUNT(*) FROM (
            SELECT DISTINCT substr(date, 1, 7), vehicle_type, fare_category, route, entry_plaza, exit_plaza FROM ({stages}))), '' FROM months
        UNION ALL SELECT 'broken', period, 'error', 0, '' FROM months
        UNION ALL SELECT 'broken', empty_day, 'error', 0, '' FROM months
        UNION ALL SELECT unnest(['payment_channel', 'transaction_summary']), empty_day, 'empty', 0, '' FROM months"""
    for suffix, (level, column, own) in {
        "": ("year", "year_id", "1997"), "_quarter": ("quarter", "quarter_id", "1997-Q2"), "_month": ("month", "month_id", "1997-06"),
        "_day_date": ("day", "date", "1997-06-30"), "_day_datetime": ("day", "datetime_id", "1997063000"), "_time": ("day", "datetime_id", "1997063000"),
    }.items():
        out[f"replace_period{suffix}"] = f"""
            WITH target AS (SELECT {column}, route, vehicle_transaction_type, revenue_group, transaction_count, gross_revenue
                            FROM ({txn_revenue(level, 'route')}))
            SELECT * FROM target WHERE {column} <> '{own}'
            UNION ALL SELECT * REPLACE (CAST(0 AS BIGINT) AS transaction_count) FROM target
            WHERE {column} = '{own}' AND vehicle_transaction_type = 'ETC'"""
    out["run_batch_parallel"] = out["run_batch_status"]
    out["replace_partitioned"] = out["replace_period_month"]
    out["replace_days"] = with_roles("txn_all", f", {MART} SELECT * FROM mart WHERE year || month <> '199706' OR CAST(day AS INTEGER) % 2 = 0")
    out["published_manifest"] = f"""
        SELECT 'route_revenue' AS report, 'month' AS level, replace(month_id, '-', '') || '01' AS period, COUNT(*) AS rows
        FROM ({txn_revenue("month", "route")}) GROUP BY month_id"""
    out["retention_after_publish"] = f"""
        SELECT 'route_revenue' AS report, 'day' AS level, replace(date, '-', '') AS period, COUNT(*) AS rows
        FROM ({txn_revenue("day", "route")}) WHERE date BETWEEN '1997-04-01' AND '1997-04-30' GROUP BY date"""
    counts = {t: f"(SELECT COUNT(*) FROM {t})" for t in ("lineitem", "orders", "customer", "part")}
    out["clear_tables"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {step} AS step, {counts[t]} AS rows_deleted, CAST(0 AS BIGINT) AS rows_left"
        for step, t in enumerate(("lineitem", "orders", "customer"), 1)
    )
    out["cleared_tables"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {n if t == 'part' else 'CAST(0 AS BIGINT)'} AS rows_left" for t, n in counts.items()
    )
    out["cleared_tables_undone"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {n} AS rows_left" for t, n in counts.items())
    for level in LEVEL:
        out[f"utc_ranges_{level}"] = utc_ranges(level)
    return out
