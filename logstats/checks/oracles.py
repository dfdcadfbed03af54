"""SQL over the sample tables that gives what the queries of the same name give."""

from __future__ import annotations

from logstats import schemas
from logstats.checks.queries import FIRST_DAY, LAST_DAY
from logstats.checks.views import CODE_ROWS, TICK_TEXTS, WEIGHT_ROWS

_CODE = """CASE WHEN event_type = 'signup' THEN 'START' WHEN event_type = 'purchase' THEN 'STOP'
    WHEN event_type = 'view' THEN 'MON' WHEN event_type = 'click' THEN 'SVC'
    WHEN event_type = 'error' AND value >= 50 THEN 'SHUT' ELSE 'CRASH' END"""
_TIME = """CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.'
    || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')"""
_UNIT = "system_id, sw_rev, config"

_CODES = f"""
codes(error_code, description, action, level) AS (VALUES {CODE_ROWS}),
weights(level, wt) AS (VALUES {WEIGHT_ROWS})"""

_LOG = f"""{_CODES},
log AS (
    SELECT CAST(user_id AS VARCHAR) AS system_id,
        'R' || CAST(user_id % 3 AS VARCHAR) AS sw_rev,
        'C' || CAST(user_id % 2 AS VARCHAR) AS config,
        {_CODE} AS code, {_TIME} AS time_seq,
        CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS tick,
        event_id AS seq, event_id AS event_key,
        'tar' || CAST(event_id % 5 AS VARCHAR) AS file_name,
        strftime(ts, '%H:%M:%S') AS log_local_ts,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_message_ts,
        props AS msg_text, event_type AS source, strftime(ts, '%Y-%m-%d') AS msg_date
    FROM events
)"""


def _cut(log: str) -> str:
    """Segments and kept rows of the relation ``log``, by numbering and grouping segments."""
    return f"""
roles AS (
    SELECT error_code AS code, bool_or(action = 'Start') AS is_start,
        bool_or(action IN ('Stop', 'Disable')) AS is_stop,
        bool_or(action IN ('Start', 'Monitor', 'Stop', 'Enable', 'Disable')) AS is_mon,
        bool_or(description LIKE ' Service Exam%') AS is_service
    FROM codes GROUP BY error_code
),
numbered AS (
    SELECT *, row_number() OVER o AS rn, sum(CAST(is_start AS INTEGER)) OVER o AS seg,
        max(CASE WHEN is_service THEN tick END) OVER o AS service_tick
    FROM {log} JOIN roles USING (code)
    WINDOW o AS (PARTITION BY {_UNIT} ORDER BY tick, seq ROWS UNBOUNDED PRECEDING)
),
marked AS (
    SELECT *, is_start AND (service_tick IS NULL OR tick - service_tick >= 3600) AS opens
    FROM numbered
),
starts AS (
    SELECT {_UNIT}, seg, opens, tick AS exam_start, event_key AS start_event,
        md5(concat_ws('-', {_UNIT}, time_seq, CAST(event_key AS VARCHAR))) AS exam_id,
        lead(opens) OVER (PARTITION BY {_UNIT} ORDER BY seg) AS next_opens
    FROM marked WHERE is_start
),
ends AS (
    SELECT {_UNIT}, seg,
        min(CASE WHEN is_stop AND is_mon AND tick <= exam_start + 259200 THEN rn END) AS stop_rn,
        bool_or(is_mon AND tick > exam_start + 259200) AS has_late
    FROM marked JOIN starts USING ({_UNIT}, seg) GROUP BY {_UNIT}, seg
),
segments AS (
    SELECT *, CASE WHEN NOT opens THEN 'service' WHEN stop_rn IS NOT NULL THEN 'stopped'
        WHEN has_late THEN 'timed_out' WHEN next_opens THEN 'superseded'
        WHEN NOT next_opens THEN 'discarded_by_service' ELSE 'open_at_end' END AS outcome
    FROM starts JOIN ends USING ({_UNIT}, seg)
),
kept AS (
    SELECT marked.*, exam_id, exam_start
    FROM marked JOIN segments USING ({_UNIT}, seg)
    WHERE outcome IN ('stopped', 'timed_out', 'superseded') AND is_mon
        AND tick <= exam_start + 259200 AND (stop_rn IS NULL OR rn <= stop_rn)
),
once AS (
    SELECT * FROM kept QUALIFY 1 = row_number() OVER (
        PARTITION BY system_id, sw_rev, code, time_seq ORDER BY exam_start, tick, seq)
),
final AS (
    SELECT once.*, coalesce(c.level, '-1') AS mebef_level,
        coalesce(CAST(w.wt AS DOUBLE), CAST(-1 AS DOUBLE)) AS mebef_wt,
        strftime(make_timestamp(CAST(tick * 1000000 AS BIGINT)), '%Y%m%d') AS day
    FROM once LEFT JOIN codes c ON c.error_code = once.code
        LEFT JOIN weights w ON w.level = c.level
),
timed AS (
    SELECT *, max(tick) OVER e AS exam_dur_max, min(tick) OVER e AS exam_dur_min,
        max(tick) OVER e - min(tick) OVER e AS exam_dur_sec
    FROM final WINDOW e AS (PARTITION BY {_UNIT}, exam_id)
),
long AS (SELECT * FROM timed WHERE exam_dur_sec >= 180),
flagged AS (
    SELECT *, CAST(code = 'SHUT' AS INTEGER) AS actual_num_shutdowns,
        CAST(code = 'CRASH' AS INTEGER) AS actual_num_crashes,
        CAST(code IN ('SHUT', 'CRASH') AS INTEGER) AS ip_st
    FROM long
),
summed AS (
    SELECT *, CAST(sum(ip_st) OVER e AS BIGINT) AS sum_ipst,
        max(actual_num_shutdowns) OVER e AS any_shutdown,
        max(mebef_wt) OVER e AS exam_weight,
        row_number() OVER (PARTITION BY {_UNIT}, exam_id ORDER BY tick, seq) AS nth_of_exam,
        row_number() OVER (PARTITION BY {_UNIT} ORDER BY tick, seq) AS nth
    FROM flagged WINDOW e AS (PARTITION BY {_UNIT}, exam_id)
),
ruled AS (
    SELECT *, sum_ipst - actual_num_shutdowns AS num_shutdowns_day,
        CASE WHEN nth_of_exam = 1 THEN sum_ipst - any_shutdown ELSE 0 END AS exam_share
    FROM summed
),
totals AS (
    SELECT *, CAST(sum(exam_share) OVER m AS BIGINT) AS num_shutdowns,
        CAST(sum(num_shutdowns_day) OVER m AS BIGINT) AS row_shutdowns,
        count(*) FILTER (WHERE code = 'START') OVER m AS num_exams,
        count(*) FILTER (WHERE code = 'MON') OVER m AS num_tps_resets,
        sum(CASE WHEN nth_of_exam = 1 THEN exam_weight END) OVER m AS sum_weight,
        max(tick) OVER m AS last_tick, min(tick) OVER m AS first_tick
    FROM ruled WINDOW m AS (PARTITION BY {_UNIT})
),
report AS (
    SELECT system_id, 1000 * sum_weight / nullif(num_exams, 0) AS ipte_weighted,
        1000 * CAST(num_shutdowns AS DOUBLE) / nullif(num_exams, 0) AS ipte_severity,
        num_shutdowns, num_tps_resets, num_exams, last_tick AS time_seq_max,
        first_tick AS time_seq_min
    FROM totals WHERE nth = 1
)"""


_ROUNDED_REPORT = """SELECT system_id, round(ipte_weighted, 6) AS ipte_weighted,
    round(ipte_severity, 6) AS ipte_severity, num_shutdowns, num_tps_resets, num_exams,
    time_seq_max, time_seq_min FROM report"""
_TOTALS = """SELECT count(*) FILTER (WHERE num_shutdowns > 0) AS num_sys,
    CAST(sum(num_shutdowns) AS BIGINT) AS cum_shutdowns,
    CAST(sum(num_exams) AS BIGINT) AS cum_exams,
    round(1000 * CAST(sum(num_shutdowns) AS DOUBLE) / nullif(sum(num_exams), 0), 6) AS cum_ipte
    FROM report"""


def _log(body: str) -> str:
    return f"WITH {_LOG}\n{body}"


def _exams(body: str, more: str = "") -> str:
    return f"WITH {_LOG},{_cut('log')}{more}\n{body}"


_RAW_VALUES = {
    "tarfilename": "'tar' || CAST(event_id % 5 AS VARCHAR)",
    "inputfilename": "'sysfile'",
    "tar_systemid": "CAST(user_id AS VARCHAR)",
    "msg_text": "props",
    "msg_code": f"CASE WHEN event_id % 11 <> 0 THEN {_CODE} END",
    "msg_source": "event_type",
    "tag": "CASE WHEN event_id % 9 <> 0 THEN 't' END",
    "time_seq": f"CASE WHEN event_id % 17 = 0 THEN 'bad' ELSE {_TIME} END",
    "seq_num": "CAST(event_id AS VARCHAR)",
    "msg_date": "strftime(ts, '%Y-%m-%d')",
}
_RAW = f"""raw AS (
    SELECT {", ".join(f"{_RAW_VALUES.get(n, chr(39) + 'x' + chr(39))} AS {n}"
                      for n in schemas.MACHINE_LOG.names)}
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)
)"""


def _raw(body: str) -> str:
    return f"WITH {_RAW}\n{body}"


_LISTED = """listed AS (
    SELECT CAST(c_custkey AS VARCHAR) AS sysid FROM customer WHERE c_custkey % 2 = 0
)"""
_PREPARED_ROWS = """SELECT DISTINCT tar_systemid AS system_id, 'DV25.0_R02_1549.b' AS sw_rev,
        'MR750W' AS config, msg_code AS code, time_seq, TRY_CAST(time_seq AS DOUBLE) AS tick,
        CAST(seq_num AS BIGINT) AS seq, CAST(seq_num AS BIGINT) AS event_key,
        inputfilename AS file_name, msg_time AS log_local_ts, msg_datetime AS log_message_ts,
        msg_text, msg_source AS source, msg_date
    FROM raw WHERE tar_systemid IS NOT NULL AND msg_code IS NOT NULL AND time_seq IS NOT NULL"""
_PREPARED = f"prepared AS ({_PREPARED_ROWS})"
_FROM_FILES = f"""SELECT * FROM prepared WHERE tick IS NOT NULL
    AND msg_date BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}' AND system_id IN (FROM listed)"""

_PARTS = """parts AS (
    SELECT 'E' || CAST(p_partkey AS VARCHAR) AS error_code,
        ['Start: TPS Reset Started ', 'TPS Reset successful ', 'TPS Reset failed ',
         'Sytem shutdown ', 'System shutdown ', ' Service Exam ', 'Non Service Exam ',
         'Service Exam ', ''][p_partkey % 9 + 1] || p_name AS description,
        ['Start', 'Stop', 'Monitor', 'Enable', 'Disable', 'Ignore', 'start'][p_partkey % 7 + 1]
            AS action,
        'L' || CAST(p_size AS VARCHAR) AS level
    FROM part
)"""
_CATEGORIES = """categories AS (
    SELECT error_code, 'Stop' AS category FROM parts WHERE action IN ('Stop', 'Disable')
    UNION SELECT error_code, 'Start' FROM parts WHERE action = 'Start'
    UNION SELECT error_code, 'Monitor' FROM parts
        WHERE action IN ('Start', 'Monitor', 'Stop', 'Enable', 'Disable')
    UNION SELECT error_code, 'Ignore' FROM parts WHERE action = 'Ignore'
    UNION SELECT error_code, 'TPSResetStarted' FROM parts
        WHERE description LIKE '%TPS Reset Started%'
    UNION SELECT error_code, 'TPSResetSuccessful' FROM parts
        WHERE description LIKE '%TPS Reset successful%'
    UNION SELECT error_code, 'TPSResetFailed' FROM parts
        WHERE description LIKE '%TPS Reset failed%'
    UNION SELECT error_code, 'Shutdown' FROM parts WHERE description LIKE '%Sytem shutdown%'
    UNION SELECT error_code, 'ServiceExam' FROM parts WHERE description LIKE ' Service Exam%'
    UNION SELECT error_code, 'NonServiceExam' FROM parts
        WHERE description LIKE '%Non Service Exam%'
)"""

_TEXTS = ", ".join(f"'{text}'" for text in TICK_TEXTS)
_PLACE = "system_id, exam_id, event_key"
_RECORD = """system_id, sw_rev, file_name, log_local_ts, log_message_ts, code, exam_id, time_seq,
    source, 'psd' AS psd, 'coil' AS coil, 'scan' AS scan, config, msg_text, event_key"""

ORACLES: dict[str, str] = {
    "scan_machine_log": _raw("SELECT * FROM raw"),
    "scan_system_list": "SELECT CAST(c_custkey AS VARCHAR) AS sysid FROM customer",
    "scan_level_weights": """SELECT DISTINCT 'L' || CAST(p_size AS VARCHAR) AS level,
        CAST(p_size % 10 AS VARCHAR) || '.5' AS wt FROM part""",
    "scan_code_actions": f"WITH {_PARTS} SELECT error_code, description, action, level FROM parts",
    "report_roundtrip": _exams(_ROUNDED_REPORT),
    "run_report": f"""WITH {_CODES}, {_RAW}, {_LISTED}, {_PREPARED},
        chosen AS ({_FROM_FILES}),{_cut("chosen")}\n{_TOTALS}""",
    "run_diagnostics": f"""WITH {_CODES}, {_RAW}, {_LISTED}, {_PREPARED},
        chosen AS ({_FROM_FILES}),{_cut("chosen")}
        SELECT 'staged' AS stage, count(*) AS n FROM prepared
            WHERE msg_date BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}' AND system_id IN (FROM listed)
        UNION ALL SELECT 'in_exams', count(*) FROM kept
        UNION ALL SELECT 'num_exams', count(DISTINCT exam_id) FROM final
        UNION ALL SELECT 'num_systems', count(DISTINCT system_id) FROM final
        UNION ALL SELECT 'shutdown_rows', count(*) FROM final WHERE code = 'SHUT'
        UNION ALL SELECT 'crash_rows', count(*) FROM final WHERE code = 'CRASH'
        UNION ALL SELECT 'weight_one_rows', count(*) FROM final WHERE mebef_wt = 1
        UNION ALL SELECT 'short_rows', count(*) FROM timed WHERE exam_dur_sec < 180
        UNION ALL SELECT 'long_rows', count(*) FROM timed WHERE exam_dur_sec >= 180
        UNION ALL SELECT 'all_rows', count(*) FROM timed
        UNION ALL SELECT 'short_exams', count(DISTINCT exam_id) FROM timed WHERE exam_dur_sec < 180
        UNION ALL SELECT 'long_exams', count(DISTINCT exam_id) FROM timed WHERE exam_dur_sec >= 180
        UNION ALL SELECT 'all_exams', count(DISTINCT exam_id) FROM timed""",
    "run_report_literal": f"""WITH {_CODES}, {_RAW},
        prepared AS ({_PREPARED_ROWS} AND tag IS NOT NULL AND CAST(seq_num AS BIGINT) % 13 <> 0),
        chosen AS (SELECT * FROM prepared WHERE tick IS NOT NULL),{_cut("chosen")}
        SELECT count(*) FILTER (WHERE row_shutdowns > 0) AS num_sys,
            CAST(sum(row_shutdowns) AS BIGINT) AS cum_shutdowns, count(*) AS cum_exams,
            round(1000 * CAST(sum(row_shutdowns) AS DOUBLE) / count(*), 6) AS cum_ipte
        FROM totals WHERE nth = 1""",
    "report_of_staged_days": f"""WITH {_LOG}, days AS (
            SELECT * FROM log WHERE msg_date BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}'),{_cut("days")}
        {_ROUNDED_REPORT}""",
    "quarantine_counts": _raw(
        """SELECT CASE WHEN CAST(seq_num AS BIGINT) % 23 = 0 THEN 'quote'
            WHEN CAST(seq_num AS BIGINT) % 13 = 0 THEN 'short'
            WHEN CAST(seq_num AS BIGINT) % 19 = 0 THEN 'long' ELSE 'good' END AS fault,
            count(*) AS n
        FROM raw GROUP BY fault"""
    ),
    "distinct_counts_by_sketch": _exams(
        f"""SELECT count(DISTINCT exam_id) AS num_exams, count(DISTINCT system_id) AS num_systems,
            TRUE AS near_num_exams, TRUE AS near_num_systems
        FROM final WHERE day BETWEEN '{FIRST_DAY.replace("-", "")}' AND '{LAST_DAY.replace("-", "")}'"""
    ),
    "late_rows": _log(
        f"""SELECT log.system_id, log.event_key FROM log
            JOIN (SELECT user_id FROM events WHERE ts < TIMESTAMP '{LAST_DAY}' GROUP BY user_id) s
            ON CAST(s.user_id AS VARCHAR) = log.system_id
        WHERE msg_date < '{LAST_DAY}' AND event_key % 7 = 0"""
    ),
    "drop_columns": _raw("SELECT * EXCLUDE (dummy, tarfilename) FROM raw"),
    "filter_dates": _log(
        f"""SELECT system_id, event_key, msg_date FROM log
        WHERE msg_date >= '{FIRST_DAY}' AND msg_date <= '{LAST_DAY}'"""
    ),
    "filter_dates_open": _log(
        f"""SELECT 'early' AS part, system_id, event_key, msg_date FROM log
        WHERE msg_date <= '{FIRST_DAY}'
        UNION ALL SELECT 'late', system_id, event_key, msg_date FROM log
        WHERE msg_date >= '{LAST_DAY}'"""
    ),
    "filter_dates_literal": _log("SELECT system_id, event_key, msg_date FROM log"),
    "filter_systems": f"""WITH {_RAW}, {_LISTED}
        SELECT tar_systemid, seq_num, msg_code FROM raw WHERE tar_systemid IN (FROM listed)""",
    "filter_systems_literal": _raw("SELECT tar_systemid, seq_num, msg_code FROM raw"),
    "dedup_rows": _raw("SELECT DISTINCT * FROM raw"),
    "drop_incomplete": _raw(
        """SELECT tar_systemid, seq_num, msg_code, tag FROM raw
        WHERE msg_code IS NOT NULL AND tar_systemid IS NOT NULL AND time_seq IS NOT NULL"""
    ),
    "drop_incomplete_literal": _raw(
        "SELECT tar_systemid, seq_num, msg_code, tag FROM raw WHERE "
        + " AND ".join(f"{name} IS NOT NULL" for name in schemas.MACHINE_LOG.names)
    ),
    "clean_log": _raw(
        """SELECT DISTINCT * EXCLUDE (dummy) FROM raw
        WHERE msg_code IS NOT NULL AND tar_systemid IS NOT NULL AND time_seq IS NOT NULL"""
    ),
    "add_constants": _raw(
        """SELECT tar_systemid, seq_num, 'MR750W' AS config,
        'DV25.0_R02_1549.b' AS software_rev FROM raw"""
    ),
    "distinct_units": _raw(
        """SELECT DISTINCT tar_systemid, 'DV25.0_R02_1549.b' AS software_rev,
        'MR750W' AS config FROM raw"""
    ),
    "prepare_log": f"WITH {_RAW}, {_PREPARED} SELECT * EXCLUDE (event_key) FROM prepared",
    "dedup_events": _exams(
        f"""SELECT {_PLACE}, code, time_seq FROM (
            SELECT * FROM kept UNION ALL
            SELECT * REPLACE ('copy' AS exam_id, exam_start + 1 AS exam_start) FROM kept
            WHERE event_key % 10 = 0)
        QUALIFY 1 = row_number() OVER (
            PARTITION BY system_id, sw_rev, code, time_seq ORDER BY exam_start, tick, seq)"""
    ),
    "drop_blank_exam": _exams(f"SELECT {_PLACE} FROM kept WHERE event_key % 10 <> 0"),
    "code_categories": f"WITH {_PARTS}, {_CATEGORIES} SELECT * FROM categories",
    "code_catalog": f"""WITH {_PARTS}, {_CATEGORIES}
        SELECT category, string_agg(error_code, ',' ORDER BY error_code) AS error_codes
        FROM categories GROUP BY category""",
    "code_catalog_blocks": f"""WITH {_PARTS}, {_CATEGORIES}, numbered AS (
            SELECT *, CAST((row_number() OVER (PARTITION BY category ORDER BY error_code) - 1) // 50
                AS INTEGER) AS block FROM categories)
        SELECT category, block, string_agg(error_code, ',' ORDER BY error_code) AS error_codes
        FROM numbered GROUP BY category, block""",
    "code_roles": f"""WITH {_PARTS}
        SELECT error_code AS code, bool_or(action = 'Start') AS is_start,
            bool_or(action IN ('Stop', 'Disable')) AS is_stop,
            bool_or(action NOT IN ('Ignore', 'start')) AS is_monitored,
            bool_or(starts_with(description, ' Service Exam')) AS is_service
        FROM parts GROUP BY error_code HAVING is_start OR is_monitored OR is_service""",
    "attach_level": _exams(
        f"""SELECT {_PLACE}, code, CASE code WHEN 'START' THEN 'L1' WHEN 'STOP' THEN 'L1'
            WHEN 'SHUT' THEN 'L3' WHEN 'CRASH' THEN 'L4' ELSE '-1' END AS mebef_level
        FROM kept"""
    ),
    "attach_weight": _exams(
        f"""SELECT {_PLACE}, level AS mebef_level,
            CAST(CASE level WHEN 'L1' THEN 0.0 WHEN 'L3' THEN 0.5 WHEN 'L4' THEN 1.0 ELSE -1.0
            END AS DOUBLE) AS mebef_wt
        FROM kept JOIN codes ON error_code = code"""
    ),
    "parse_ticks": f"""WITH {_RAW}, texts AS (
            SELECT seq_num, coalesce([{_TEXTS}][CAST(seq_num AS BIGINT) % 29 + 1], time_seq)
                AS time_seq FROM raw
        ), ticks AS (
            SELECT *, TRY_CAST(regexp_replace(time_seq, '[\\s+]*', '') AS DOUBLE) AS tick FROM texts
            WHERE regexp_full_match(time_seq,
                '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
        )
        SELECT * FROM ticks WHERE isfinite(tick)""",
    "service_starts": _exams(
        f"""SELECT {_UNIT}, exam_id, start_event, exam_start FROM segments
        WHERE outcome = 'service'"""
    ),
    "exam_segments": _exams(
        f"SELECT {_UNIT}, exam_id, start_event, exam_start, outcome FROM segments"
    ),
    "exam_events": _exams(f"SELECT {_RECORD}, exam_start FROM kept"),
    "exam_records": _exams(f"SELECT {_RECORD}, mebef_level, mebef_wt FROM final"),
    "exam_summary": _exams(
        f"""SELECT {_UNIT}, exam_id, min(tick) AS exam_first, max(tick) AS exam_last,
            count(*) AS num_rows
        FROM kept GROUP BY {_UNIT}, exam_id"""
    ),
    "event_day": "SELECT event_id AS event_key, strftime(ts, '%Y%m%d') AS day FROM events",
    "incident_flags": _exams(
        f"""SELECT {_PLACE}, code, actual_num_shutdowns, actual_num_crashes,
            actual_num_shutdowns + actual_num_crashes AS sum_shutdown_crashes, ip_st
        FROM flagged"""
    ),
    "subtraction_rule": _exams(f"SELECT {_PLACE}, sum_ipst, num_shutdowns_day FROM ruled"),
    "sevone": _exams(
        f"""SELECT {_UNIT}, exam_id, CAST(sum(ip_st) AS BIGINT) AS sum_ipst,
            CAST(sum(actual_num_shutdowns) AS BIGINT) AS shutdowns,
            CAST(sum(ip_st) - CAST(sum(actual_num_shutdowns) > 1 AS INTEGER) AS BIGINT) AS sevone
        FROM flagged GROUP BY {_UNIT}, exam_id"""
    ),
    "sevone_literal": _exams(
        f"""SELECT {_UNIT}, exam_id, CAST(sum(ip_st) AS BIGINT) AS sum_ipst,
            CAST(sum(actual_num_shutdowns) AS BIGINT) AS shutdowns,
            CAST(sum(ip_st) AS BIGINT) AS sevone
        FROM flagged GROUP BY {_UNIT}, exam_id"""
    ),
    "ipte_rate": _log(
        """SELECT *, round(1000 * CAST(crashes AS DOUBLE) / nullif(starts, 0), 6) AS rate FROM (
            SELECT system_id, count(*) FILTER (WHERE code = 'CRASH') AS crashes,
                count(*) FILTER (WHERE code = 'START') AS starts
            FROM log GROUP BY system_id)"""
    ),
    "exam_duration": _exams(
        f"SELECT {_PLACE}, day, exam_dur_max, exam_dur_min, exam_dur_sec FROM timed"
    ),
    "exams_long": _exams(f"SELECT {_PLACE}, exam_dur_sec FROM timed WHERE exam_dur_sec >= 180"),
    "exams_short": _exams(f"SELECT {_PLACE}, exam_dur_sec FROM timed WHERE exam_dur_sec < 180"),
    "rank_duration": _exams(
        f"""SELECT {_PLACE}, hours AS exam_dur_sec, 1 AS rank_val FROM (
            SELECT *, floor((tick - exam_dur_min) / 3600) AS hours FROM timed)
        QUALIFY 1 = rank() OVER (PARTITION BY {_UNIT}, exam_id ORDER BY hours DESC)"""
    ),
    "time_lag": _exams(
        f"""SELECT {_PLACE}, tick, lag(tick) OVER (
            PARTITION BY {_UNIT}, exam_id ORDER BY tick, seq) AS time_seq_lag FROM kept"""
    ),
    "exam_incidents": _exams(f"SELECT {_PLACE}, ip_st, sum_ipst FROM summed"),
    "total_shutdowns": _exams(f"SELECT {_PLACE}, num_shutdowns_day, num_shutdowns FROM totals"),
    "total_shutdowns_literal": _exams(
        f"SELECT {_PLACE}, num_shutdowns_day, row_shutdowns AS num_shutdowns FROM totals"
    ),
    "shutdown_crash_counts": _exams(
        f"""SELECT {_PLACE}, day, CAST(code = 'SHUT' AS BIGINT) AS actual_num_shutdowns,
            CAST(code = 'CRASH' AS BIGINT) AS actual_num_crashes FROM long"""
    ),
    "shutdown_crash_counts_exam_day": _exams(
        f"""SELECT {_PLACE}, day, count(*) FILTER (WHERE code = 'SHUT') OVER d
                AS actual_num_shutdowns,
            count(*) FILTER (WHERE code = 'CRASH') OVER d AS actual_num_crashes
        FROM long WINDOW d AS (PARTITION BY {_UNIT}, day, exam_id)"""
    ),
    "shutdown_crash_counts_literal": _exams(
        f"""SELECT {_PLACE}, day, CAST(1 AS BIGINT) AS actual_num_shutdowns,
            CAST(1 AS BIGINT) AS actual_num_crashes FROM long"""
    ),
    "ipte": _exams(
        f"""SELECT {_UNIT}, event_key, num_exams, num_shutdowns AS num_sev1,
            round(1000 * CAST(num_shutdowns AS DOUBLE) / nullif(num_exams, 0), 6) AS ipte_severity
        FROM totals WHERE nth = 1"""
    ),
    "ipte_literal": _exams(
        f"""SELECT {_UNIT}, event_key, CAST(1 AS BIGINT) AS num_exams, row_shutdowns AS num_sev1,
            1000 * CAST(row_shutdowns AS DOUBLE) AS ipte_severity
        FROM totals WHERE nth = 1"""
    ),
    "ipte_weighted": _exams(
        f"""SELECT {_UNIT}, event_key, round(sum_weight, 6) AS sum_max_wt_all_exams,
            round(1000 * sum_weight / nullif(num_exams, 0), 6) AS ipte_weighted
        FROM totals WHERE nth = 1"""
    ),
    "ipte_weighted_literal": _exams(
        f"""SELECT {_UNIT}, event_key, round(mebef_wt, 6) AS sum_max_wt_all_exams,
            round(1000 * mebef_wt, 6) AS ipte_weighted
        FROM totals WHERE nth = 1"""
    ),
    "additional_stats": _exams(
        f"""SELECT {_PLACE}, num_tps_resets, first_tick AS time_seq_min,
            last_tick AS time_seq_max FROM totals"""
    ),
    "additional_stats_literal": _exams(
        f"""SELECT {_PLACE}, count(*) OVER t AS num_tps_resets, count(*) OVER t AS time_seq_min,
            count(*) OVER t AS time_seq_max
        FROM long WINDOW t AS (PARTITION BY {_UNIT} ORDER BY tick)"""
    ),
    "top_row_per_machine": _exams(
        f"""SELECT {_UNIT}, event_key, CAST(floor(exam_dur_sec / 3600) AS BIGINT)
                AS ipte_severity, 1 AS row_num
        FROM timed QUALIFY 1 = row_number() OVER (
            PARTITION BY {_UNIT} ORDER BY floor(exam_dur_sec / 3600) DESC, tick, seq)"""
    ),
    "stage_counts": f"""WITH {_RAW}, {_LOG},{_cut("log")},
        unique_rows AS (SELECT DISTINCT * FROM raw)
        SELECT 'read' AS stage, count(*) AS n FROM raw
        UNION ALL SELECT 'deduplicated', count(*) FROM unique_rows
        UNION ALL SELECT 'complete', count(*) FROM unique_rows WHERE msg_code IS NOT NULL
            AND tar_systemid IS NOT NULL AND time_seq IS NOT NULL
        UNION ALL SELECT 'in_exams', count(*) FROM kept
        UNION ALL SELECT 'events_deduplicated', count(*) FROM once
        UNION ALL SELECT 'in_long_exams', count(*) FROM long""",
    "run_metrics": _exams(
        """SELECT count(*) FILTER (WHERE code = 'SHUT') AS shutdown_rows,
            count(*) FILTER (WHERE code = 'CRASH') AS crash_rows,
            count(*) FILTER (WHERE mebef_wt = 1) AS weight_one_rows FROM final"""
    ),
    "distinct_counts": _exams(
        """SELECT count(DISTINCT exam_id) AS num_exams, count(DISTINCT system_id) AS num_systems
        FROM final"""
    ),
    "duration_stats": _exams(
        """SELECT count(*) FILTER (WHERE exam_dur_sec < 180) AS short_rows,
            count(*) FILTER (WHERE exam_dur_sec >= 180) AS long_rows, count(*) AS all_rows,
            count(DISTINCT exam_id) FILTER (WHERE exam_dur_sec < 180) AS short_exams,
            count(DISTINCT exam_id) FILTER (WHERE exam_dur_sec >= 180) AS long_exams,
            count(DISTINCT exam_id) AS all_exams FROM timed"""
    ),
    "fleet_shutdowns": _exams(
        "SELECT CAST(sum(num_shutdowns) AS BIGINT) AS fleet_shutdowns FROM totals"
    ),
    "fleet_shutdowns_literal": _exams(
        "SELECT CAST(sum(row_shutdowns) AS BIGINT) AS fleet_shutdowns FROM totals"
    ),
    "sum_by_key": _exams(
        """SELECT num_exams, CAST(sum(num_exams) AS BIGINT) AS sum_num_exams,
            CAST(sum(num_shutdowns) AS BIGINT) AS sum_num_shutdowns,
            CAST(sum(num_tps_resets) AS BIGINT) AS sum_num_tps_resets
        FROM report GROUP BY num_exams"""
    ),
    "machine_report": _exams(_ROUNDED_REPORT),
    "machine_report_literal": _exams(
        """SELECT system_id, round(1000 * mebef_wt, 6) AS ipte_weighted,
            1000 * CAST(row_shutdowns AS DOUBLE) AS ipte_severity,
            row_shutdowns AS num_shutdowns, CAST(1 AS BIGINT) AS num_tps_resets,
            CAST(1 AS BIGINT) AS num_exams, CAST(1 AS DOUBLE) AS time_seq_max,
            CAST(1 AS DOUBLE) AS time_seq_min
        FROM totals WHERE nth = 1"""
    ),
    "cumulative_ipte": _exams(_TOTALS),
    "running_total_nulls": _log(
        """SELECT machine, tick, event_key, value, CAST(sum(value) OVER (
            PARTITION BY machine ORDER BY tick, event_key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
        FROM (SELECT *, CASE WHEN event_key % 5 <> 0 THEN system_id END AS machine,
            CASE WHEN event_key % 3 <> 0 THEN event_key % 7 END AS value FROM log)"""
    ),
}
ORACLES["stepwise_report"] = ORACLES["machine_report"]
ORACLES["stepwise_report_literal"] = ORACLES["machine_report_literal"]
ORACLES["exam_events_staged"] = ORACLES["exam_events_staged_chunked"] = ORACLES["exam_events"]
ORACLES["report_published"] = ORACLES["report_roundtrip"]
ORACLES["dedup_rows_by_load"] = ORACLES["dedup_rows"]
# Cut period by period, what one cut gives.
for _name in ("exam_segments", "exam_events"):
    ORACLES[f"{_name}_by_period"] = ORACLES[_name]
ORACLES["exam_segments_by_period_chunked"] = ORACLES["exam_segments"]
# Machines cut into chunks give what whole machines give.
for _name in (
    "run_report",
    "run_diagnostics",
    "exam_segments",
    "exam_events",
    "machine_report",
    "time_lag",
    "additional_stats_literal",
    "stepwise_report",
):
    ORACLES[f"{_name}_chunked"] = ORACLES[_name]
