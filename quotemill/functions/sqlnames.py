"""The column functions under SQL names, so that SQL and DataFrame users share them.

Each is a temporary SQL function with a native body: Catalyst inlines it, nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quotemill.functions.numbers import UNIT_FACTORS
from quotemill.functions.times import PERIOD_ALL, PERIOD_DAYS

_FACTORS = " ".join(f"WHEN '{unit}' THEN {factor}D" for unit, factor in UNIT_FACTORS.items())
_UNITS = ", ".join(f"'{unit}'" for unit in UNIT_FACTORS)
_PERIODS = " ".join(f"WHEN date_diff(CAST(as_of AS DATE), max_date) <= {days} THEN '{name}'" for name, days in PERIOD_DAYS.items())
_BLANK = r"(?U)[\\s\\x1c-\\x1f]+"
_SESSION = "STRUCT<open_local: STRING, close_local: STRING"


def _clock(text: str) -> str:
    """The 24-hour clock of a text. Written out where a lambda needs it: those call no SQL functions."""
    clock = f"upper(trim({text}))"
    shape = r"'^\\d{1,2}:\\d{2} [AP]M$'"
    return f"date_format(try_to_timestamp(CASE WHEN rlike({clock}, {shape}) THEN {clock} END, 'h:mm a'), 'HH:mm')"


_DECIMAL = r"(?U)^\\s*([+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\\s*$"

# name -> (arguments, return type, body)
SQL_FUNCTIONS = {
    "qm_plain_number": ("s STRING", "DOUBLE", rf"try_cast(nullif(regexp_extract(s, '{_DECIMAL}', 1), '') AS DOUBLE)"),
    "qm_clean_number": ("s STRING", "DOUBLE", "qm_plain_number(translate(s, ',', ''))"),
    "qm_clean_numeric": ("s STRING, factor DOUBLE", "DOUBLE", "factor * qm_clean_number(s)"),
    "qm_clean_varpc": ("s STRING", "DOUBLE", "qm_clean_number(translate(s, '()%', ''))"),
    "qm_fix_minus": ("s STRING", "STRING", "translate(s, '−', '-')"),
    "qm_percent_fraction": ("s STRING", "DOUBLE", "qm_clean_varpc(qm_fix_minus(s)) / 100.0D"),
    "qm_suffix_number": (
        "s STRING",
        "DOUBLE",
        r"qm_clean_number(regexp_replace(trim(s), '\\s*[KMBT]$', '')) * CASE regexp_extract(trim(s), '([KMBT])$', 1) "
        "WHEN 'K' THEN 1e3D WHEN 'M' THEN 1e6D WHEN 'B' THEN 1e9D WHEN 'T' THEN 1e12D ELSE 1D END",
    ),
    "qm_clean_dash": ("s STRING", "STRING", "qm_fix_minus(nullif(s, '—'))"),
    "qm_dollar_number": ("s STRING", "DOUBLE", "qm_plain_number(translate(s, '$,', ''))"),
    "qm_digits_only": ("s STRING", "BIGINT", "try_cast(nullif(regexp_replace(s, '[^0-9]', ''), '') AS BIGINT)"),
    "qm_country_key": ("s STRING", "STRING", "translate(lower(s), ' -()', '__')"),
    "qm_ascii_only": ("s STRING", "STRING", r"regexp_replace(s, '[^\\x00-\\x7F]+', '')"),
    "qm_standardize_date": (
        "s STRING",
        "STRING",
        "CASE WHEN rlike(trim(s), '^[0-9]+-[0-9]+$') THEN concat(trim(s), '-01') ELSE trim(s) END",
    ),
    "qm_parse_date": ("s STRING, pattern STRING", "DATE", "CAST(try_to_timestamp(s, pattern) AS DATE)"),
    "qm_clock24": ("s STRING", "STRING", _clock("s")),
    "qm_extract_word": (
        "s STRING, i INT, delimiter STRING",
        "STRING",
        f"CASE WHEN delimiter = '' THEN nullif(try_element_at(split(regexp_replace(s, '(?U)^{_BLANK[4:]}', ''), '{_BLANK}'), i), '') "
        r"ELSE try_element_at(split(s, concat('\\Q', replace(delimiter, '\\E', '\\E\\\\E\\Q'), '\\E')), i) END",
    ),
    "qm_first_token": ("s STRING, delimiter STRING", "STRING", "substring_index(s, delimiter, 1)"),
    "qm_unit_factor": ("unit STRING", "DOUBLE", f"CASE unit {_FACTORS} ELSE 1D END"),
    "qm_capitals": ("s STRING", "STRING", "regexp_extract(s, '[A-Z]*$', 0)"),
    "qm_money_unit": (
        "letters STRING",
        "STRING",
        f"CASE WHEN length(letters) IN (1, 4) AND left(letters, 1) IN ({_UNITS}) THEN left(letters, 1) ELSE '' END",
    ),
    "qm_money_parts": (
        "packed STRING, letters STRING, unit STRING",
        "STRUCT<value: DOUBLE, currency: STRING>",
        "named_struct('value', qm_plain_number(left(packed, length(packed) - length(letters))) * qm_unit_factor(unit), 'currency', "
        "CASE WHEN qm_plain_number(left(packed, length(packed) - length(letters))) IS NOT NULL "
        "THEN right(letters, length(letters) - length(unit)) END)",
    ),
    "qm_money_packed": ("s STRING", "STRING", r"translate(qm_fix_minus(s), '\u202f\u00a0 ,', '')"),
    "qm_money_text": (
        "s STRING",
        "STRUCT<value: DOUBLE, currency: STRING>",
        "qm_money_parts(qm_money_packed(s), qm_capitals(qm_money_packed(s)), qm_money_unit(qm_capitals(qm_money_packed(s))))",
    ),
    "qm_price_parts": (
        "s STRING",
        "STRUCT<price: DOUBLE, currency: STRING>",
        "named_struct('price', qm_plain_number(regexp_replace(CASE WHEN rlike(right(s, 3), '^[A-Z]{3}$') "
        "THEN left(s, length(s) - 3) ELSE s END, '[^0-9.+-]', '')), "
        "'currency', CASE WHEN rlike(right(s, 3), '^[A-Z]{3}$') THEN right(s, 3) END)",
    ),
    "qm_price_ccy": ("s STRING", "STRUCT<price: DOUBLE, currency: STRING>", "qm_price_parts(trim(qm_fix_minus(s)))"),
    "qm_change_pct": (
        "s STRING",
        "STRUCT<change: DOUBLE, varpc: DOUBLE>",
        "named_struct('change', qm_plain_number(get(split(s, '[(%]'), 0)), 'varpc', "
        "qm_plain_number(CASE WHEN size(split(s, '[(%]')) > 2 THEN get(split(s, '[(%]'), 1) END))",
    ),
    "qm_int_or_zero": ("s STRING", "BIGINT", "coalesce(try_cast(qm_plain_number(s) AS BIGINT), 0L)"),
    "qm_fixed_decimals": ("x DOUBLE, digits INT", "STRING", "CASE WHEN x IS NOT NULL THEN format_string(concat('%.', digits, 'f'), x) END"),
    "qm_symbol_split": (
        "s STRING",
        "STRUCT<ticker: STRING, name: STRING>",
        r"named_struct('ticker', coalesce(get(split(s, '\n'), 0), ''), 'name', coalesce(get(split(s, '\n'), 1), ''))",
    ),
    "qm_code_map": ("s STRING, codes MAP<STRING, STRING>, otherwise STRING", "STRING", "coalesce(try_element_at(codes, s), otherwise)"),
    "qm_country_slug": ("s STRING", "STRING", "translate(lower(s), ' ', '-')"),
    "qm_epoch_seconds": ("n DECIMAL(20, 6)", "TIMESTAMP_NTZ", "CAST(timestamp_seconds(n) AS TIMESTAMP_NTZ)"),
    "qm_epoch_millis": ("n BIGINT", "TIMESTAMP_NTZ", "CAST(timestamp_millis(n) AS TIMESTAMP_NTZ)"),
    "qm_zone_shift": (
        "at TIMESTAMP_NTZ, gmtoffset DOUBLE, hour_adjust DOUBLE",
        "TIMESTAMP_NTZ",
        "at + make_dt_interval(0, 0, 0, CAST(CASE WHEN gmtoffset > 0 THEN gmtoffset ELSE hour_adjust * 3600 END AS DECIMAL(18, 6)))",
    ),
    "qm_standardize_datetime": (
        "s STRING, zone STRING, pattern STRING",
        "STRING",
        "date_format(convert_timezone('UTC', zone, CAST(try_to_timestamp(s) AS TIMESTAMP_NTZ)), pattern)",
    ),
    "qm_long_date": (
        "s STRING",
        "DATE",
        "qm_parse_date(CASE WHEN size(split(s, ',')) = 3 THEN concat(trim(get(split(s, ','), 1)), ', ', trim(get(split(s, ','), 2))) END, "
        "'MMMM d, yyyy')",
    ),
    "qm_sessions": (
        "s STRING",
        "ARRAY<STRUCT<opens: STRING, closes: STRING>>",
        "filter(transform(split(s, ','), e -> named_struct("
        f"'opens', {_clock("get(split(e, ' - '), 0)")}, 'closes', {_clock("get(split(e, ' - '), 1)")})), "
        "c -> c.opens IS NOT NULL AND c.closes IS NOT NULL)",
    ),
    "qm_session_text": (
        "s STRING",
        f"{_SESSION}, timezone: STRING>",
        "named_struct('open_local', get(qm_sessions(substring_index(s, '(', 1)), 0).opens, "
        "'close_local', try_element_at(qm_sessions(substring_index(s, '(', 1)), -1).closes, "
        "'timezone', CASE WHEN contains(s, '(') AND contains(substring_index(s, '(', -1), ')') "
        "THEN substring_index(substring_index(s, '(', -1), ')', 1) END)",
    ),
    "qm_open_line": (
        "s STRING",
        "STRING",
        r"CASE WHEN contains(substring_index(substring_index(qm_ascii_only(s), '\n', 1), ',', 1), 'Open') "
        r"THEN substring_index(qm_ascii_only(s), '\n', 1) END",
    ),
    "qm_holiday_session": (
        "s STRING",
        f"{_SESSION}>",
        "named_struct('open_local', get(qm_sessions(qm_open_line(s)), 0).opens, "
        "'close_local', try_element_at(qm_sessions(qm_open_line(s)), -1).closes)",
    ),
    "qm_hhmm": ("at TIMESTAMP_NTZ", "STRING", "date_format(at, 'HH:mm')"),
    "qm_first_ten": ("s STRING", "STRING", "left(s, 10)"),
    "qm_last_trading_day": (
        "now TIMESTAMP_NTZ, target_hour INT",
        "DATE",
        "CASE WHEN target_hour < hour(now) "
        "THEN date_sub(CAST(now AS DATE), CASE weekday(CAST(now AS DATE)) WHEN 6 THEN 2 WHEN 0 THEN 3 ELSE 1 END) "
        "ELSE date_add(CAST(now AS DATE), CASE weekday(CAST(now AS DATE)) WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 0 END) END",
    ),
    "qm_fetch_period": (
        "as_of TIMESTAMP_NTZ, max_date DATE",
        "STRING",
        f"CASE WHEN max_date IS NULL THEN '{PERIOD_ALL}' WHEN date_diff(CAST(as_of AS DATE), max_date) <= 0 THEN NULL {_PERIODS} ELSE '{PERIOD_ALL}' END",
    ),
    "qm_asset_flag": ("kind STRING", "STRING", "CASE WHEN kind = 'index' THEN 'IND' ELSE 'STK' END"),
    "qm_after_close": (
        "now TIMESTAMP_NTZ, trading_day DATE, closing STRING",
        "BOOLEAN",
        "date_format(now, 'HH:mm') >= closing OR CAST(now AS DATE) > trading_day",
    ),
    "qm_json_default": ("body STRING, path STRING, otherwise STRING", "STRING", "coalesce(get_json_object(body, path), otherwise)"),
    "qm_key_and_rest": (
        "s STRING",
        "STRUCT<key: STRING, value: STRING>",
        r"named_struct('key', get(split(s, '\n'), 0), 'value', "
        r"CASE WHEN size(split(s, '\n')) > 1 THEN array_join(slice(split(s, '\n'), 2, size(split(s, '\n'))), ' ') END)",
    ),
    "qm_one_line": ("s STRING", "STRING", r"array_join(split(s, '\r?\n'), ' ')"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session; they refer to each other, so in this order."""
    for name, (arguments, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
