"""Column functions on the texts that break naive parsers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill.functions import numbers as N
from quotemill.functions import texts as X
from quotemill.functions import times as D


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v")).alias("x")).collect()]


NUMBER_CASES = {
    None: None, "": None, "—": None, "1,234.5": 1234.5, "1d": None, "1f": None, "nan": None, "inf": None, "1e5": 1e5,
    " 5. ": 5.0, ".5": 0.5, "-3": -3.0, "+3": 3.0, "1 2": None, "not a number": None, "−1.2": None, " 7 ": 7.0, "0x10": None,
    "1.2.3": None,
}


def test_clean_number(spark):
    assert column(spark, list(NUMBER_CASES), N.clean_number) == list(NUMBER_CASES.values())


def test_clean_numeric_and_varpc(spark):
    assert column(spark, ["1,000", None, "x"], lambda c: N.clean_numeric(c, 10)) == [10000.0, None, None]
    assert column(spark, ["(1.2%)", "-3%", "(x%)", None], N.clean_varpc) == [1.2, -3.0, None, None]


@pytest.mark.parametrize(
    "text, word, delimiter, expected",
    [
        ("a b c", 2, "", "b"), ("  a b c\t", 3, "", "c"), ("a", 2, "", None), ("", 1, "", None), ("   ", 1, "", None), (None, 1, "", None),
        ("x*26.5*y", 2, "*", "26.5"), ("x*", 2, "*", ""), ("x", 2, "*", None), ("a||b", 2, "|", ""), ("", 1, "*", ""), ("a.b", 2, ".", "b"),
    ],
)
def test_extract_word(spark, text, word, delimiter, expected):
    assert column(spark, [text], lambda c: X.extract_word(c, word, delimiter)) == [expected]


def test_suffix_number(spark):
    cases = {"1.2B": 1.2e9, "3K": 3e3, "1,000M": 1e9, "2T": 2e12, "5 M": 5e6, "7": 7.0, "B1": None, None: None, "": None, "—": None, "K": None}
    assert column(spark, list(cases), N.suffix_number) == list(cases.values())


def test_money_text(spark):
    cases = {
        "2.92 T USD": (2.92e12, "USD"), "2.92 T USD": (2.92e12, "USD"), "100 TWD": (100.0, "TWD"), "−5 EUR": (-5.0, "EUR"),
        "1,234.5 M": (1234.5e6, ""), "12": (12.0, ""), "3 B": (3e9, ""), "4 KWD": (4.0, "KWD"), "5 K KWD": (5e3, "KWD"),
    }
    found = [tuple(x) for x in column(spark, list(cases), N.money_text)]
    assert found == list(cases.values())
    assert [tuple(x) for x in column(spark, [None, "", "—", "USD"], N.money_text)] == [(None, None)] * 4


def test_dashes_and_percent(spark):
    assert column(spark, ["—", "−1", "a—b", None], X.clean_dash) == [None, "-1", "a—b", None]
    assert column(spark, ["−1.2%", "50%", "—", None], N.percent_fraction) == [-0.012, 0.5, None, None]
    assert column(spark, ["—"], lambda c: N.percent_fraction(c, default=0)) == [0.0]


def test_price_and_change(spark):
    prices = [tuple(x) for x in column(spark, ["1,234.5 USD", "−3JPY", "7", "n/a", None], N.price_ccy)]
    assert prices == [(1234.5, "USD"), (-3.0, "JPY"), (7.0, None), (None, None), (None, None)]
    changes = [tuple(x) for x in column(spark, ["0.5(1.2%)", "-1 (-0.3 %)", "2", "(4%)", None], N.change_pct)]
    assert changes == [(0.5, 1.2), (-1.0, -0.3), (2.0, None), (None, 4.0), (None, None)]


def test_small_number_functions(spark):
    assert column(spark, ["$1,234.50", "N/A", None], N.dollar_number) == [1234.5, None, None]
    assert column(spark, ["12.7", "1,000", "x", None], N.int_or_zero) == [12, 0, 0, 0]
    assert column(spark, ["~ 12.5 %", "none", None], N.digits_only) == [125, None, None]
    assert column(spark, [1234.5, None], lambda c: N.fixed_decimals(c, 2), "double") == ["1234.50", None]
    assert column(spark, [float("nan"), 1.0, None], N.nan_to_null, "double") == [None, 1.0, None]


def test_small_text_functions(spark):
    assert [tuple(x) for x in column(spark, ["T\nName", "T", "", None], X.symbol_split)] == [("T", "Name"), ("T", ""), ("", ""), ("", "")]
    assert column(spark, ["Hong Kong (SAR)", "A-B"], X.country_key) == ["hong_kong_sar", "a_b"]
    assert column(spark, ["hose", "hnx", "upcom", None], lambda c: X.code_map(c, X.EXCHANGE_CODES, X.EXCHANGE_CODE_ELSE)) == ["HSX", "HNX", "UPC", "UPC"]
    assert column(spark, ["SPOT", "Chile"], X.stoplist_blank) == ["", "Chile"]
    assert column(spark, ["a✓b", None], X.ascii_only) == ["ab", None]
    assert [tuple(x) for x in column(spark, ["k\na\nb", "k\na", "k"], X.key_and_rest)] == [("k", "a b"), ("k", "a"), ("k", None)]
    assert column(spark, ["x", "CLICK HERE now"], lambda c: X.any_cell_contains([c, F.lit("z")], "click here")) == [False, True]


def test_dates(spark):
    day = dt.date(2025, 3, 4)
    assert column(spark, ["3/4/2025", "03/04/2025", "13/4/2025", "x", "", None], lambda c: D.parse_date(c, D.MONTH_FIRST)) == [day, day, None, None, None, None]
    assert column(spark, ["4/3/2025", "31/2/2025"], lambda c: D.parse_date(c, D.DAY_FIRST)) == [day, None]
    assert column(spark, ["Mar 4, 2025", "Mar 04, 2025", "not a date"], lambda c: D.parse_date(c, D.MONTH_NAME)) == [day, day, None]
    assert column(spark, ["20250304093005", "2025"], lambda c: D.parse_time(c, D.PACKED)) == [dt.datetime(2025, 3, 4, 9, 30, 5), None]
    assert column(spark, ["Thursday, January 2, 2025", "soon"], D.long_date) == [dt.date(2025, 1, 2), None]
    cases = {"2025-03": "2025-03-01", "2025-03-04": "2025-03-04", " 2025-3 ": "2025-3-01", "not a date": "not a date", None: None}
    assert column(spark, list(cases), D.standardize_date) == list(cases.values())


def test_clocks(spark):
    assert column(spark, ["2:44 PM", "12:05 am", "9:30 AM", "25:00 PM", "x", None], D.clock24) == ["14:44", "00:05", "09:30", None, None, None]
    text = "9:00 am - 11:30 am, 1:00 pm - 2:45 pm (+07)"
    assert tuple(column(spark, [text], D.session_text)[0]) == ("09:00", "14:45", "+07")
    assert tuple(column(spark, ["closed"], D.session_text)[0]) == (None, None, None)
    assert [tuple(x) for x in column(spark, ["Open, 9:30 AM - 1:00 PM\nearly✓", "Closed", "Open"], D.holiday_session)] == [
        ("09:30", "13:00"), (None, None), (None, None)
    ]


def test_epochs_and_zones(spark):
    assert column(spark, [0, 86399], D.epoch_seconds, "bigint") == [dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 23, 59, 59)]
    assert column(spark, [1500], D.epoch_millis, "bigint") == [dt.datetime(1970, 1, 1, 0, 0, 1, 500000)]
    base = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    assert column(spark, [19800.0, -18000.0, None], lambda c: D.zone_shift(base, c), "double") == [
        dt.datetime(2025, 1, 1, 5, 30), dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1)
    ]
    assert column(spark, [-18000.0], lambda c: D.zone_shift(base, c, signed=True), "double") == [dt.datetime(2024, 12, 31, 19)]
    assert column(spark, ["2025-01-01 00:00:00", "x"], lambda c: D.standardize_datetime(c, "Asia/Ho_Chi_Minh")) == ["2025-01-01 07:00:00", None]


@pytest.mark.parametrize(
    "now, hour, expected",
    [
        ("2025-01-06 10:00:00", 9, "2025-01-03"),  # Monday past the hour: Sunday goes back to Friday
        ("2025-01-05 10:00:00", 9, "2025-01-03"),  # Sunday past the hour: Saturday goes back to Friday
        ("2025-01-07 10:00:00", 9, "2025-01-06"),
        ("2025-01-07 09:59:00", 9, "2025-01-07"),
        ("2025-01-04 08:00:00", 9, "2025-01-06"),  # weekend before the hour goes on to Monday
        ("2025-01-05 08:00:00", 9, "2025-01-06"),
    ],
)
def test_last_trading_day(spark, now, hour, expected):
    found = column(spark, [now], lambda c: D.last_trading_day(c.cast("timestamp_ntz"), hour))
    assert found == [dt.date.fromisoformat(expected)]


def test_fetch_period(spark):
    cases = {None: "max", "2025-01-10": None, "2025-01-11": None, "2025-01-09": "1d", "2025-01-05": "5d", "2025-01-04": "1mo", "2024-10-12": "3mo",
             "2024-07-20": "6mo", "2024-01-11": "1y", "2023-01-11": "2y", "2020-01-12": "5y", "2015-01-13": "10y", "2000-01-01": "max"}
    assert column(spark, list(cases), lambda c: D.fetch_period(F.lit("2025-01-10"), c)) == list(cases.values())


def test_sql_names_agree_with_columns(spark):
    from quotemill.functions.sqlnames import register_sql_functions

    register_sql_functions(spark)
    texts = [t for t in NUMBER_CASES] + ["1.2B", "2.5 %", "(3%)", "Hong Kong (SAR)", "2:44 PM", "2025-03"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    pairs = {
        "qm_clean_number": N.clean_number, "qm_clean_varpc": N.clean_varpc, "qm_suffix_number": N.suffix_number, "qm_digits_only": N.digits_only,
        "qm_percent_fraction": N.percent_fraction, "qm_clean_dash": X.clean_dash, "qm_country_key": X.country_key, "qm_clock24": D.clock24,
        "qm_standardize_date": D.standardize_date, "qm_dollar_number": N.dollar_number, "qm_ascii_only": X.ascii_only,
    }
    for name, build in pairs.items():
        mine = [r[0] for r in df.select(build(F.col("s"))).collect()]
        theirs = [r[0] for r in df.select(F.expr(f"{name}(s)")).collect()]
        assert mine == theirs, name


def test_sql_names_of_text_functions_agree_with_columns(spark):
    from quotemill.functions.sqlnames import register_sql_functions

    register_sql_functions(spark)
    texts = [
        None, "", " ", "a b  c", " lead b", "x/y/z", "x.y", "TICK\nName", "TICK", "Label\na\nb", "a\r\nb", "2.92 T USD", "100 TWD", "1,5 KUSD", "−3 EUR",
        "12 \u202fM", "1,234.5 USD", "abc", "0.5(1.2%)", "−0.5(1%)", "7", "7.9", "1e30", "UPCOM", "index", "Thursday, January 2, 2025", "January 2, 2025",
        "9:00 am - 11:30 am, 1:00 pm - 2:45 pm (+07)", "9:00 am - 11:30 am", "see (site", "Open, 9:30 AM - 1:00 PM\nearly✓", "Closed✗", "2025-01-02 03:04:05",
        "Open", '{"a": {"b": "x"}}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    pairs = {
        "qm_extract_word(s, 2, '')": lambda s: X.extract_word(s, 2), "qm_extract_word(s, 2, '.')": lambda s: X.extract_word(s, 2, "."),
        "qm_first_token(s, '/')": lambda s: X.first_token(s, "/"), "qm_money_text(s)": N.money_text, "qm_price_ccy(s)": N.price_ccy,
        "qm_change_pct(s)": N.change_pct, "qm_int_or_zero(s)": N.int_or_zero, "qm_symbol_split(s)": X.symbol_split,
        "qm_code_map(s, map('UPCOM', 'UPC'), s)": lambda s: X.code_map(s, X.BOARD_CODES),
        "qm_code_map(s, map('hose', 'HSX', 'hnx', 'HNX'), 'UPC')": lambda s: X.code_map(s, X.EXCHANGE_CODES, X.EXCHANGE_CODE_ELSE),
        "qm_country_slug(s)": X.country_slug, "qm_long_date(s)": D.long_date, "qm_session_text(s)": D.session_text,
        "qm_holiday_session(s)": D.holiday_session, "qm_first_ten(s)": D.first_ten, "qm_asset_flag(s)": X.asset_flag,
        "qm_standardize_datetime(s, 'Asia/Ho_Chi_Minh', 'yyyy-MM-dd HH:mm:ss')": lambda s: D.standardize_datetime(s, "Asia/Ho_Chi_Minh"),
        "qm_key_and_rest(s)": X.key_and_rest, "qm_one_line(s)": X.one_line, "qm_clock24(s)": D.clock24,
        "qm_json_default(s, '$.a.b', '-')": lambda s: F.coalesce(F.get_json_object(s, "$.a.b"), F.lit("-")),
    }
    for call, build in pairs.items():
        mine = [r[0] for r in df.select(build(F.col("s"))).collect()]
        theirs = [r[0] for r in df.select(F.expr(call)).collect()]
        assert mine == theirs, call


def test_sql_names_of_times_agree_with_columns(spark):
    from quotemill.functions.sqlnames import register_sql_functions

    register_sql_functions(spark)
    days = [dt.datetime(2025, 1, 1, 9 + i % 12, 3 * i) + dt.timedelta(days=i) for i in range(16)]
    df = spark.createDataFrame([(d, d.date(), float(i * 1800 - 3600), i) for i, d in enumerate(days)] + [(None, None, None, None)],
                               "at timestamp_ntz, day date, off double, n int")
    at, day, off, n = (F.col(c) for c in ("at", "day", "off", "n"))
    pairs = {
        "qm_hhmm(at)": D.hhmm(at), "qm_last_trading_day(at, 15)": D.last_trading_day(at, 15), "qm_zone_shift(at, off, 7)": D.zone_shift(at, off, 7),
        "qm_fetch_period(TIMESTAMP_NTZ'2025-06-10', day)": D.fetch_period(F.lit("2025-06-10").cast("timestamp_ntz"), day),
        "qm_after_close(at, date_sub(day, n % 2), '15:45')": D.after_close(at, F.expr("date_sub(day, n % 2)")),
        "qm_epoch_seconds(n * 100000.5)": D.epoch_seconds(F.expr("n * 100000.5")), "qm_epoch_millis(n * 100000)": D.epoch_millis(n * 100000),
        "qm_fixed_decimals(off, 3)": N.fixed_decimals(off, 3),
    }
    for call, build in pairs.items():
        assert [r[0] for r in df.select(build).collect()] == [r[0] for r in df.select(F.expr(call)).collect()], call
