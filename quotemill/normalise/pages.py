"""Rows out of HTML pages: trades, boards, histories, profiles, categories, indices, sectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions import numbers as N
from quotemill.functions import texts as X
from quotemill.functions import times as D
from quotemill.operators.columns import clean_key_text, code_of, stamp
from quotemill.operators.filters import inner_rows, nonempty_cells, not_sentinel
from quotemill.operators.latest import keep_first, keep_last
from quotemill.operators.unions import widen
from quotemill.sources import markup


def cell(place: int) -> Column:
    return F.get("cells", F.lit(place))


def named(name: str, header: str = "names") -> Column:
    """The cell under a header name."""
    return F.get("cells", F.array_position(header, F.lit(name)).cast("int") - 1)


def _names(clean) -> Column:
    return F.transform("header", clean)


def page_rejects(raw: DataFrame, least_tables: int) -> DataFrame:
    """Documents with fewer tables than their reader needs."""
    counted = markup.table_counts(raw, ["source", "symbol", "url", "fetched_at"])
    return counted.where(F.col("n_tables") < least_tables).withColumn("reason", F.lit("too few tables"))


# Trades of a day ------------------------------------------------------------------------------------


def day_trades(raw: DataFrame, trading_day: str, as_of: str) -> DataFrame:
    """First table, five columns: time, "last change (percent%)", volume, total volume."""
    rows = markup.table_rows(raw, ["symbol", "url"], only=0).where("NOT is_head AND size(cells) = 5")
    word = lambda i: X.extract_word(cell(1), i)
    typed = rows.select(
        F.col("symbol").alias("codesource"), code_of("STKVN", "symbol").alias("code"), F.lit("CAF").alias("source"),
        F.lit(trading_day).cast("date").alias("date"), cell(0).alias("time"), cell(2).alias("volume"),
        N.clean_number(cell(3)).alias("volume_total"), N.clean_numeric(word(1), 1000).alias("last"),
        N.clean_numeric(word(2), 1000).alias("change"), N.clean_varpc(word(3)).alias("varpc"),
    )
    return stamp(typed, as_of)


def summary_trades(raw: DataFrame, trading_day: str, as_of: str, factor: float = 1000) -> DataFrame:
    """Fourth table of a page; all numbers, volumes too, are in units of ``factor``."""
    rows = markup.table_rows(raw, ["symbol", "url"], only=3, least=4).where("NOT is_head")
    typed = rows.select(
        F.lit("C68").alias("source"), F.col("symbol").alias("codesource"), code_of("STKVN", "symbol").alias("code"),
        F.lit(trading_day).cast("date").alias("date"), F.concat(cell(0), F.lit(":00")).alias("timestamp"),
        N.clean_numeric(cell(1), factor).alias("last"), N.clean_numeric(cell(2), factor).alias("change"),
        N.clean_numeric(cell(3), factor).alias("last_volume"), N.clean_numeric(cell(4), factor).alias("cumul_volume"),
    )
    return stamp(typed.where(F.col("last").isNotNull()), as_of)


# Histories ------------------------------------------------------------------------------------------


def quotes_history(raw: DataFrame, as_of: str) -> DataFrame:
    """23rd table: the first row names the columns, the last one is a footer."""
    columns = ("date", "open", "high", "low", "close", "average", "adjustedclose", "change", "volume")
    table = markup.named_cells(
        raw, ["symbol", "url"], {name: f"_{name}" for name in columns}, lambda h: h.strip(" ").lower().replace(" ", ""), only=22, least=23
    )
    thousand = lambda name: N.clean_numeric(f"_{name}", 1000)
    typed = inner_rows(table).select(
        F.col("symbol").alias("codesource"), F.lit("STB").alias("source"), code_of("STKVN", "symbol").alias("code"),
        D.parse_date("_date", D.MONTH_FIRST).alias("date"),
        *[thousand(name).alias(name) for name in ("open", "high", "low", "close", "average")],
        thousand("adjustedclose").alias("close_adj"),
        N.clean_numeric(X.first_token("_change", "/"), 1000).alias("change"),
        N.clean_number("_volume").alias("volume"),
    )
    return stamp(typed, as_of)


def price_history(raw: DataFrame) -> DataFrame:
    """Date, price and volume texts; of windows that overlap, the later page wins."""
    prices = ("Price", "Open", "High", "Low")
    columns = {"Date": "_date", **{name: f"_{name}" for name in prices}, "Vol.": "_volume", "Change %": "_change"}
    rows = markup.named_cells(raw, ["symbol", "page"], columns, lambda h: h.strip(" ")).where("NOT is_head")
    typed = rows.select(
        F.col("symbol").alias("codesource"), "page", "row_no", D.parse_date("_date", D.MONTH_NAME).alias("date"),
        *[N.clean_number(f"_{name}").alias(name.lower()) for name in prices],
        N.suffix_number("_volume").alias("volume"), N.percent_fraction("_change").alias("rt"),
    )
    return keep_last(typed, ["codesource", "date"], ["page", "row_no"]).drop("page", "row_no")


# Boards ---------------------------------------------------------------------------------------------


def board_pages(raw: DataFrame, trading_day: str, as_of: str) -> DataFrame:
    """Second table of each market's page; tickers may carry a star, volumes extra lines."""
    rows = markup.table_rows(raw, ["dataset", "url"], only=1).where("NOT is_head")
    thousand = F.lit(1000.0)
    board = rows.select(
        F.lit("VST").alias("source"), X.code_map("dataset", X.EXCHANGE_CODES, X.EXCHANGE_CODE_ELSE).alias("market"),
        F.translate(cell(0), "*", "").alias("ticker"), F.lit(trading_day).cast("date").alias("date"),
        (N.clean_number(cell(1)) * thousand).alias("reference"), (N.clean_number(cell(6)) * thousand).alias("last"),
        (N.plain_number(cell(12)) * thousand).alias("change"), N.clean_number(X.first_token(cell(21), "\n")).alias("volume"),
    ).withColumn("code", code_of("STKVN", "ticker"))
    return stamp(board.where(F.length("ticker") == 3), as_of)


# Labels and values ----------------------------------------------------------------------------------

# Labels as the pages print them, and the columns they become.
STATISTICS_LABELS = {"Shares Outstanding": "sharesout", "Float": "float", "Market Cap": "marketcap"}
SHARE_LABELS = {"KLCP đang niêm yết:": "shareslis", "KLCP đang lưu hành:": "sharesout"}
FREE_FLOAT_LABELS = {"Free float": "free_float"}
FUND_LABELS = {"AUM": "aum", "Shares": "shares", "Inception": "inception"}
PROFILE_LABELS = {"Address": "address", "Phone": "phone", "Fax": "fax", "Web": "web"}
COMPANY_LABELS = {"Market Cap": "market_cap", "Shares Outstanding": "shares_outstanding"}


def labelled(raw: DataFrame, ids: list[str], labels: dict[str, str], first: bool = False) -> DataFrame:
    """One wide row per document from its label/value pairs."""
    pairs = markup.label_values(raw, ids, labels=list(labels))
    return widen(pairs, ids, "label", "value", "pos", labels, first)


def key_statistics(raw: DataFrame) -> DataFrame:
    """Shares, float and market value, with unit letters."""
    wide = labelled(raw, ["symbol"], STATISTICS_LABELS, first=True)
    return wide.select("symbol", *[N.suffix_number(name).alias(name) for name in STATISTICS_LABELS.values()])


def linked_shares(raw: DataFrame, link_list: DataFrame, base_url: str, trading_day: str, as_of: str) -> DataFrame:
    """Listed and outstanding shares from the page a ticker's link names; the first link of a ticker counts."""
    first = keep_first(link_list, ["ticker"], ["n"])
    wide = labelled(raw, ["url"], SHARE_LABELS, first=True)
    joined = first.withColumn("url", F.concat(F.lit(base_url), "link")).join(wide, "url")
    typed = joined.select(
        "ticker", F.col("ticker").alias("codesource"), F.lit("CAF").alias("source"), code_of("STKVN", "ticker").alias("code"),
        F.lit(trading_day).cast("date").alias("date"), N.clean_number("sharesout").alias("sharesout"),
        N.clean_number("shareslis").alias("shareslis"),
    )
    return stamp(typed, as_of)


def page_free_float(raw: DataFrame) -> DataFrame:
    wide = labelled(raw, ["symbol"], FREE_FLOAT_LABELS, first=True)
    return wide.select("symbol", N.digits_only("free_float").alias("free_float")).where(F.col("free_float").isNotNull())


def fund_shares(raw: DataFrame, labels: dict[str, str] = FUND_LABELS) -> DataFrame:
    """Overview entries as texts; of a label that repeats, the last one counts."""
    wide = labelled(raw, ["symbol", "fetched_at"], labels)
    return wide.select(F.col("symbol").alias("ticker"), F.to_date("fetched_at").alias("date"), *labels.values())


def company_numbers(raw: DataFrame) -> DataFrame:
    """Entries whose first line is the label and whose other lines are the value."""
    items = markup.list_items(raw, ["symbol"]).withColumn("kv", X.key_and_rest("text"))
    entries = items.select("symbol", "item_no", F.col("kv.key").alias("label"), F.col("kv.value").alias("value"))
    wide = widen(entries.where(F.col("label").isin(*COMPANY_LABELS)), ["symbol"], "label", "value", "item_no", COMPANY_LABELS)
    return wide.select(F.col("symbol").alias("codesource"), *[N.suffix_number(c).alias(c) for c in COMPANY_LABELS.values()])


def company_profile(raw: DataFrame) -> DataFrame:
    """The people of the board, each with the company's contact texts on one line."""
    people = markup.table_rows(raw, ["symbol"], only=0).where("NOT is_head").select(
        "symbol", cell(0).alias("name"), cell(1).alias("age"), cell(2).alias("since"), cell(3).alias("title")
    )
    contact = labelled(raw, ["symbol"], PROFILE_LABELS, first=True)
    lines = contact.select("symbol", *[X.one_line(name).alias(name) for name in PROFILE_LABELS.values()])
    return people.join(lines, "symbol", "left").withColumnRenamed("symbol", "codesource")


# Funds ----------------------------------------------------------------------------------------------


THEME_COLUMNS = {"ETF THEME": "etf_theme", "AUM": "aum"}


def fund_categories(raw: DataFrame, columns: dict[str, str] = THEME_COLUMNS) -> DataFrame:
    """Themes under their section's heading, with the link of the first cell; ``columns`` maps headers,
    in upper case, to names and must hold the theme."""
    rows = markup.table_rows(raw, ["url"], header=True).where("NOT is_head").withColumn("names", _names(lambda h: F.upper(F.trim(h))))
    typed = rows.select(
        F.get("hrefs", F.lit(0)).alias("component_url"), *[named(text).alias(name) for text, name in columns.items()],
        F.col("heading").alias("category"),
    )
    return not_sentinel(typed, "etf_theme", "None")


ADVERT = "Click Here to Join"


def fund_components(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Member rows of all pages of a list, adverts left out."""
    rows = markup.table_rows(raw, ["url"], header=True).where("NOT is_head")
    advert = F.exists("cells", lambda c: F.lower(c).contains(ADVERT.lower()))
    named_rows = rows.where(~advert).withColumn("names", _names(F.trim))
    return named_rows.select("url", *[named(text).alias(name) for text, name in columns.items()])


# Indices, sectors, industries, components -----------------------------------------------------------


def indices(raw: DataFrame) -> DataFrame:
    """Indices of a tab (the dataset). Signs are kept; the currency is that of the price."""
    rows = nonempty_cells(markup.table_rows(raw, ["dataset", "url"], header=True).where("NOT is_head")).withColumn("names", _names(F.trim))
    symbol = X.symbol_split(named("Symbol"))
    price = N.price_ccy(named("Price"))
    return rows.select(
        F.col("row_key").alias("exchange"), symbol["ticker"].alias("ticker"), symbol["name"].alias("name"),
        price["price"].alias("price"), F.coalesce(price["currency"], F.lit("")).alias("cur"),
        *[N.price_ccy(named(text))["price"].alias(text.lower()) for text in ("Change", "High", "Low")],
        N.percent_fraction(named("Change %"), default=0).alias("rt"),
        X.code_map("dataset", X.TAB_TITLES, "Unknown").alias("tab"),
    )


def _keyed_rows(raw: DataFrame, ids: list[str], columns: dict[str, str]) -> DataFrame:
    """Rows with a text of all tables: what stands under the cleaned header names, the row's key and its first cell's link."""
    return markup.keyed_cells(raw, ids, columns, lambda h: clean_key_text(h, ""))


def _group_rows(raw: DataFrame, own: str, other: str) -> DataFrame:
    columns = {
        own: "_own", "marketcap": "_marketcap", "divyield(indicated)": "_divyield", "change": "_change", "volume": "_volume",
        other: "_other", "stocks": "_stocks",
    }
    rows = _keyed_rows(raw, ["dataset", "url"], columns)
    cap = N.money_text(X.clean_dash("_marketcap"))
    return rows.select(
        F.col("row_key").alias("icb_code"), F.col("_own").alias(own), cap["value"].alias("marketcap"), cap["currency"].alias("cur"),
        N.percent_fraction(X.clean_dash("_divyield")).alias("divyield_percent"),
        N.percent_fraction(X.clean_dash("_change")).alias("rt"),
        N.money_text(X.clean_dash("_volume"))["value"].alias("volume"),
        F.col("_other").alias(other), F.col("_stocks").alias("stocks"), F.col("link").alias("component_url"),
        F.col("dataset").alias("country"),
    )


def sectors(raw: DataFrame) -> DataFrame:
    """Sector rows of a country's page (the dataset is the country)."""
    return _group_rows(raw, "sector", "industries")


def industries(raw: DataFrame) -> DataFrame:
    return _group_rows(raw, "industry", "sector")


# Component columns that stay texts.
COMPONENT_TEXTS = {
    "relvolume": "relvolume", "p/e": "pe", "epsdilttm": "epsdilttm", "epsdilgrowthttmyoy": "epsdilgrowthttmyoy",
    "divyieldttm": "divyieldttm", "analystrating": "analystrating",
}


def components(raw: DataFrame) -> DataFrame:
    """Shares of a sector's or industry's page, tagged with the page they came from."""
    columns = {
        "symbol": "_symbol", "price": "_price", "change": "_change", "volume": "_volume", "marketcap": "_marketcap",
        **{text: f"_{name}" for text, name in COMPONENT_TEXTS.items()},
    }
    rows = _keyed_rows(raw, ["url"], columns)
    symbol = X.symbol_split("_symbol")
    price = N.money_text(X.clean_dash("_price"))
    return rows.select(
        F.col("url").alias("component_url"), F.col("row_key").alias("codesource"), symbol["ticker"].alias("ticker"),
        symbol["name"].alias("name"), price["value"].alias("price"), price["currency"].alias("cur"),
        N.percent_fraction(X.clean_dash("_change")).alias("rt"),
        N.money_text(X.clean_dash("_volume"))["value"].alias("volume"),
        N.money_text(X.clean_dash("_marketcap"))["value"].alias("marketcap"),
        *[X.clean_dash(f"_{name}").alias(name) for name in COMPONENT_TEXTS.values()],
        F.col("link").alias("stock_url"),
    )
