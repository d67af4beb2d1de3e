"""Countries, exchanges, trading hours and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions import times as D
from quotemill.functions.texts import NOT_COUNTRIES, ascii_only, stoplist_blank
from quotemill.operators.calendar import flatten_calendar
from quotemill.operators.latest import keep_first, keep_last, latest_with_smallest
from quotemill.schemas import CALENDAR_DOC, COUNTRIES_DOC, EXCHANGES_DOC
from quotemill.sources import markup
from quotemill.sources.files import parsed

COUNTRIES_TITLE = "Countries Data Coverage"
EXCHANGES_TITLE = "Exchanges Data Coverage"


def latest_documents(raw: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """The pages of the newest version of each title.

    Pages that landed one after the other, no more than ``gap`` apart, are one version. A version is complete if no page
    is missing between its first and its last; the newest complete one counts, and only where there is none the newest.
    Of a page that landed twice in it the newest stays. Rows without a time are a version of their own, the oldest.
    """
    timed = raw.withColumn("_at", F.coalesce(F.col("fetched_at").cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz")))
    spans = timed.groupBy("title", F.session_window("_at", gap).alias("_w")).agg(F.count(F.lit(1)).alias("rows"))
    spans = spans.select(F.col("title").alias("_of"), F.col("_w.start").alias("_from"), F.col("_w.end").alias("_to"))
    inside = F.col("title").eqNullSafe(F.col("_of")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    pages = timed.select("title", "page", "_at").join(spans, inside).groupBy("_of", "_from", "_to", "page").agg(F.count(F.lit(1)))
    complete = F.coalesce(F.count("page") == F.max("page") - F.min("page") + 1, F.lit(True))
    known = pages.groupBy("_of", "_from", "_to").agg(complete.alias("_complete"))
    newest = known.groupBy("_of").agg(F.max_by(F.struct("_from", "_to"), F.struct("_complete", "_from")).alias("_v")).select("_of", "_v.*")
    kept = timed.join(newest, inside, "left_semi")
    return latest_with_smallest(kept.select("title", "page", "fetched_at", "url", "body"), ["title", "page"], "fetched_at", "url")


def unknown_titles(raw: DataFrame) -> DataFrame:
    """Documents nothing knows how to read."""
    known = F.col("title").isin(COUNTRIES_TITLE, EXCHANGES_TITLE)
    return latest_documents(raw.where(~known)).select("title", "page", "url", F.lit("unknown title").alias("reason"))


def countries(raw: DataFrame) -> DataFrame:
    """Region and country rows of the newest countries document."""
    newest = latest_documents(raw.where(F.col("title") == COUNTRIES_TITLE))
    regions = newest.select(F.explode(F.from_json("body", COUNTRIES_DOC)).alias("r"))
    return regions.select(
        F.coalesce("r.region", F.lit("Unknown")).alias("region"), F.inline("r.countries")
    ).select("region", "country", "data_market", "country_flag")


def exchanges(raw: DataFrame) -> DataFrame:
    """Exchange rows of the newest exchanges document; every page lists the tabs in the same order.

    Inside a tab the first entry of a name counts; between tabs the last one does, as upserts in
    document order leave it. Tabs without entries vanish in the explode.
    """
    newest = latest_documents(raw.where(F.col("title") == EXCHANGES_TITLE))
    tabs = newest.select("page", F.posexplode(F.from_json("body", EXCHANGES_DOC)).alias("tab_no", "t"))
    entries = tabs.select("page", "tab_no", F.posexplode("t.exchanges").alias("pos", "e")).select(
        "page", "tab_no", "pos",
        F.col("e.exchangeName").alias("exchange_name"),
        F.col("e.exchangeDescName").alias("exchange_desc_name"),
        stoplist_blank("e.country", NOT_COUNTRIES).alias("country"),
        F.col("e.types").alias("types"),
    )
    per_tab = keep_first(entries, ["tab_no", "exchange_name"], ["page", "pos"])
    return keep_last(per_tab, ["exchange_name"], ["tab_no"]).drop("page", "tab_no", "pos")


def country_names(raw: DataFrame) -> DataFrame:
    """Country names in lower case, from every region of the newest countries document."""
    newest = latest_documents(raw.where(F.col("title") == COUNTRIES_TITLE))
    regions = newest.select(F.explode(F.from_json("body", COUNTRIES_DOC)).alias("r"))
    return regions.select(F.explode("r.countries.country").alias("c")).select(F.lower("c").alias("country"))


def calendar_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored calendar rows, and documents without regular hours."""
    docs = parsed(raw, "body", CALENDAR_DOC, "doc")
    usable = F.col("doc.regular_trading_hours").isNotNull()
    rows = docs.where(usable).select("symbol", *flatten_calendar())
    rejects = docs.where(~usable).select("symbol", "body", F.lit("no regular hours").alias("reason"))
    return rows, rejects


HOLIDAY_DOC = "holidays array<string>, rows array<struct<date: string, status: string>>"


def _holidays(rows: DataFrame) -> DataFrame:
    """Stored holiday rows of (url, symbol, holiday, _date, _status)."""
    return rows.select(
        "url", F.upper("symbol").alias("market"), "holiday",
        D.long_date("_date").alias("date"),
        ascii_only("_date").alias("long_date"),
        F.replace(ascii_only("_status"), F.lit("\n"), F.lit(", ")).alias("status"),
        D.holiday_session("_status").alias("h"),
    ).select("url", "market", "holiday", "date", "long_date", "status", "h.*")


def holiday_rows(raw: DataFrame) -> DataFrame:
    """Holiday name i belongs to row i, as far as both lists go."""
    docs = parsed(raw, "body", HOLIDAY_DOC, "doc")
    size = F.least(F.size("doc.holidays"), F.size("doc.rows"))
    pairs = F.slice(F.arrays_zip(F.col("doc.holidays").alias("holiday"), F.col("doc.rows").alias("row")), F.lit(1), size)
    rows = docs.select("symbol", "url", F.explode(pairs).alias("p"))
    return _holidays(rows.select("symbol", "url", F.col("p.holiday").alias("holiday"), F.col("p.row.date").alias("_date"), F.col("p.row.status").alias("_status")))


HOLIDAY_TAB, HOLIDAY_HEADERS = "holidays-nav-list", 3  # fixed values: the element that holds the table, and its column titles


def holiday_pages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Holiday rows out of market pages, and the pages without a holidays table.

    Each row's name is a header cell, its date and status are the first two plain cells. Weekday names and marks outside
    ASCII around a date do not matter; a text that is no date gives a row with a null date.
    """
    rows = markup.titled_rows(raw, ["symbol", "url"], HOLIDAY_TAB, HOLIDAY_HEADERS, 2)
    named = rows.where("row_no IS NOT NULL").select(
        "symbol", "url", F.col("title").alias("holiday"),
        F.get("cells", F.lit(0)).alias("_date"), F.get("cells", F.lit(1)).alias("_status"),
    )
    rejects = rows.where("row_no IS NULL").select("symbol", "url", F.lit("no holidays table").alias("reason"))
    return _holidays(named), rejects


def trading_hours(raw: DataFrame) -> DataFrame:
    """Table rows of "iso2 / exchange / symbol" and a session text."""
    rows = markup.table_rows(raw, ["url"]).where("NOT is_head AND size(cells) >= 3")
    names = F.split(F.get("cells", F.lit(0)), "\n")
    return rows.select(
        F.upper(F.trim(F.get(names, F.lit(0)))).alias("iso2"),
        F.trim(F.get(names, F.lit(1))).alias("market_exchange"),
        F.trim(F.get(names, F.lit(2))).alias("market_symbol"),
        D.session_text(F.get("cells", F.lit(1))).alias("s"),
    ).select("iso2", "market_exchange", "market_symbol", "s.*")
