"""HTML pages through the parser and their normalisers, back to the tables they were rendered from."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.normalise import pages
from quotemill.operators.unions import union_all
from quotemill.plans.components import component_rows
from quotemill.queries.payloads import AS_OF, DAY_SQL
from quotemill.queries.registry import DAILY, query
from quotemill.render import html_bodies, html_link, html_pair, html_row, page_of
from quotemill.sources.tables import landing as land


def _key():
    return F.col("o_orderkey")


def _price():
    return F.col("o_totalprice")


def _commas():
    return F.format_number(_price(), 2)


def _raw(bodies, source: str, dataset=None, symbol=None, url=None, **more):
    return land(
        bodies, source, dataset if dataset is not None else "page", F.col("body"), symbol=symbol,
        url=url if url is not None else F.concat_ws("/", *[F.col(c).cast("string") for c in bodies.columns if c != "body"]),
        page=F.col("page"), **more,
    )


def _order_symbol():
    return F.concat(F.lit("C"), F.col("o_custkey") % 20)


# Trades ---------------------------------------------------------------------------------------------


@query(
    "n08",
    "SELECT concat('C', o_custkey % 20) AS codesource, concat('STKVNC', o_custkey % 20) AS code, 'CAF' AS source, "
    f"{DAY_SQL} AS date, '09:15' AS time, o_orderkey::VARCHAR AS volume, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey * 1000.0::DOUBLE END AS volume_total, "
    "1000.0::DOUBLE * o_totalprice AS last, CASE WHEN o_orderkey % 7 > 0 THEN -1000.0::DOUBLE * o_custkey END AS change, "
    f"CASE WHEN o_orderkey % 7 > 0 THEN -(o_custkey::DOUBLE) END AS varpc, '{AS_OF}' AS updated FROM orders",
)
def n08(t):
    moved = F.concat(_commas(), F.lit(" -"), F.col("o_custkey"), F.lit(" (-"), F.col("o_custkey"), F.lit("%)"))
    cells = [
        F.lit("09:15"), F.when(_key() % 7 > 0, moved).otherwise(_commas()), _key(),
        F.when(_key() % 5 > 0, F.format_number(F.col("o_custkey") * 1000, 0)).otherwise(F.lit("n/a")), F.lit("x"),
    ]
    bodies = html_bodies(
        t.orders, {"symbol": _order_symbol()}, page_of("o_orderkey"), ["o_orderkey"], html_row(cells),
        ["Time", "Price", "Volume", "Total", "More"],
    )
    return pages.day_trades(_raw(bodies, "CAF", symbol=F.col("symbol")), AS_OF[:10], AS_OF)


@query(
    "n09",
    "SELECT 'C68' AS source, concat('C', o_custkey % 20) AS codesource, concat('STKVNC', o_custkey % 20) AS code, "
    f"{DAY_SQL} AS date, concat(o_orderkey, ':00') AS timestamp, 1000.0::DOUBLE * o_totalprice AS last, 1000.0::DOUBLE * o_custkey AS change, "
    f"1000.0::DOUBLE * o_orderkey AS last_volume, 1000.0::DOUBLE * o_orderkey * 2 AS cumul_volume, '{AS_OF}' AS updated FROM orders WHERE o_orderkey % 6 > 0",
)
def n09(t):
    last = F.when(_key() % 6 > 0, _commas()).otherwise(F.lit("n/a"))
    row = F.concat(
        F.lit('<tr><td colspan="auto">'), _key(), F.lit("</td><td>"), last, F.lit("</td><td>"), F.col("o_custkey"), F.lit("<td>"),
        F.format_number(_key(), 0), F.lit("<td>"), F.format_number(_key() * 2, 0), F.lit("</tr>"),
    )
    small = "<table><tr><td>1</td><td>2</td></tr></table>"
    bodies = html_bodies(
        t.orders, {"symbol": _order_symbol()}, page_of("o_orderkey"), ["o_orderkey"], row, ["T", "L", "C", "V", "S"], before=small * 3
    )
    return pages.summary_trades(_raw(bodies, "C68", symbol=F.col("symbol")), AS_OF[:10], AS_OF)


@query(
    "page_rejects",
    "SELECT concat('C', o_custkey % 20) AS symbol, CAST(3 + CASE WHEN o_custkey % 20 % 2 = 0 THEN 1 ELSE 0 END AS INT) AS n_tables, 'too few tables' AS reason "
    "FROM orders WHERE o_custkey % 20 % 2 = 1 GROUP BY o_custkey % 20, o_orderkey // 1000",
)
def page_rejects(t):
    """Pages of odd symbols lack one of the four tables their reader needs."""
    small = "<table><tr><td>1</td><td>2</td></tr></table>"
    row = html_row([_key(), _commas()])
    bodies = html_bodies(t.orders, {"symbol": _order_symbol()}, page_of("o_orderkey"), ["o_orderkey"], row, ["T", "L"], before=small * 2)
    even = F.substring("symbol", 2, 9).cast("int") % 2 == 0
    filled = bodies.withColumn("body", F.when(even, F.concat("body", F.lit(small))).otherwise(F.col("body")))
    rejects = pages.page_rejects(_raw(filled, "C68", symbol=F.col("symbol")), 4)
    return rejects.select("symbol", "n_tables", "reason")


# Histories ------------------------------------------------------------------------------------------

GROUPED = f"(SELECT *, concat('P', ticker % 10) AS symbol FROM {DAILY})"
DAY_ORDER = ["date", "o", "n", "s", "ticker", "volume", "close"]


def _daily_symbol():
    return F.concat(F.lit("P"), F.col("ticker") % 10)


@query(
    "n15",
    "SELECT symbol AS codesource, 'STB' AS source, concat('STKVN', symbol) AS code, date, 1000.0::DOUBLE * close AS open, 1000.0::DOUBLE * (close + 1) AS high, "
    "1000.0::DOUBLE * (close - 1) AS low, 1000.0::DOUBLE * close AS close, 1000.0::DOUBLE * n AS average, 1000.0::DOUBLE * (close / 2) AS close_adj, "
    f"1000.0::DOUBLE * -n AS change, volume * 1000 AS volume, '{AS_OF}' AS updated FROM {GROUPED}",
)
def n15(t):
    close = F.col("close")
    header = ["Date", "Change", "Open", "High", "Low", "Close", "Average", "Adjusted Close", "Volume", "Tenth"]
    cells = [
        F.date_format("date", "M/d/yyyy"), F.concat(F.lit("-"), F.col("n"), F.lit("/-1.2%")), close, close + 1, close - 1, close,
        F.col("n"), close / 2, F.format_number(F.col("volume") * 1000, 0), F.lit("z"),
    ]
    before = "<table><tr><td>x</td></tr></table>" * 22
    bodies = html_bodies(
        t.daily, {"symbol": _daily_symbol()}, page_of("o"), DAY_ORDER, html_row(cells), None, footer="<tr><td>Total</td><td>1</td></tr>"
    )
    first = "<tr>" + "".join(f"<td>{name}</td>" for name in header) + "</tr>"
    filled = bodies.withColumn("body", F.replace("body", F.lit("<table>"), F.lit(before + "<table>" + first)))
    return pages.quotes_history(_raw(filled, "STB", symbol=F.col("symbol")), AS_OF)


@query(
    "n28",
    "SELECT symbol AS codesource, date, arg_max(close, k) AS price, arg_max(close + 1, k) AS open, arg_max(close + 2, k) AS high, arg_max(close - 1, k) AS low, "
    "arg_max(volume * 1e6::DOUBLE, k) AS volume, arg_max(-n / 100.0::DOUBLE, k) AS rt FROM (SELECT *, (o // 1000, o, n, s, ticker, volume, close) AS k "
    f"FROM {GROUPED}) GROUP BY symbol, date",
)
def n28(t):
    """Pages are download windows; dates repeat within and between them."""
    close = F.col("close")
    cells = [
        F.date_format("date", "MMM d, yyyy"), close, close + 1, close + 2, close - 1, F.concat(F.col("volume"), F.lit("M")),
        F.concat(F.lit("-"), F.col("n"), F.lit("%")),
    ]
    bodies = html_bodies(
        t.daily, {"symbol": _daily_symbol()}, page_of("o"), ["o", "n", "s", "ticker", "volume", "close"], html_row(cells),
        ["Date", "Price", "Open", "High", "Low", "Vol.", "Change %"],
    )
    return pages.price_history(_raw(bodies, "INV", symbol=F.col("symbol")))


# Boards ----------------------------------------------------------------------------------------------------


@query(
    "n20",
    "SELECT 'VST' AS source, CASE o_orderstatus WHEN 'P' THEN 'UPC' WHEN 'F' THEN 'HSX' ELSE 'HNX' END AS market, ticker, "
    f"{DAY_SQL} AS date, o_totalprice * 1000.0::DOUBLE AS reference, (o_totalprice + 1) * 1000.0::DOUBLE AS last, "
    "CASE WHEN o_orderkey % 3 > 0 THEN -(o_custkey::DOUBLE) * 1000.0::DOUBLE END AS change, o_custkey * 1000.0::DOUBLE AS volume, concat('STKVN', ticker) AS code, "
    f"'{AS_OF}' AS updated FROM (SELECT *, lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS ticker FROM orders) WHERE o_orderkey % 4 > 0",
)
def n20(t):
    ticker = F.lpad(_key() % 1000, 3, "0")
    cells = [F.lit("-")] * 22
    cells[0] = F.when(_key() % 4 == 0, F.concat(ticker, F.lit("X"))).when(_key() % 4 == 1, F.concat(ticker, F.lit("*"))).otherwise(ticker)
    cells[1] = _commas()
    cells[6] = F.format_number(_price() + 1, 2)
    cells[12] = F.when(_key() % 3 > 0, F.concat(F.lit("-"), F.col("o_custkey")))
    cells[21] = F.concat(F.format_number(F.col("o_custkey") * 1000, 0), F.lit("<br>more"))
    market = F.when(F.col("o_orderstatus") == "P", F.lit("upcom")).when(F.col("o_orderstatus") == "F", F.lit("hose")).otherwise(F.lit("hnx"))
    bodies = html_bodies(
        t.orders, {"market": market}, page_of("o_orderkey"), ["o_orderkey"], html_row(cells), None,
        before="<table><tr><td>menu</td></tr></table>",
    )
    return pages.board_pages(_raw(bodies, "VST", dataset=F.col("market")), AS_OF[:10], AS_OF)


# Labels and values -----------------------------------------------------------------------


def _page_per_order(t, source, body):
    return land(t.orders, source, "page", F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")), symbol=_key(), url=_key())


@query(
    "n07",
    "SELECT o_orderkey::VARCHAR AS symbol, o_totalprice * 1e9::DOUBLE AS sharesout, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey * 1e3::DOUBLE END AS float, "
    "CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice * 1e12::DOUBLE END AS marketcap FROM orders",
)
def n07(t):
    rows = F.concat(
        F.lit("<table>"), html_pair("Shares Outstanding", F.concat(_commas(), F.lit("B")), "tr", "td"),
        F.when(_key() % 4 > 0, html_pair("Float", F.concat(F.col("o_custkey"), F.lit("K")), "tr", "td")).otherwise(F.lit("")), F.lit("</table>"),
    )
    cap = html_pair("Market Cap", F.when(_key() % 5 > 0, F.concat(_commas(), F.lit("T"))).otherwise(F.lit("N/A")))
    return pages.key_statistics(_page_per_order(t, "YAH", F.concat(rows, F.lit("<ul>"), cap, F.lit("</ul>"))))


@query(
    "n18",
    "SELECT concat('C', o_custkey) AS ticker, concat('C', o_custkey) AS codesource, 'CAF' AS source, concat('STKVNC', o_custkey) AS code, "
    f"{DAY_SQL} AS date, CASE WHEN c_custkey % 3 > 0 THEN c_custkey * 2000.0::DOUBLE END AS sharesout, c_custkey * 1000.0::DOUBLE AS shareslis, '{AS_OF}' AS updated "
    "FROM (SELECT o_custkey, arg_min(o_custkey + o_orderkey % 2, o_orderkey) AS page FROM orders GROUP BY o_custkey) JOIN customer ON c_custkey = page",
)
def n18(t):
    """A page per customer; the first link of a ticker names its own or its neighbour's page."""
    key = F.col("c_custkey")
    body = F.concat(
        html_pair("KLCP đang niêm yết:", F.format_number(key * 1000, 0), "div", "div"),
        F.when(key % 3 > 0, html_pair("KLCP đang lưu hành:", F.concat(F.lit(" "), F.format_number(key * 2000, 0)), "div", "div")).otherwise(F.lit("")),
    )
    raw = land(t.customer, "CAF", "page", body, url=F.concat(F.lit("//caf/"), F.lit("l"), key))
    link_list = t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"),
        F.concat(F.lit("l"), F.col("o_custkey") + _key() % 2).alias("link"), _key().alias("n"),
    )
    return pages.linked_shares(raw, link_list, "//caf/", AS_OF[:10], AS_OF)


@query(
    "n22",
    "SELECT o_orderkey::VARCHAR AS symbol, o_custkey * 10 + 5 AS free_float FROM orders WHERE o_orderkey % 8 > 0",
)
def n22(t):
    value = F.when(_key() % 8 > 0, F.concat(F.col("o_custkey"), F.lit(".5 %"))).otherwise(F.lit("n/a"))
    return pages.page_free_float(_page_per_order(t, "24H", F.concat(F.lit("<table>"), html_pair("Free float", value, "tr", "td"), F.lit("</table>"))))


@query(
    "n29",
    "SELECT o_orderkey::VARCHAR AS codesource, o_totalprice * 1e6::DOUBLE AS market_cap, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey * 1e9::DOUBLE END AS shares_outstanding FROM orders",
)
def n29(t):
    items = F.concat(
        F.lit("<ul><li>Volume<br>1<br>2</li><li>Market Cap<br>"), _commas(), F.lit("M</li><li>Shares Outstanding"),
        F.when(_key() % 3 > 0, F.concat(F.lit("<br>"), F.col("o_custkey"), F.lit("B"))).otherwise(F.lit("")), F.lit("</li></ul>"),
    )
    return pages.company_numbers(_page_per_order(t, "INV", items))


@query(
    "n34",
    "SELECT o_orderkey::VARCHAR AS ticker, DATE '2025-01-02' AS date, concat('$', o_custkey, ' M') AS aum, "
    "CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS shares, strftime(o_orderdate, '%Y-%m-%d') AS inception FROM orders",
)
def n34(t):
    """The first AUM entry is overwritten by the second."""
    items = F.concat(
        F.lit("<ul>"), html_pair("AUM", F.lit("old")), F.when(_key() % 3 > 0, html_pair("Shares", F.col("o_orderstatus"))).otherwise(F.lit("")),
        html_pair("Inception", F.date_format("o_orderdate", "yyyy-MM-dd")), html_pair("AUM", F.concat(F.lit("$"), F.col("o_custkey"), F.lit(" M"))), F.lit("</ul>"),
    )
    return pages.fund_shares(_page_per_order(t, "ETFDB", items))


# Profiles and funds ----------------------------------------------------------------------------------------


@query(
    "n30",
    "SELECT concat('C', o_custkey % 20, '/', o_orderkey // 1000) AS codesource, concat('Person ', o_custkey) AS name, (o_orderkey % 70)::VARCHAR AS age, strftime(o_orderdate, '%Y') AS since, o_orderpriority AS title, "
    "concat('Street ', o_custkey % 20, ' City') AS address, '+1 2' AS phone, NULL::VARCHAR AS fax, 'www' AS web FROM orders",
)
def n30(t):
    cells = [F.concat(F.lit("Person "), F.col("o_custkey")), _key() % 70, F.date_format("o_orderdate", "yyyy"), F.col("o_orderpriority")]
    contact = F.concat(
        html_pair("Address", F.concat(F.lit("Street "), F.substring("symbol", 2, 9), F.lit("<br>City")), "div"),
        F.lit("<div><span>Phone</span><span>+1<br>2</span></div><div><span>Web</span><span>www</span></div>"),
    )
    bodies = html_bodies(
        t.orders, {"symbol": _order_symbol()}, page_of("o_orderkey"), ["o_orderkey"], html_row(cells), ["Name", "Age", "Since", "Title"], after=contact
    )
    raw = _raw(bodies, "INV", symbol=F.concat_ws("/", "symbol", F.col("page").cast("string")))
    return pages.company_profile(raw)


@query(
    "n31",
    "SELECT concat('/t/', o_orderkey) AS component_url, CASE WHEN o_orderkey % 4 = 1 THEN '' ELSE concat('Theme ', o_custkey) END AS etf_theme, o_totalprice::VARCHAR AS aum, "
    "concat('Group ', o_orderstatus) AS category FROM orders WHERE o_orderkey % 4 > 0",
)
def n31(t):
    theme = F.when(_key() % 4 == 0, F.lit("None")).when(_key() % 4 == 1, F.lit("")).otherwise(F.concat(F.lit("Theme "), F.col("o_custkey")))
    row = html_row([html_link(F.concat(F.lit("/t/"), _key()), theme), _price()])
    bodies = html_bodies(
        t.orders, {"status": F.col("o_orderstatus")}, page_of("o_orderkey"), ["o_orderkey"], row, ["ETF Theme", "AUM"], before="<h3>Group @</h3>"
    )
    titled = bodies.withColumn("body", F.replace("body", F.lit("Group @"), F.concat(F.lit("Group "), F.col("status"))))
    return pages.fund_categories(_raw(titled, "ETFDB"))


@query(
    "n32",
    "SELECT concat('/list/', o_orderstatus) AS url, concat('S', o_orderkey) AS symbol, concat('Fund ', o_custkey) AS name, o_totalprice::VARCHAR AS assets FROM orders WHERE o_orderkey % 10 > 0",
)
def n32(t):
    name = F.when(_key() % 10 == 0, F.lit("please CLICK here to join now")).otherwise(F.concat(F.lit("Fund "), F.col("o_custkey")))
    row = html_row([F.concat(F.lit("S"), _key()), name, _price()])
    bodies = html_bodies(t.orders, {"status": F.col("o_orderstatus")}, page_of("o_orderkey"), ["o_orderkey"], row, ["Symbol", "ETF Name", "Total Assets"])
    raw = _raw(bodies, "ETFDB", url=F.concat(F.lit("/list/"), F.col("status")))
    return pages.fund_components(raw, {"Symbol": "symbol", "ETF Name": "name", "Total Assets": "assets"})


# Indices, sectors, industries, components ---------------------------------------------------------------


@query(
    "n36",
    "SELECT concat('E:', o_orderkey) AS exchange, concat('T', o_custkey) AS ticker, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority ELSE '' END AS name, o_totalprice AS price, "
    "CASE WHEN o_orderkey % 3 > 0 THEN 'JPY' ELSE '' END AS cur, -(o_custkey::DOUBLE) AS change, o_totalprice + 1 AS high, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey::DOUBLE END AS low, "
    "CASE WHEN o_orderkey % 7 > 0 THEN -(o_custkey / 100.0::DOUBLE) ELSE 0.0 END AS rt, "
    "CASE o_orderstatus WHEN 'P' THEN 'World Indices' WHEN 'F' THEN 'S&P 500' ELSE 'Unknown' END AS tab FROM orders",
)
def n36(t):
    description = F.when(_key() % 5 > 0, F.col("o_orderpriority")).otherwise(F.lit(""))
    cells = [
        html_link(F.lit("/x"), F.concat(F.lit("T"), F.col("o_custkey")), description),
        F.concat(_commas(), F.when(_key() % 3 > 0, F.lit(" JPY")).otherwise(F.lit(""))),
        F.when(_key() % 7 > 0, F.concat(F.lit("−"), F.col("o_custkey"), F.lit("%"))).otherwise(F.lit("—")),
        F.concat(F.lit("−"), F.col("o_custkey"), F.lit(" JPY")), F.format_number(_price() + 1, 2),
        F.when(_key() % 4 > 0, F.concat(F.col("o_custkey"), F.lit(" USD"))).otherwise(F.lit("—")),
    ]
    tab = F.when(F.col("o_orderstatus") == "P", F.lit("major")).when(F.col("o_orderstatus") == "F", F.lit("snp")).otherwise(F.lit("moon"))
    row = html_row(cells, F.concat(F.lit("E:"), _key()))
    bodies = html_bodies(
        t.orders, {"tab": tab}, page_of("o_orderkey"), ["o_orderkey"], row, ["Symbol", "Price", "Change %", "Change", "High", "Low"],
        footer="<tr><td></td><td></td></tr>",
    )
    return pages.indices(_raw(bodies, "TV", dataset=F.col("tab")))


def _group_bodies(t, own, other):
    """Suppliers as sectors or industries of their nation."""
    key, balance = F.col("s_suppkey"), F.abs(F.col("s_acctbal")).cast("string")
    cells = [
        html_link(F.concat(F.lit("/c/"), key), F.col("s_name")),
        F.concat(balance, F.lit(" T USD")),
        F.when(key % 3 == 0, F.lit("—")).otherwise(F.concat(balance, F.lit("%"))),
        F.concat(F.lit("−"), balance, F.lit("%")), F.concat(balance, F.lit(" K")), key % 9, key % 90,
    ]
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    bodies = html_bodies(
        rows, {"country": F.lower("n_name")}, page_of("s_suppkey"), ["s_suppkey"], html_row(cells, F.concat(F.lit("icb"), key)),
        [own, "Market cap", "Div yield % (indicated)", "Change %", "Volume", other, "Stocks"],
    )
    return _raw(bodies, "TV", dataset=F.col("country"))


GROUP_SQL = (
    "SELECT concat('icb', s_suppkey) AS icb_code, s_name AS {0}, abs(s_acctbal) * 1e12::DOUBLE AS marketcap, 'USD' AS cur, "
    "CASE WHEN s_suppkey % 3 > 0 THEN abs(s_acctbal) / 100.0::DOUBLE END AS divyield_percent, -(abs(s_acctbal) / 100.0::DOUBLE) AS rt, "
    "abs(s_acctbal) * 1e3::DOUBLE AS volume, (s_suppkey % 9)::VARCHAR AS {1}, (s_suppkey % 90)::VARCHAR AS stocks, concat('/c/', s_suppkey) AS component_url, "
    "lower(n_name) AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey"
)


@query("n37", GROUP_SQL.format("sector", "industries"))
def n37(t):
    return pages.sectors(_group_bodies(t, "Sector", "Industries"))


@query("n38", GROUP_SQL.format("industry", "sector"))
def n38(t):
    return pages.industries(_group_bodies(t, "Industry", "Sector"))


COMPONENT_SQL = (
    "SELECT concat('/c/', l_suppkey) AS component_url, concat('EX:P', l_partkey) AS codesource, concat('P', l_partkey) AS ticker, p_name AS name, "
    "l_extendedprice AS price, 'TWD' AS cur, CASE WHEN l_linenumber = 1 THEN NULL ELSE -(l_discount * 100 / 100.0::DOUBLE) END AS rt, l_quantity * 1e6::DOUBLE AS volume, "
    "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice * 1e9::DOUBLE END AS marketcap, l_quantity::VARCHAR AS relvolume, "
    "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax::VARCHAR END AS pe, '1' AS epsdilttm, '-2' AS epsdilgrowthttmyoy, '3' AS divyieldttm, "
    "l_returnflag AS analystrating, concat('/stock/', l_orderkey) AS stock_url FROM lineitem JOIN part ON l_partkey = p_partkey"
)


def _component_raw(t):
    """Order lines as shares on their supplier's page."""
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice")
    cells = [
        html_link(F.concat(F.lit("/stock/"), F.col("l_orderkey")), F.concat(F.lit("P"), F.col("l_partkey")), F.col("p_name")),
        F.concat(price.cast("string"), F.lit(" TWD")),
        F.when(line == 1, F.lit("—")).otherwise(F.concat(F.lit("−"), (F.col("l_discount") * 100).cast("string"), F.lit("%"))),
        F.concat(F.col("l_quantity"), F.lit(" M")),
        F.when(line == 2, F.lit("—")).otherwise(F.concat(price.cast("string"), F.lit(" B TWD"))),
        F.col("l_quantity"), F.when(line == 3, F.lit("—")).otherwise(F.col("l_tax").cast("string")), F.lit("1"), F.lit("−2"), F.lit("3"),
        F.col("l_returnflag"),
    ]
    header = [
        "Symbol", "Price", "Change %", "Volume", "Market cap", "Rel Volume", "P/E", "EPS dil TTM", "EPS dil growth TTM YoY",
        "Div yield % TTM", "Analyst Rating",
    ]
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    bodies = html_bodies(
        rows, {"supplier": F.col("l_suppkey")}, page_of("l_orderkey", 20000), ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
        html_row(cells, F.concat(F.lit("EX:P"), F.col("l_partkey"))), header,
    )
    return _raw(bodies, "TV", url=F.concat(F.lit("/c/"), F.col("supplier")))


@query("n39", COMPONENT_SQL)
def n39(t):
    return pages.components(_component_raw(t))


@query(
    "n43",
    f"SELECT 'sector' AS dataset, icb_code AS code, sector AS name, country, marketcap, rt FROM ({GROUP_SQL.format('sector', 'industries')}) UNION ALL "
    f"SELECT 'industry', icb_code, industry, country, marketcap, rt FROM ({GROUP_SQL.format('industry', 'sector')}) UNION ALL "
    f"SELECT 'components', codesource, name, NULL, marketcap, rt FROM ({COMPONENT_SQL})",
)
def n43(t):
    """Sectors, industries and components in one table; components have no country of their own."""
    sectors = pages.sectors(_group_bodies(t, "Sector", "Industries")).select(
        F.lit("sector").alias("dataset"), F.col("icb_code").alias("code"), F.col("sector").alias("name"), "country", "marketcap", "rt"
    )
    industries = pages.industries(_group_bodies(t, "Industry", "Sector")).select(
        F.lit("industry").alias("dataset"), F.col("icb_code").alias("code"), F.col("industry").alias("name"), "country", "marketcap", "rt"
    )
    components = pages.components(_component_raw(t)).select(
        F.lit("components").alias("dataset"), F.col("codesource").alias("code"), "name", "marketcap", "rt"
    )
    return union_all([sectors, industries, components])


REFRESH_SQL = (
    "(SELECT concat('/c/', s_suppkey) AS component_url, n_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900))"
)


def _component_plan(t):
    """Suppliers are the groups; countries with a rich customer count as stored; pages of shares sold out
    of stock are not landed."""
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    groups = places.select(F.concat(F.lit("/c/"), F.col("s_suppkey")).alias("component_url"), F.col("n_name").alias("country"))
    stored = t.customer.where("c_acctbal > 9900").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country")
    )
    landed = _component_raw(t).where("url <> '/c/1' AND url <> '/c/2' AND url <> '/c/3'")
    return component_rows(groups, stored, landed, "sector", AS_OF)


@query(
    "component_refresh",
    f"SELECT c.*, country, 'sector' AS dataset, TIMESTAMP '{AS_OF}' AS timestamp FROM ({COMPONENT_SQL}) c JOIN {REFRESH_SQL} USING (component_url) "
    "WHERE component_url NOT IN ('/c/1', '/c/2', '/c/3')",
)
def component_refresh(t):
    return _component_plan(t)[0]


@query(
    "component_failed",
    f"SELECT component_url, country FROM {REFRESH_SQL} WHERE component_url IN ('/c/1', '/c/2', '/c/3') "
    "OR component_url NOT IN (SELECT concat('/c/', l_suppkey) FROM lineitem)",
)
def component_failed(t):
    return _component_plan(t)[1]
