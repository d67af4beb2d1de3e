"""Reads of landed documents, files, delimited text and stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.filters import inner_rows, nonempty_cells
from quotemill.queries.registry import DAILY, query
from quotemill.render import html_bodies, html_row, landing, page_of, paged
from quotemill.schemas import COUNTRIES_DOC
from quotemill.session import scratch
from quotemill.sources import files, lines, markup
from quotemill.sources.tables import append_raw, query_frame, read_landing, scan_where


@query("raw_scan", "SELECT o_orderkey::VARCHAR AS symbol, o_orderpriority AS body FROM orders WHERE o_orderstatus = 'F'")
def raw_scan(t):
    path = scratch(t.spark, "landing")
    raw = landing(t.orders, "TEST", "orders", F.col("o_orderpriority"), symbol=F.col("o_orderkey"), title=F.col("o_orderstatus"))
    append_raw(raw.where("title <> 'F'"), path, "2025-01-02 16:00:00")
    append_raw(raw.where("title = 'F'"), path, "2025-01-03 16:00:00")
    return read_landing(t.spark, path, day="2025-01-03").select("symbol", "body")


@query(
    "json_docs",
    "SELECT r_name AS region, c_name AS country, lower(n_name) AS data_market FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
def json_docs(t):
    """One JSON array per file, as the countries documents come; customers stand for countries."""
    country = F.struct(F.col("c_name").alias("country"), F.lower("n_name").alias("data_market"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    regions = (
        t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_regionkey", F.col("r_name").alias("region"), page_of("c_custkey", 20000).alias("page"))
        .agg(F.array_sort(F.collect_list(country)).alias("countries"))
    )
    path = scratch(t.spark, "json")
    body = F.to_json(F.array(F.struct("region", "countries"))).alias("value")
    regions.select("r_regionkey", "page", body).write.partitionBy("page", "r_regionkey").text(path)
    element = COUNTRIES_DOC[len("array<struct<"):-2]
    docs = files.read_json_documents(t.spark, path, element.replace("region: string, countries: ", "region string, countries "))
    return docs.select("region", F.inline("countries")).select("region", "country", "data_market")


@query("ticker_list", "SELECT DISTINCT p_name AS yah FROM part WHERE p_size % 3 > 0")
def ticker_list(t):
    path = scratch(t.spark, "tickers")
    listing = t.part.select(
        F.col("p_partkey").alias("code"), F.when(F.col("p_size") % 3 > 0, F.col("p_name")).alias("yah"), "p_size"
    )
    files.export_csv(listing, path)
    text = files.read_csv_text(t.spark, path, ["code", "yah", "p_size"], keep=["yah"])
    return files.distinct_values(text, "yah")


def _versions(t) -> str:
    """A folder of two versions; the newer one is written first, in as many files as there are tasks."""
    path = scratch(t.spark, "newest")
    rows = t.part.select("p_partkey", "p_name", "p_size").repartition(8, "p_partkey")
    for version, half in (("20250103_1600", "p_size >= 25"), ("20250102_1600", "p_size < 25")):
        rows.where(half).select("p_partkey", "p_name").write.csv(f"{path}/version={version}")
    return path


@query("newest_file", "SELECT p_partkey, p_name FROM part WHERE p_size >= 25")
def newest_file(t):
    return files.newest_file(t.spark, _versions(t), "p_partkey bigint, p_name string")


@query("stream_newest_file", "SELECT p_partkey, p_name, '20250103_1600' AS version FROM part WHERE p_size >= 25")
def stream_newest_file(t):
    """The same folder as a stream, three files at a time; rows are stored by version and the newest is read."""
    schema = T.StructType.fromDDL("p_partkey bigint, p_name string")
    rows = files.newest_stream(t.spark, _versions(t), schema, 3)
    out = scratch(t.spark, "newest-rows")
    store = rows.writeStream.partitionBy("version").option("checkpointLocation", scratch(t.spark, "newest-checkpoint"))
    store.trigger(availableNow=True).start(out).awaitTermination()
    stored = t.spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())])).parquet(out)
    return stored.where(F.col("version") == stored.agg(F.max("version")).first()[0])


@query("eod_lines", f"SELECT ticker::VARCHAR AS codesource, date, close, volume FROM {DAILY}")
def eod_lines(t):
    """Bodies hold the lines of their own symbol and some of another one."""
    own = lambda c: F.concat_ws(",", *[c(name).cast("string") for name in ("ticker", "date", "close", "volume")])
    rows = paged(t.daily, ["ticker"], page_of("o"), ["date", "o", "n", "s"], ["ticker", "close", "volume"], own)
    body = F.concat(F.lit("header\nx99,2025-01-01,1,1\n"), F.array_join("rows", "\n"))
    raw = landing(rows, "ETFDB", "eod", body, symbol=F.col("ticker"))
    return lines.coded_lines(raw, [], "codesource string, date date, close double, volume double")


@query(
    "pipe_records",
    "SELECT o_orderkey::VARCHAR AS ticker, o_orderstatus AS status, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS last, '' AS tail FROM orders",
)
def pipe_records(t):
    last = F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit("x*"), F.col("o_totalprice"))).otherwise(F.lit("x"))
    record = F.concat_ws("|", F.concat(F.lit('"'), F.col("o_orderkey"), F.lit('"')), "o_orderstatus", last, F.lit(""))
    raw = t.orders.groupBy(page_of("o_orderkey").alias("page")).agg(F.collect_list(record).alias("records"))
    rows = lines.pipe_records(raw, [], "records")
    return rows.select(
        F.translate(F.get("fields", F.lit(0)), '"', "").alias("ticker"),
        F.get("fields", F.lit(1)).alias("status"),
        F.try_element_at(F.split(F.get("fields", F.lit(2)), r"\*"), F.lit(2)).try_cast("double").alias("last"),
        F.get("fields", F.lit(3)).alias("tail"),
    )


def _order_tables(t):
    """Pages of orders as two tables; a bad colspan, escaped text, a link per row, unclosed cells."""
    row = F.concat(
        F.lit('<tr data-rowkey="k'), F.col("o_orderkey"), F.lit('"><td><a href="/o/'), F.col("o_orderkey"), F.lit('">'),
        F.col("o_orderstatus"), F.lit('</a></td><td colspan="x">'), F.col("o_custkey"), F.lit(" &amp; co<td>"),
        F.format_number("o_totalprice", 2), F.lit("</tr>"),
    )
    rows = paged(t.orders.withColumn("tr", row), [], page_of("o_orderkey"), ["o_orderkey"], ["tr"])
    body = F.concat(
        F.lit("<html><body><table><tr><th>first</th></tr></table><h3>Orders</h3><table><thead><tr><th>Status</th><th>Who</th><th>Total</th></tr></thead><tbody>"),
        F.array_join("rows.tr", ""),
        F.lit("</tbody></table></body></html>"),
    )
    return landing(rows, "TEST", "tables", body, page=F.col("page").cast("int"), url=F.concat(F.lit("/p/"), F.col("page")))


@query(
    "html_table_rows",
    "SELECT concat('/p/', o_orderkey // 1000) AS url, CAST(row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) AS INT) AS row_no, "
    "CAST(1 + count(*) OVER (PARTITION BY o_orderkey // 1000) AS INT) AS n_rows, concat('k', o_orderkey) AS row_key, 'Orders' AS heading, "
    "o_orderstatus AS status, concat(o_custkey, ' & co') AS who, o_totalprice AS total, concat('/o/', o_orderkey) AS href FROM orders",
)
def html_table_rows(t):
    from quotemill.functions.numbers import clean_number

    rows = markup.table_rows(_order_tables(t), ["url"]).where("table_no = 1 AND NOT is_head")
    cell = lambda i: F.get("cells", F.lit(i))
    return rows.select(
        "url", "row_no", "n_rows", "row_key", "heading", cell(0).alias("status"), cell(1).alias("who"),
        clean_number(cell(2)).alias("total"), F.get("hrefs", F.lit(0)).alias("href"),
    )


@query(
    "html_table_sql",
    "SELECT concat('/p/', o_orderkey // 1000) AS url, CAST(row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) AS INT) AS row_no, "
    "o_orderstatus AS status FROM orders",
)
def html_table_sql(t):
    """The same parser as a table function in SQL: every page is parsed once for all its tables."""
    markup.register_html_table(t.spark)
    return query_frame(
        t.spark,
        "SELECT id AS url, row_no, cells[0] AS status FROM html_tables(TABLE(SELECT url, body FROM qm_pages)) "
        "WHERE table_no = :table AND row_no > 0",
        {"qm_pages": _order_tables(t).select("url", "body")},
        table=1,
    )


@query(
    "html_table_lateral",
    "SELECT concat('/p/', o_orderkey // 1000) AS url, count(*) AS rows, max(o_totalprice) AS largest FROM orders GROUP BY ALL",
)
def html_table_lateral(t):
    """One table of each page, as a lateral join."""
    markup.register_html_table(t.spark)
    return query_frame(
        t.spark,
        "SELECT url, count(*) AS rows, max(CAST(translate(cells[2], ',', '') AS DOUBLE)) AS largest "
        "FROM qm_pages, LATERAL html_table(body, :table) WHERE row_no > 0 GROUP BY url",
        {"qm_pages": _order_tables(t).select("url", "body")},
        table=1,
    )


@query(
    "nonempty_rows",
    "SELECT concat('k', o_orderkey) AS row_key, o_orderstatus AS status, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority ELSE '' END AS priority FROM orders WHERE o_orderkey % 4 > 0",
)
def nonempty_rows(t):
    """Rows without any text in any cell are left out; rows with some stay."""
    status = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).otherwise(F.lit(" "))
    priority = F.when((F.col("o_orderkey") % 4 > 0) & (F.col("o_orderkey") % 3 > 0), F.col("o_orderpriority"))
    row = html_row([status, priority], F.concat(F.lit("k"), F.col("o_orderkey")))
    bodies = html_bodies(t.orders, {}, page_of("o_orderkey"), ["o_orderkey"], row, ["Status", "Priority"])
    rows = nonempty_cells(markup.table_rows(bodies, ["page"]).where("NOT is_head"))
    return rows.select("row_key", F.get("cells", F.lit(0)).alias("status"), F.get("cells", F.lit(1)).alias("priority"))


@query("trim_rows", "SELECT o_orderkey::VARCHAR AS key, o_orderstatus AS status FROM orders")
def trim_rows(t):
    """Header and footer rows of each table are left out; they are plain cells here."""
    bodies = html_bodies(
        t.orders, {}, page_of("o_orderkey"), ["o_orderkey"], html_row([F.col("o_orderkey"), F.col("o_orderstatus")]), None,
        before="<p>rows</p>", footer="<tr><td>total</td><td>-</td></tr>",
    )
    headed = bodies.withColumn("body", F.replace("body", F.lit("<table>"), F.lit("<table><tr><td>Key</td><td>Status</td></tr>")))
    rows = inner_rows(markup.table_rows(headed, ["page"]))
    return rows.select(F.get("cells", F.lit(0)).alias("key"), F.get("cells", F.lit(1)).alias("status"))


ITEM_SQL = (
    "WITH li AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 0)) AS item FROM pages) "
)


@query(
    "html_list_items",
    ITEM_SQL + "SELECT page_id, regexp_extract(item, 'href=\"([^\"]*)\"', 1) AS href, regexp_extract(item, '\">([^<]*)</a>', 1) AS text FROM li",
)
def html_list_items(t):
    items = markup.list_items(t.pages, ["page_id"], "html")
    return items.where("href IS NOT NULL").select("page_id", "href", "text")


@query(
    "html_links",
    "WITH a AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'g'), '<a href=\"[^\"]*\"', 0)) AS tag FROM pages) "
    "SELECT page_id, regexp_extract(tag, 'href=\"([^\"]*)\"', 1) AS href, count(*) AS times FROM a GROUP BY ALL",
)
def html_links(t):
    found = markup.links(t.pages, ["page_id"], "html")
    return found.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("times"))


@query(
    "html_kv",
    "SELECT concat('/o/', o_orderkey) AS url, o_totalprice * 1e6::DOUBLE AS marketcap, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey::DOUBLE * 1e3::DOUBLE END AS shares, o_orderpriority AS rating FROM orders",
)
def html_kv(t):
    from quotemill.functions.numbers import suffix_number
    from quotemill.operators.unions import widen

    shares = F.when(
        F.col("o_orderkey") % 3 > 0,
        F.concat(F.lit('<div><div class="l">Shares:</div><div class="r">'), F.col("o_custkey"), F.lit("K</div></div>")),
    ).otherwise(F.lit(""))
    body = F.concat(
        F.lit("<html><body><ul><li><span>Market Cap</span><span>"), F.format_number("o_totalprice", 2), F.lit("M</span></li></ul>"),
        shares, F.lit("<table><tr><th>Rating</th><td>"), F.col("o_orderpriority"), F.lit("</td></tr></table></body></html>"),
    )
    raw = landing(t.orders, "TEST", "kv", body, url=F.concat(F.lit("/o/"), F.col("o_orderkey")))
    pairs = markup.label_values(raw, ["url"])
    labels = {"Market Cap": "marketcap", "Shares:": "shares", "Rating": "rating"}
    wide = widen(pairs, ["url"], "label", "value", "pos", labels)
    return wide.select("url", suffix_number("marketcap").alias("marketcap"), suffix_number("shares").alias("shares"), "rating")


@query(
    "html_titles",
    "SELECT page_id, url, regexp_extract(html, '<a href=\"([^\"]*)\"', 1) AS first_href, regexp_extract(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1) AS first_text FROM pages",
)
def html_titles(t):
    return markup.titles(t.pages, ["page_id", "url"], "html").select("page_id", "url", "first_href", "first_text")


@query("scan_country", "SELECT c_custkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'")
def scan_country(t):
    """A table partitioned by country: the equality prunes folders."""
    path = scratch(t.spark, "customers")
    stored = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    stored.write.partitionBy("country").parquet(path)
    table = t.spark.read.schema(stored.schema).parquet(path)
    return scan_where(table, country="NATION_7")


@query("param_sql", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000")
def param_sql(t):
    return query_frame(
        t.spark,
        "SELECT o_orderkey, o_totalprice FROM qm_orders WHERE o_orderstatus = :status AND o_totalprice >= :least",
        {"qm_orders": t.orders},
        status="F",
        least=100000.0,
    )
