"""Landed bodies rendered from typed tables, so that a normaliser's result can be checked.

A body holds a bounded page of rows (a fixed range of a unique key), never a whole ticker: one long
series must not become one huge row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.sources.tables import landing

PAGE_KEYS = 1000


def page_of(key: str, keys: int = PAGE_KEYS) -> Column:
    return F.floor(F.col(key) / keys)


Rendered = Callable[[Callable[[str], Column]], Column]  # an entry out of a row's columns, which it asks for by name


def paged(df: DataFrame, ids: list, page: Column, order: list[str], fields: list[str], made: Rendered | None = None) -> DataFrame:
    """The rows of each (ids, page) as the array column ``rows``, in order, or what ``made`` renders of each.

    Rendering comes after the grouping, so that the typed columns are shuffled and not the longer texts."""
    names = [*order, *[f for f in fields if f not in order]]
    rows = F.sort_array(F.collect_list(F.struct(*names)))
    return df.groupBy(*ids, page.alias("page")).agg((rows if made is None else F.transform(rows, lambda r: made(r.getField))).alias("rows"))


def seconds(time: str) -> Column:
    return F.unix_seconds(F.col(time).cast("timestamp"))


def chart_bodies(ticks: DataFrame) -> DataFrame:
    """Parallel arrays per ticker and page. The form varies with the ticker number and the page:
    an offset of +7 h, -5 h, 0 or none; no adjusted closes for every third ticker; on even pages a
    volume array that is one short."""
    rows = paged(
        ticks.withColumn("t", seconds("ts")).withColumn("user", F.substring("ticker", 2, 20).cast("bigint")),
        ["ticker", "user"], page_of("event_id"), ["ts", "event_id"], ["t", "price", "size"],
    )
    offset = (
        F.when(F.col("user") % 4 == 0, F.lit(25200.0))
        .when(F.col("user") % 4 == 1, F.lit(-18000.0))
        .when(F.col("user") % 4 == 2, F.lit(0.0))
    )
    price = F.col("rows.price")
    volume = F.when(
        F.col("page") % 2 == 0, F.slice(F.col("rows.size"), F.lit(1), F.size("rows") - 1)
    ).otherwise(F.col("rows.size"))
    adjusted = F.transform(price, lambda p: p / 2)
    result = F.struct(
        F.struct(F.col("ticker").alias("symbol"), offset.alias("gmtoffset")).alias("meta"),
        F.col("rows.t").alias("timestamp"),
        F.struct(
            F.array(
                F.struct(
                    price.alias("open"),
                    F.transform(price, lambda p: p + 1).alias("high"),
                    F.transform(price, lambda p: p - 1).alias("low"),
                    price.alias("close"),
                    volume.alias("volume"),
                )
            ).alias("quote"),
            F.when(F.col("user") % 3 > 0, F.array(F.struct(adjusted.alias("adjclose")))).alias("adjclose"),
        ).alias("indicators"),
    )
    body = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")))
    return landing(rows, "YAH", "chart", body, symbol=F.col("ticker"), page=F.col("page").cast("int"))


def flat_bodies(ticks: DataFrame) -> DataFrame:
    """Flat parallel arrays per ticker and page; even tickers are indices, every fifth page is not "ok"."""
    user = F.substring("ticker", 2, 20).cast("bigint")
    rows = paged(
        ticks.withColumn("t", seconds("ts")).withColumn("user", user),
        ["ticker", "user"], page_of("event_id"), ["ts", "event_id"], ["t", "price", "size"],
    )
    price = F.col("rows.price")
    body = F.to_json(
        F.struct(
            F.col("rows.t").alias("t"), price.alias("o"), F.transform(price, lambda p: p + 1).alias("h"),
            F.transform(price, lambda p: p - 1).alias("l"), price.alias("c"), F.col("rows.size").alias("v"),
            F.when(F.col("page") % 5 == 0, F.lit("no_data")).otherwise(F.lit("ok")).alias("s"),
            F.lit(0).alias("nextTime"),
        )
    )
    kind = F.when(F.col("user") % 2 == 0, F.lit("index")).otherwise(F.lit("stock"))
    return landing(rows, "FLAT", kind, body, symbol=F.col("ticker"), page=F.col("page").cast("int"))


def record_bodies(
    df: DataFrame, symbol: Column, page: Column, order: list[str], record: Rendered, wrap=None, fields: tuple[str, ...] = ()
) -> DataFrame:
    """JSON arrays of records per symbol and page; ``wrap`` puts the array into its document. A record is made of
    the ``order`` columns and ``fields``."""
    rows = paged(df.withColumn("_symbol", symbol), ["_symbol"], page, order, [*fields], record)
    records = F.col("rows")
    body = F.to_json(records if wrap is None else wrap(records))
    return landing(rows, "TEST", "records", body, symbol=F.col("_symbol"), page=F.col("page").cast("int"))


def html_row(cells: list, key: Column | None = None, tag: str = "td") -> Column:
    """A table row; null cells are empty."""
    opening = F.lit("<tr>") if key is None else F.concat(F.lit('<tr data-rowkey="'), key, F.lit('">'))
    parts = [opening]
    for value in cells:
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        parts += [F.lit(f"<{tag}>"), F.coalesce(value, F.lit("")), F.lit(f"</{tag}>")]
    return F.concat(*parts, F.lit("</tr>"))


def html_bodies(
    df: DataFrame,
    ids: dict[str, Column],
    page: Column,
    order: list[str],
    row: Column,
    header: list[str] | None,
    before: str = "",
    footer: str = "",
    after: Column | None = None,
) -> DataFrame:
    """One page with one table per (ids, page): columns of ``ids``, page and body."""
    rows = paged(df.withColumns({**ids, "_tr": row}), list(ids), page, order, ["_tr"])
    head = "<tr>" + "".join(f"<th>{name}</th>" for name in header) + "</tr>" if header else ""
    body = F.concat(
        F.lit(f"<html><body>{before}<table>{head}"), F.array_join("rows._tr", ""), F.lit(f"{footer}</table>"),
        F.lit("") if after is None else after, F.lit("</body></html>"),
    )
    return rows.select(*ids, F.col("page").cast("int").alias("page"), body.alias("body"))


def html_pair(label: str, value: Column, outer: str = "li", inner: str = "span") -> Column:
    """A label next to its value."""
    return F.concat(
        F.lit(f"<{outer}><{inner}>{label}</{inner}><{inner}>"), value.cast("string"), F.lit(f"</{inner}></{outer}>")
    )


def html_link(href: Column, text: Column, description: Column | None = None) -> Column:
    parts = [F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>")]
    if description is not None:
        parts += [F.lit("<sup>"), description, F.lit("</sup>")]
    return F.concat(*parts)
