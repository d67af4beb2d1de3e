"""Components of sectors and industries: which pages to read, and their rows ready to store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.normalise.pages import components
from quotemill.operators.joins import expand_components, missing


def pages_to_read(groups: DataFrame, stored: DataFrame) -> DataFrame:
    """Pages of the countries that have no components stored; one anti join instead of a count per country."""
    return missing(groups.select("component_url", "country"), stored, "country").distinct()


def component_rows(groups: DataFrame, stored: DataFrame, raw: DataFrame, dataset: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Component rows of those pages as the table stores them, and pages that gave no rows.

    ``raw`` are the landed pages; only those asked for are parsed.
    """
    wanted = pages_to_read(groups, stored)
    landed = raw.join(wanted.select(F.col("component_url").alias("url")), "url", "left_semi")
    found, failed = expand_components(wanted, components(landed))
    tagged = found.withColumns({"dataset": F.lit(dataset), "timestamp": F.lit(as_of).cast("timestamp_ntz")})
    return tagged, failed
