"""Words, codes and labels out of text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotemill.functions import as_column
from quotemill.functions.numbers import EM_DASH, fix_minus

# What Python's str.split() treats as a blank, Unicode blanks included.
_BLANK = r"(?U)[\s\x1c-\x1f]+"
_LEADING_BLANK = r"(?U)^[\s\x1c-\x1f]+"

# Market names and the codes they are stored under.
BOARD_CODES = {"UPCOM": "UPC"}
EXCHANGE_CODES = {"hose": "HSX", "hnx": "HNX"}
EXCHANGE_CODE_ELSE = "UPC"
# Index tabs and their titles.
TAB_TITLES = {
    "major": "World Indices",
    "snp": "S&P 500",
    "us": "US Indices",
    "americas": "Americas Indices",
    "currency": "Currencies",
    "europe": "European Indices",
    "asia": "Asian Indices",
    "pacific": "Pacific Indices",
    "middle-east": "Middle East Indices",
    "africa": "African Indices",
}
# Texts in the country column that are not countries.
NOT_COUNTRIES = ("CURRENCY", "SPOT", "INDICES", "SWAP", "FUTURES", "FUNDAMENTAL")


def extract_word(text, index: int, delimiter: str = "") -> Column:
    """The ``index``-th token, counted from 1; null when there are fewer."""
    text = as_column(text).cast("string")
    if delimiter:
        return F.try_element_at(F.split(text, re.escape(delimiter)), F.lit(index))
    stripped = F.regexp_replace(text, _LEADING_BLANK, "")
    word = F.try_element_at(F.split(stripped, _BLANK), F.lit(index))
    return F.when(word != "", word)


def clean_dash(text) -> Column:
    """A lone em dash is missing; the typographic minus becomes a hyphen."""
    text = as_column(text)
    return fix_minus(F.when(text != EM_DASH, text))


def first_token(text, delimiter: str) -> Column:
    """What stands before the first delimiter."""
    return F.get(F.split(as_column(text), re.escape(delimiter)), F.lit(0))


def symbol_split(text) -> Column:
    """"TICK\\nName" as struct(ticker, name); a missing part is the empty text."""
    parts = F.split(as_column(text), "\n")
    return F.struct(
        F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("ticker"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("name"),
    )


def country_key(text) -> Column:
    """"Hong Kong (SAR)" as "hong_kong_sar"."""
    return F.translate(F.lower(as_column(text)), " -()", "__")


def country_slug(text) -> Column:
    """"Hong Kong" as "hong-kong", the form used in addresses."""
    return F.translate(F.lower(as_column(text)), " ", "-")


def code_map(text, codes: dict[str, str], otherwise=None) -> Column:
    """The code a text stands for; ``otherwise`` (a column or value, default: the text itself) if none."""
    text = as_column(text)
    result = text if otherwise is None else otherwise
    result = result if isinstance(result, Column) else F.lit(result)
    for name, code in codes.items():
        result = F.when(text == name, F.lit(code)).otherwise(result)
    return result


def stoplist_blank(text, stoplist=NOT_COUNTRIES) -> Column:
    """Blank when the text is on the stop list."""
    text = as_column(text)
    return F.when(text.isin(*stoplist), F.lit("")).otherwise(text)


def ascii_only(text) -> Column:
    """Every character outside ASCII removed."""
    return F.regexp_replace(as_column(text), r"[^\x00-\x7F]+", "")


def asset_flag(kind) -> Column:
    """"index" is IND, anything else STK."""
    return F.when(as_column(kind) == "index", F.lit("IND")).otherwise(F.lit("STK"))


def key_and_rest(text) -> Column:
    """"Label\\na\\nb" as struct(key "Label", value "a b"); no value when there is only the label."""
    lines = F.split(as_column(text), "\n")
    return F.struct(
        F.get(lines, F.lit(0)).alias("key"),
        F.when(F.size(lines) > 1, F.array_join(F.slice(lines, F.lit(2), F.size(lines)), " ")).alias("value"),
    )


def one_line(text) -> Column:
    """Lines joined by a space."""
    return F.array_join(F.split(as_column(text), r"\r?\n"), " ")


def any_cell_contains(columns, phrase: str) -> Column:
    """True when any of the columns holds the phrase, whatever its case."""
    joined = F.concat_ws("\u0001", *[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns])
    return F.lower(joined).contains(phrase.lower())
