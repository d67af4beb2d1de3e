"""Numbers out of text."""

from __future__ import annotations

from string import ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotemill.functions import as_column

# A plain decimal with optional exponent. Keeps "nan", "inf" and Java's "1d"/"1f" out.
_DECIMAL = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_WHOLE_DECIMAL = rf"(?U)^\s*({_DECIMAL})\s*$"

# What a unit letter stands for.
UNIT_FACTORS = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}

MINUS = "\u2212"  # the typographic minus sign
EM_DASH = "\u2014"


def plain_number(text) -> Column:
    """The text as a double when it is a plain decimal, else null. Commas are not accepted."""
    return F.regexp_extract(as_column(text).cast("string"), _WHOLE_DECIMAL, 1).try_cast("double")


def clean_number(text) -> Column:
    """Thousands commas removed, then :func:`plain_number`."""
    return plain_number(F.replace(as_column(text).cast("string"), F.lit(","), F.lit("")))


def clean_numeric(text, factor: float) -> Column:
    """:func:`clean_number` times a factor."""
    return F.lit(float(factor)) * clean_number(text)


def clean_varpc(text) -> Column:
    """Parentheses and percent sign removed, then :func:`clean_number`."""
    return plain_number(F.translate(as_column(text), "()%,", ""))


def fix_minus(text) -> Column:
    """The typographic minus sign as a hyphen."""
    return F.replace(as_column(text), F.lit(MINUS), F.lit("-"))


def percent_fraction(text, default: float | None = None) -> Column:
    """"−1.2%" as -0.012."""
    fraction = plain_number(F.translate(as_column(text), f"{MINUS}()%,", "-")) / F.lit(100.0)
    return fraction if default is None else F.coalesce(fraction, F.lit(float(default)))


def _unit_factor(unit: Column) -> Column:
    """What the letter stands for; 1 if it is none of the known."""
    factors = F.create_map(*[F.lit(part) for pair in UNIT_FACTORS.items() for part in pair])
    return F.coalesce(F.try_element_at(factors, unit), F.lit(1.0))


def suffix_number(text) -> Column:
    """"1.2B" as 1.2e9; a number without a unit letter stays as it is."""
    text = F.trim(as_column(text))
    unit = F.right(text, F.lit(1))
    number = F.when(unit.isin(*UNIT_FACTORS), F.left(text, F.length(text) - 1)).otherwise(text)
    return clean_number(number) * _unit_factor(unit)


def money_text(text) -> Column:
    """"2.92 T USD" as struct(value 2.92e12, currency "USD").

    The capitals at the end are a unit, a currency, or both: one letter or the first of four is a unit if it is one of the
    known, so "100 TWD" is 100 of TWD.
    """
    packed = fix_minus(text)
    for blank in "\u202f\u00a0 ,":
        packed = F.replace(packed, F.lit(blank), F.lit(""))
    amount = F.rtrim(packed, F.lit(ascii_uppercase))
    letters = F.substr(packed, F.length(amount) + 1)
    factor = _unit_factor(F.when(F.length(letters).isin(1, 4), F.left(letters, F.lit(1))))
    number = plain_number(amount)
    currency = F.when(factor > 1, F.substr(letters, F.lit(2))).otherwise(letters)
    return F.struct((number * factor).alias("value"), F.when(number.isNotNull(), currency).alias("currency"))


def price_ccy(text) -> Column:
    """"1,234.5 USD" as struct(price, currency): three capitals at the end are the currency; the sign is kept."""
    text = F.trim(fix_minus(text))
    code = F.right(text, F.lit(3))
    currency = F.when((code == F.upper(code)) & code.rlike("^[A-Z]+$") & (F.length(code) == 3), code)
    amount = F.when(currency.isNull(), text).otherwise(F.left(text, F.length(text) - 3))
    return F.struct(plain_number(F.regexp_replace(amount, "[^0-9.+-]", "")).alias("price"), currency.alias("currency"))


def change_pct(text) -> Column:
    """"0.5(1.2%)" as struct(change 0.5, varpc 1.2): a number, and in brackets one with a percent sign."""
    parts = F.split(as_column(text), "[(%]")
    percent = F.when(F.size(parts) > 2, F.get(parts, F.lit(1)))
    return F.struct(plain_number(F.get(parts, F.lit(0))).alias("change"), plain_number(percent).alias("varpc"))


def dollar_number(text) -> Column:
    """"$1,234.50" as 1234.5."""
    return plain_number(F.translate(as_column(text), "$,", ""))


def int_or_zero(text) -> Column:
    """A whole number; anything that is not a number counts as 0."""
    return F.coalesce(plain_number(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def digits_only(text) -> Column:
    """Every non-digit removed, then a whole number."""
    return F.regexp_replace(as_column(text), r"[^0-9]", "").try_cast("bigint")


def fixed_decimals(number, digits: int = 2) -> Column:
    """A number as text with a fixed count of decimals and no thousands commas; null stays null."""
    number = as_column(number)
    return F.when(number.isNotNull(), F.format_string(f"%.{int(digits)}f", number.cast("double")))


def nan_to_null(number) -> Column:
    """NaN is missing, not a value: it would sort above everything and poison sums."""
    number = as_column(number)
    return F.when(~F.isnan(number), number)
