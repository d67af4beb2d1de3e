"""What several operators share: reading the two columns they need, lower case of A-Z, names of hidden columns."""

from __future__ import annotations

import string
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import configure
from quotemill.shipping import ship_by_value

BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty one. Other columns, whatever their names, go no further."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are. Pure ASCII texts take the faster ``lower``."""
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def smallest_hashes(rows: DataFrame, h: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hashes ``h``.

    Hashes are even, so about twice as many rows lie below a border known from the count; only those are sorted, and
    what meets in one task is bounded by ``n``, not by the number of tasks.
    """
    share = min(1.0, 2 * n / max(1, rows.count()))
    border = min(2**63 - 1, int(-(2**63) + share * 2**64))
    return rows.where(F.col(h) <= F.lit(border)).orderBy(h, *ties).limit(n)


def clear_of(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def kept_in_worker(name: str, version, make: Callable):
    """``make()``, kept for later tasks of the same Python worker: loading a vocabulary takes longer than a small task.

    One object per name (`operator/object`); a call with another ``version`` replaces it, and a call of another operator
    drops what the one before kept. What is kept must be the same for every task.
    """
    held = sys.__dict__.setdefault("_quotemill_kept", {})
    for other in [k for k in held if k.split("/")[0] != name.split("/")[0]]:
        del held[other]
    if name not in held or held[name][0] != version:
        held[name] = (version, make())
    return held[name][1]


ship_by_value(__name__)
