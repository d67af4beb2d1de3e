"""Column functions: numbers, texts and times. All are native expressions, none is a UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """A column from a name or a column."""
    return F.col(value) if isinstance(value, str) else value
