"""Keyed tables on parquet: an insert overwrites the cells it names.

A stored table has one row per key. Writing a null overwrites; a column the delta does not have
stays as it was. ``order`` puts the rows of one delta in order, the last one winning per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.latest import keep_last


def merge_rows(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The table after the delta.

    The delta collapses to one row per key first (a partial aggregate, so hot keys are harmless);
    the full outer join then meets at most one row per key on either side. A null in a key is an error:
    it would match nothing and pile up. So is a key that repeats when no order says which row is the last.
    """
    # Checked ahead of the aggregate, whose partitioning the join then reuses.
    whole = delta.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"null in key {k}"))) for k in keys})
    newest = keep_last(whole, keys, order) if order else _only_rows(whole, keys)
    written = [
        name for name in delta.columns if name not in keys and (name in base.columns or name not in order)
    ]
    left = base.withColumn("_stored", F.lit(True))
    right = newest.select(*keys, *[F.col(name).alias(f"_new_{name}") for name in written]).withColumn(
        "_sent", F.lit(True)
    )
    both = left.join(right, list(keys), "full_outer")
    columns = []
    for name in [*base.columns, *[n for n in written if n not in base.columns]]:
        if name in keys:
            columns.append(F.col(name))
        elif name not in written:
            columns.append(F.col(name))
        elif name not in base.columns:
            columns.append(F.col(f"_new_{name}").alias(name))
        else:
            columns.append(
                F.when(F.col("_sent"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            )
    return both.select(*columns)


def _only_rows(delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a delta whose keys do not repeat; a key that does is an error."""
    others = [name for name in delta.columns if name not in keys]
    counted = delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.first(name).alias(name) for name in others])
    once = F.when(F.col("_rows") == 1, F.col(keys[0])).otherwise(F.raise_error(F.lit(f"a key ({', '.join(keys)}) repeats and no order is given")))
    return counted.withColumn(keys[0], once).select(*delta.columns)


def merge_sparse(base: DataFrame, deltas: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Several deltas with different columns, applied one after the other."""
    for delta in deltas:
        base = merge_rows(base, delta, keys, order)
    return base


class KeyedTable:
    """A parquet folder with one row per key, partitioned by coarse columns derived from the key.

    A write reads and rewrites only the partitions the delta touches. The merged rows are staged next
    to the table and a journal says so; a run that dies during the swap is finished by the next one
    from the stage, so no partition is lost, and repeating a batch changes nothing. Writes to one
    table follow each other: there is one stage and one journal entry. Reading writes nothing, and while
    a swap is under way it takes the partitions concerned from the stage.
    """

    _JOURNAL = "event string"

    def __init__(self, spark, path: str, schema: T.StructType, keys: Sequence[str], partition_by: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.partition_by = list(partition_by)

    def side(self, name: str) -> str:
        """A folder next to the table."""
        return f"{self.path}-{name}"

    def _rows(self, path: str) -> DataFrame:
        """The rows of a folder; none when nobody has written it yet."""
        try:
            return self.spark.read.schema(self.schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # Known to the planner as empty, so that a merge into it joins nothing, and made without Python.
            columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in self.schema.fields]
            return self.spark.range(1).select(*columns).limit(0)

    def read(self) -> DataFrame:
        stored = self._rows(self.path)
        if self._event() != "swapping":
            return stored
        staged = self._rows(self.side("stage"))
        # A row per folder of the stage; folders are compared, not keys, as whole folders are replaced.
        folders = staged.select(*[F.col(name).alias(f"_{name}") for name in self.partition_by]).distinct()
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in self.partition_by]
        return stored.join(folders, same, "left_anti").unionByName(staged)

    def _event(self) -> str | None:
        """What the journal says; nothing before the first write."""
        try:
            entry = self.spark.read.schema(self._JOURNAL).json(self.side("journal")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return entry and entry["event"]

    def _note(self, event: str) -> None:
        # If this dies half way, the entry is gone: before the swap that is as if nothing had been
        # staged, after it as if it had been noted.
        entry = self.spark.range(1).select(F.lit(event).alias("event"))
        entry.coalesce(1).write.mode("overwrite").json(self.side("journal"))

    def _swap(self) -> None:
        self._note("swapping")
        staged = self.spark.read.schema(self.schema).parquet(self.side("stage"))
        # Rebalanced, so that a big folder gets several files and small ones few; sorted by key inside,
        # so that the files' statistics help a later read of few keys.
        spread = staged.hint("rebalance", *self.partition_by).sortWithinPartitions(*dict.fromkeys([*self.partition_by, *self.keys]))
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *self.partition_by
        ).parquet(self.path)
        self._note("swapped")

    def recover(self) -> None:
        """Finish a swap that was staged but not completed."""
        if self._event() in ("staged", "swapping"):
            self._swap()

    def upsert(self, delta: DataFrame, order: Sequence[str] = ()) -> None:
        """Apply the delta; it must hold the keys and the partition columns. It is read twice."""
        self.recover()
        # One row per folder comes to the driver, which lists the folders anyway.
        touched = [tuple(row) for row in delta.select(*self.partition_by).distinct().collect()]
        if not touched:
            return
        base = self._rows(self.path)
        for i, name in enumerate(self.partition_by):  # literals, so that the listing is pruned
            base = base.where(F.col(name).isin(*{values[i] for values in touched}))
        merged = merge_rows(base, delta, list(dict.fromkeys([*self.keys, *self.partition_by])), order)
        merged.select(*self.schema.names).write.mode("overwrite").parquet(self.side("stage"))
        self._note("staged")
        self._swap()
