"""Keyed tables whose files are bucketed and sorted by the key.

An upsert joins the stored rows to the delta bucket by bucket: the stored side, large as it may be, is not shuffled, only the
delta is. The result goes to the one of two places that readers do not use; noting its version makes it the table. A run
that dies before the note leaves the table as it was, so there is nothing to recover, and a reader never sees half a write.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.merge import merge_rows
from quotemill.session import written_once

BUCKET_BYTES = 256 << 20
_NOTE = "version bigint, buckets int, bytes bigint, slot string"
_SLOTS = ("a", "b")


class BucketedTable:
    """A table with one row per key under a folder, in buckets of about ``bucket_bytes``.

    The buckets of the first version follow from ``buckets``; later ones double them when the files have outgrown them, which
    shuffles the stored rows that one time. Writes to one table follow each other. A frame from :meth:`read` stays good
    through one later write and not through a second one, which needs its place.
    """

    def __init__(self, spark, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 8, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.buckets, self.bucket_bytes = buckets, bucket_bytes

    def current(self):
        """The note of the newest complete version; None before the first write."""
        try:
            notes = self.spark.read.schema(_NOTE).json(f"{self.path}/notes")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return notes.orderBy(F.desc("version")).first()  # two rows at most

    def _name(self, slot: str) -> str:
        return f"qm_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{slot}"

    def _stored(self, note) -> DataFrame:
        """The files of a version as a table of the session's catalog, which is how Spark learns of buckets."""
        name, keys = self._name(note["slot"]), ", ".join(f"`{key}`" for key in self.keys)
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in self.schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name only: the files are not the catalog's
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {note['buckets']} BUCKETS "
            f"LOCATION '{self.path}/{note['slot']}'"
        )
        return self.spark.table(name)

    def read(self) -> DataFrame:
        note = self.current()
        return self.spark.createDataFrame([], self.schema) if note is None else self._stored(note)

    def merged(self, delta: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """The table after the delta, as a plan."""
        return merge_rows(self.read(), delta, self.keys, order).select(*self.schema.names)

    def upsert(self, delta: DataFrame, order: Sequence[str] = ()) -> None:
        """Apply the delta; ``order`` puts the rows of a repeated key in order, without it a repeat is an error."""
        delta = written_once(delta, f"{self.path}/delta")
        note = self.current()
        if delta.isEmpty():
            return
        version, buckets, slot = (1, self.buckets, _SLOTS[0]) if note is None else (
            note["version"] + 1, note["buckets"], _SLOTS[1 - _SLOTS.index(note["slot"])]
        )
        while note is not None and note["bytes"] > buckets * self.bucket_bytes:
            buckets *= 2
        merged, name = self.merged(delta, order), self._name(slot)
        if note is None or buckets != note["buckets"]:
            merged = merged.repartition(buckets, *self.keys)  # else the join leaves one task a bucket
        place = f"{self.path}/{slot}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        merged.write.format("parquet").mode("overwrite").option("path", place).bucketBy(buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        size = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(place).agg(F.sum("length")).first()[0]
        done = self.spark.createDataFrame([(version, buckets, size or 0, slot)], _NOTE).coalesce(1)
        # Each place has its own note: if this write dies, the other place's note, the table as it was, is whole.
        done.write.mode("overwrite").json(f"{self.path}/notes/of={slot}")
