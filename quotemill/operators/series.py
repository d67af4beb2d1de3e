"""Changes along a series, returns, and bars out of ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.session import staged
from quotemill.shipping import ship_by_value

def _starts_run(batch, names: Sequence[str], before) -> list[bool]:
    """For each row of the batch, whether its key differs from the row before; ``before`` is the key of the last batch."""
    import numpy as np
    import pyarrow.compute as pc

    starts = np.zeros(batch.num_rows, bool)
    starts[0] = before is None or before != [batch.column(name)[0] for name in names]
    for name in names:
        column = batch.column(name)
        left, right = column.slice(0, len(column) - 1), column.slice(1)
        differs = pc.fill_null(pc.not_equal(left, right), False).to_numpy(zero_copy_only=False)
        one_null = pc.xor(pc.is_null(left), pc.is_null(right)).to_numpy(zero_copy_only=False)
        starts[1:] |= differs | one_null
    return starts


class _Scan:
    """Goes through one sorted partition batch by batch and finds, for each wanted column, the value before.

    A row is open if nothing of its key came before it in this partition, so that earlier partitions may know its value.
    """

    def __init__(self, keys: Sequence[str], wanted: dict[str, tuple[str, bool]]):
        self.keys, self.wanted = list(keys), wanted
        self.key, self.first_run, self.held = None, True, dict.fromkeys(wanted)

    def batch(self, batch) -> list:
        """The found values and open flags of all wanted columns."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n, rows = batch.num_rows, np.arange(batch.num_rows)
        starts = _starts_run(batch, self.keys, self.key)
        begins = np.maximum.accumulate(np.where(starts, rows, -1))  # -1: the run began in an earlier batch
        in_first = np.zeros(n, bool)
        if self.first_run:
            later = starts.copy()
            later[0] &= self.key is not None
            in_first = ~np.logical_or.accumulate(later)
        out = []
        for name, (column, skip_nulls) in self.wanted.items():
            values = batch.column(column)
            known = pc.is_valid(values).to_numpy(zero_copy_only=False) if skip_nulls else np.ones(n, bool)
            last = np.maximum.accumulate(np.where(known, rows, -1))
            before = np.concatenate([[-1], last[:-1]])
            inside = (before >= begins) & (before >= 0)
            held = self.held[name]
            use_held = ~inside & (begins < 0) & (held is not None)
            source = values if held is None else pa.concat_arrays([values, pa.array([held.as_py()], values.type)])
            index = pa.array(np.where(inside, before, n), pa.int64(), mask=~(inside | use_held))
            out += [source.take(index), pa.array(in_first & ~inside & ~use_held)]
            end, begin = int(last[-1]), int(begins[-1])
            if end >= max(begin, 0):
                self.held[name] = values[end]
            elif begin >= 0:
                self.held[name] = None
        self.first_run = bool(in_first[-1])
        self.key = [batch.column(name)[n - 1] for name in self.keys]
        return out


def previous_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], wanted: dict[str, tuple[str, bool]], partitions: int | None = None
) -> DataFrame:
    """Each ``out: (column, skip_nulls)`` = the column one row earlier in the key's order, or its nearest earlier non-null.

    A segmented scan: rows are dealt once by ranges of (keys, order), so a long key, or a long day of it, is several
    tasks' work; each task goes through its sorted range, and only the first rows of a range can lack a value that an
    earlier range knows. First and last rows of the ranges, two a range, tell what that is. The scanned ranges are a
    written table, the cut behind which a lost executor repeats nothing.
    """
    flags = {out: f"_open_{out}" for out in wanted}
    ordered = [*keys, *order]
    ranged = df.repartitionByRange(partitions, *ordered) if partitions else df.repartitionByRange(*ordered)
    names = [*df.columns, *[x for pair in flags.items() for x in pair], "_part", "_first", "_last"]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    for out, (column, _) in wanted.items():
        schema = schema.add(out, df.schema[column].dataType).add(flags[out], T.BooleanType())
    schema = schema.add("_part", T.IntegerType()).add("_first", T.BooleanType()).add("_last", T.BooleanType())

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        scan, part, first, waiting = _Scan(keys, wanted), TaskContext.get().partitionId(), True, None

        def marked(columns, is_first: bool, is_last: bool):
            n = len(columns[0])
            ends = [np.zeros(n, bool), np.zeros(n, bool)]
            ends[0][0], ends[1][-1] = is_first, is_last
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part, np.int32)), *map(pa.array, ends)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting:
                yield marked(waiting, first, False)
                first = False
            waiting = [*batch.columns, *scan.batch(batch)]
        if waiting:
            yield marked(waiting, first, True)

    scanned = staged(ranged.sortWithinPartitions(*ordered).mapInArrow(run, schema), "series")
    # What a range's last row hands on: its own value, else the one it found, else whatever reaches the range.
    ends = {}
    for out, (column, skip_nulls) in wanted.items():
        known = F.coalesce(F.col(column), F.col(out)) if skip_nulls else F.col(column)
        open_end = F.col(flags[out]) & F.col(column).isNull() if skip_nulls else F.lit(False)
        ends[out] = F.when(F.col("_last") & ~open_end, F.struct(known.alias("v")))
    nothing = {out: F.lit(None).cast(T.StructType([T.StructField("v", df.schema[c].dataType)])) for out, (c, _) in wanted.items()}
    side = scanned.where("_first OR _last")
    events = side.where("_first").select(*keys, "_part", F.lit(0).alias("_at"), *[v.alias(f"_end_{o}") for o, v in nothing.items()])
    events = events.unionByName(side.where("_last").select(*keys, "_part", F.lit(1).alias("_at"), *[v.alias(f"_end_{o}") for o, v in ends.items()]))
    earlier = Window.partitionBy(*keys).orderBy("_part", "_at").rowsBetween(Window.unboundedPreceding, -1)
    carries = events.withColumns({f"_carry_{o}": F.last(f"_end_{o}", ignorenulls=True).over(earlier) for o in wanted}).where("_at = 0")
    joined = scanned.join(F.broadcast(carries.select("_part", *[f"_carry_{o}" for o in wanted])), "_part")  # one row a range
    return joined.select(
        *df.columns, *[F.when(F.col(flags[o]), F.col(f"_carry_{o}.v")).otherwise(F.col(o)).alias(o) for o in wanted]
    )


def series_changes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str = "close",
    change: str | None = "change",
    var: str | None = "var",
    partitions: int | None = None,
) -> DataFrame:
    """Difference and relative change to the previous row of the key, either or both, from one scan.

    The difference is to the row before, null when that is null. For the relative change missing
    values take the last known one first.
    """
    wanted = {}
    if change:
        wanted["_before"] = (column, False)
    if var:
        wanted["_known"] = (column, True)
    result = previous_values(df, keys, order, wanted, partitions)
    added = {}
    if change:
        added[change] = F.col(column) - F.col("_before")
    if var:
        filled = F.coalesce(F.col(column), F.col("_known"))
        added[var] = F.try_divide(filled, F.col("_known")) - F.lit(1.0)
    return result.withColumns(added).drop("_before", "_known")


def difference(df: DataFrame, keys, order, column: str = "close", out: str = "change", partitions: int | None = None) -> DataFrame:
    """Difference to the previous row of the key."""
    return series_changes(df, keys, order, column, out, None, partitions)


def percent_change(df: DataFrame, keys, order, column: str = "close", out: str = "var", partitions: int | None = None) -> DataFrame:
    """Relative change to the previous row of the key."""
    return series_changes(df, keys, order, column, None, out, partitions)


def reference_return(df: DataFrame, close: str = "close", change: str = "change") -> DataFrame:
    """reference = close - change; rt = change / reference, null where the reference is 0."""
    reference = F.col(close) - F.col(change)
    return df.withColumns({"reference": reference, "rt": F.try_divide(F.col(change), reference)})


def return_from_reference(df: DataFrame, close: str = "close", reference: str = "reference") -> DataFrame:
    """A reference of 0 counts as missing; then change, change in percent and return."""
    known = F.nullif(F.col(reference), F.lit(0.0))
    change = F.col(close) - known
    varpc = F.lit(100.0) * change / known
    return df.withColumns(
        {"reference": known, "change": change, "varpc": varpc, "rt": varpc / F.lit(100.0)}
    )


def _instant(time: str, tie: Sequence[str], integral: bool) -> Column:
    """What orders ticks: time, then tie.

    A struct would make the aggregate sort its input, since structs are no fixed-width buffers. One
    integer tie therefore goes with the time into one decimal, time first: 30 % faster on ten million ticks.
    """
    if not tie:
        return F.col(time)
    if not integral:
        return F.struct(time, *tie)
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(18,0)")
    room = F.lit("20000000000000000000").cast("decimal(20,0)")  # more than any two bigints differ
    return (micros * room + F.col(tie[0]).cast("decimal(19,0)")).cast("decimal(38,0)")


def ohlc(
    ticks: DataFrame, keys: Sequence[str], time: str, width: str, tie: Sequence[str] = (), keep_window: str | None = None
) -> DataFrame:
    """Bars of a fixed width from (price, size) ticks; ``tie`` orders ticks of one instant. ``keep_window`` names a column
    for the window itself, which a stream needs to go on with its time."""
    integral = len(tie) == 1 and dict(ticks.dtypes)[tie[0]] in ("int", "bigint")
    position = _instant(time, tie, integral)
    return (
        ticks.groupBy(*keys, F.window(time, width).alias("_window"))
        .agg(
            F.min_by("price", position).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", position).alias("close"),
            F.sum("size").alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        .withColumn("start", F.col("_window.start"))
        .select(*keys, "start", "open", "high", "low", "close", "volume", "trades", *([F.col("_window").alias(keep_window)] if keep_window else []))
    )


def sorted_bars(df: DataFrame, *order: str) -> DataFrame:
    """A global order for a final output: range partitions, each sorted, in one shuffle."""
    return df.orderBy(*order)


def range_layout(df: DataFrame, *order: str, partitions: int | None = None) -> DataFrame:
    """A storage layout: ranges of the key, sorted inside, for selective reads later."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


ship_by_value(__name__)
