"""Ranking, prefix sums, unpivot and rolling windows.

``rank_rows`` is ``row_number() OVER (PARTITION BY p ORDER BY o)`` that does
not funnel a partition into one task. The input is evaluated once, into a scratch
table. From there it is written as sorted runs: range partitions of the whole sort key,
each sorted, with the number of the run and the row's place in it beside every row. As the runs
are in order, the rank of a row is its place, less the place where its group starts in
the run, plus the rows that the group has in earlier runs. These extents are read from
the runs' own columns; there are at most ``runs + groups`` of them. No window sorts the rows
again and the payload is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.sources.scratch import Scratch, free_name

# One run holds about this many rows.
ROWS_PER_RANGE = 2_000_000
# Extents are broadcast up to this many rows; beyond, rows and extents meet in a shuffled join.
BROADCAST_EXTENTS = 200_000
# monotonically_increasing_id: the partition in the upper bits, the row's place in the lower 33.
PLACE_BITS = 33


def _sort_exprs(cols, descending: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if descending else col.asc_nulls_first())
    return out


def sorted_runs(stored: DataFrame, order: list[Column], runs: int, scratch: Scratch, at: str) -> DataFrame:
    """``stored`` as ``runs`` range partitions of about equal size, each sorted; the column ``at``
    ascends in the order over all rows and holds run << PLACE_BITS | place in the run."""
    ranged = stored.repartitionByRange(runs, *order).sortWithinPartitions(*order)
    return scratch.keep(ranged.withColumn(at, F.monotonically_increasing_id()))


def rank_rows(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str] | tuple = (),
    tie_break: list[str] | tuple = (),
    out: str = "rank",
    descending: bool = False,
    num_ranges: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Dense 1..n row numbers per partition, ascending with NULLs first
    (``descending=True``: descending, NULLs last). ``tie_break`` columns must
    make the order total; the result then equals the plain window function with
    the same ORDER BY. Rows whose whole sort key is equal share a run, and
    their order among themselves is open, as in the plain window.

    ``num_ranges`` (default: one per ROWS_PER_RANGE rows) changes the
    parallelism only, never the result. The result reads tables of ``scratch`` (default:
    a new one); a caller that has stored the result may close it.
    """
    partition_by = list(partition_by)
    scratch = scratch or Scratch(df.sparkSession, "rank")
    stored = scratch.keep(df)
    runs = num_ranges or -(-stored.count() // ROWS_PER_RANGE)
    if runs <= 1:
        return rank_rows_window(stored, order_by, partition_by, tie_break, out, descending)
    at = free_name([*df.columns, out], "at")
    sort_cols = [c for c in dict.fromkeys([*order_by, *tie_break]) if c not in partition_by]
    order = [*_sort_exprs(partition_by, False), *_sort_exprs(sort_cols, descending)]
    rows = sorted_runs(stored, order, runs, scratch, at)
    run = F.shiftrightunsigned(F.col(at), PLACE_BITS)
    groups = [F.col(c).alias(f"g{i}") for i, c in enumerate(partition_by)]
    names = [f"g{i}" for i in range(len(partition_by))]
    extents = scratch.keep(rows.groupBy(*groups, run.alias("run")).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")))
    # A group has one extent a run; without groups there is one row a run.
    before = Window.partitionBy(*names).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    starts = extents.select(*names, F.col("run"), (F.col("first") - offset - 1).alias("start"))
    if extents.count() <= BROADCAST_EXTENTS:
        starts = F.broadcast(starts)
    same = run == starts["run"]
    for c, g in zip(partition_by, names):
        same = same & rows[c].eqNullSafe(starts[g])
    return rows.join(starts, same).select(*[rows[c] for c in df.columns if c != out], (rows[at] - starts["start"]).cast("int").alias(out))


def rank_rows_window(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str] | tuple = (),
    tie_break: list[str] | tuple = (),
    out: str = "rank",
    descending: bool = False,
) -> DataFrame:
    """The plain window-function form (reference for tests; one task per group)."""
    w = Window.partitionBy(*partition_by).orderBy(*_sort_exprs(list(order_by) + list(tie_break), descending))
    return df.withColumn(out, F.row_number().over(w))


def prefix_sums(
    df: DataFrame, order_by: list[str], value: str, out: str, num_ranges: int | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """The sum of ``value`` over all rows before each row, in one global order (ascending, NULLs first).

    Summed inside each sorted run, plus the totals of the runs before: no task
    sees more than a run, and what is broadcast has one row a run. ``order_by`` must make the order total.
    """
    scratch = scratch or Scratch(df.sparkSession, "prefix")
    stored = scratch.keep(df)
    runs = max(1, num_ranges or -(-stored.count() // ROWS_PER_RANGE))
    at, run, total = (free_name([*df.columns, out], x) for x in ("at", "run", "total"))
    rows = sorted_runs(stored, _sort_exprs(order_by, False), runs, scratch, at)
    rows = rows.withColumn(run, F.shiftrightunsigned(F.col(at), PLACE_BITS))
    inside = Window.partitionBy(run).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(run).agg(F.sum(value).alias(total))
    totals = totals.select(F.col(run), F.coalesce(F.sum(total).over(before), F.lit(0)).alias(total))
    rows = rows.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(F.broadcast(totals), run).withColumn(out, F.col(out) + F.col(total)).select(*[c for c in df.columns if c != out], out)


def unpivot(df: DataFrame, id_cols: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Wide -> long in one pass: one row per (input row, label) with the value.

    ``columns`` maps label -> source column (e.g. {"1": "RSI_1", ...}).
    """
    pairs = F.array(*[F.struct(F.lit(k).alias(name), F.col(v).alias(value)) for k, v in columns.items()])
    return df.select(*id_cols, F.inline(pairs))


def rolling_sum(df: DataFrame, order_col: str, value_col: str, rows: int = 8, out: str | None = None) -> DataFrame:
    """Sum over the current row and the ``rows - 1`` rows before it (by row,
    not by date: gaps are not filled). Meant for one-row-per-day inputs,
    whose size is bounded by the calendar, so the single ordered task is fine.
    """
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out or value_col, F.sum(value_col).over(w))
