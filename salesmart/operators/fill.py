"""Forward fill that does not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a block, blocks of a block of blocks, and so on. Three such steps cover all positive longs.
BLOCK_ROWS = 1 << 21
_LEVELS = 3


def _last_set(value: str, at: str) -> Column:
    """The value with the greatest position among those that are not NULL."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at)))


def _block(position: Column, width: int) -> Column:
    """Whole-number division that rounds down, exact for all longs."""
    return F.call_function("div", position - F.pmod(position, F.lit(width)), F.lit(width))


def forward_fill(df: DataFrame, column: str, group: list[str], order: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Replace NULLs of ``column`` by the last value above them within ``group``, in ``order`` (an integer).

    Positions are cut into blocks of ``block_rows``, blocks into blocks of as many blocks. A window fills inside each
    block; the last value of
    each block moves up as one row, is filled there among its neighbours, and comes back down to rows above which their own block
    has nothing. No window holds more than ``block_rows`` rows (of positions that don't repeat) wherever they lie, a million apart or side
    by side, and a group of any size is spread over its blocks.
    """
    at = [f"_at{k}" for k in range(_LEVELS)]
    names = [*df.columns]
    rows = df.withColumn(at[0], F.col(order).cast("long"))
    for k in range(1, _LEVELS):
        rows = rows.withColumn(at[k], _block(F.col(at[k - 1]), block_rows))
    summaries = [rows]
    for k in range(1, _LEVELS):
        below = summaries[-1]
        summaries.append(below.groupBy(*group, *at[k:]).agg(_last_set(column, at[k - 1]).alias(column)))
    # from the top: what each block of a level finds above it
    carried = None
    for k in range(_LEVELS - 1, 0, -1):
        above = Window.partitionBy(*group, *at[k + 1 :]).orderBy(at[k]).rowsBetween(Window.unboundedPreceding, -1)
        found = summaries[k].withColumn("_found", F.last(column, ignorenulls=True).over(above))
        if carried is not None:
            found = _with_carry(found, carried, group, at[k + 1 :]).withColumn("_found", F.coalesce("_found", "_carry"))
        carried = found.where(F.col("_found").isNotNull()).select(*group, *at[k:], F.col("_found").alias("_carry"))
    inside = Window.partitionBy(*group, *at[1:]).orderBy(at[0]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumn(column, F.last(column, ignorenulls=True).over(inside))
    if carried is not None:
        filled = _with_carry(filled, carried, group, at[1:]).withColumn(column, F.coalesce(column, "_carry"))
    return filled.select(names)


def _with_carry(rows: DataFrame, carried: DataFrame, group: list[str], at: list[str]) -> DataFrame:
    on = [F.col(f"f.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*group, *at)]  # a group may be NULL
    return rows.alias("f").join(carried.alias("c"), on, "left").select("f.*", "c._carry")
