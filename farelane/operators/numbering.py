"""Latest row per key, first row per key and gapless numbers, without funnelling rows
of one key or of the whole table through a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.session import checkpointed


def best_per_key(rows: DataFrame, keys: list[str], order: list[Column], newest: bool = True) -> DataFrame:
    """The row with the greatest (or smallest) order values of each key.

    An aggregate instead of a window: every map task keeps one row per key, so a key
    with most of the rows costs no more than any other. ``order`` must break ties.
    """
    packed = F.struct(*rows.columns)
    pick = (F.max_by if newest else F.min_by)(packed, F.struct(*order))
    return rows.groupBy(*keys).agg(pick.alias("_row")).select("_row.*")


def numbered(rows: DataFrame, order: list[Column], out: str, start: Column | int = 1) -> DataFrame:
    """Consecutive numbers in the given order, from ``start``.

    The rows are range-partitioned and sorted, and each gets its position within its
    partition. That layout is checkpointed, so a lost executor cannot change it; the
    partition sizes (one row per partition) then give each partition its offset. Only those
    sizes pass through one task; they are sent to the partitions, whose rows stay where they are.
    """
    local_bits = 33
    spot = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_spot", spot)
    placed = checkpointed(placed).withColumns({
        "_part": F.shiftright("_spot", local_bits),
        "_nth": F.col("_spot").bitwiseAND(F.lit((1 << local_bits) - 1)),
    })
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the frame above, so one running sum over all of them stays short.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + F.col("_nth") + first).cast("bigint"))
        .drop("_part", "_nth", "_spot", "_offset")
    )


def continue_ids(new: DataFrame, existing: DataFrame, order: list[Column], id_column: str = "id") -> DataFrame:
    """Number new rows from the greatest existing id plus one (from one if there is none)."""
    greatest = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).scalar()
    return numbered(new, order, id_column, greatest + 1)


def without_ids(rows: DataFrame, doomed: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows whose id is not listed."""
    return rows.join(doomed.select(id_column).distinct(), id_column, "left_anti")
