"""Distinct counts that add up: exact sets of ids, kept by day and merged for longer periods.

A set has one row for each id of a group, with the sums of the group's rows that carry the id, so sets are never larger than the
rows that they are made of, however far apart the ids lie, and a group with a third of all rows is dealt over all tasks by its ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from farelane.functions.calendar import Span
from farelane.operators.partitions import Replaced, replace_period_partitions

MEMBER = "member_id"


def id_sets(rows: DataFrame, keys: list[str], id_column: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """``keys`` and ids that each group has, with ``sums`` (name to a column to add up).

    Rows without an id are in the sums and in no set.
    """
    return _summed(rows.groupBy(*keys, F.col(id_column).alias(MEMBER)), sums or {})


def merged_sets(sets: DataFrame, keys: list[str], sums: list[str] = ()) -> DataFrame:
    """Sets of coarser groups: an id is there once, whatever rows or days it comes from."""
    return _summed(sets.groupBy(*keys, MEMBER), {c: F.col(c) for c in sums})


def counted(sets: DataFrame, keys: list[str], count: str, sums: list[str] = ()) -> DataFrame:
    """Distinct ids and sums of each group. ``sets`` have one row for each group and id."""
    return sets.groupBy(*keys).agg(F.count(MEMBER).alias(count), *[F.sum(c).alias(c) for c in sums])


def _summed(groups: GroupedData, sums: dict[str, Column]) -> DataFrame:
    return groups.agg(*[F.sum(c).alias(name) for name, c in sums.items()]) if sums else groups.agg(F.count("*").alias("n")).drop("n")


def refresh_days(rows: DataFrame, path: str, keys: list[str], id_column: str, sums: dict[str, Column], span: Span, day: str = "local_day") -> Replaced:
    """Make or renew the daily sets of the span's days below ``path``, a folder for each day; other days are not touched.

    ``rows`` are those of the span. A day without rows loses its folder.
    """
    named = rows.withColumn("day", F.date_format(day, "yyyy-MM-dd"))
    inside = F.col("day").between(f"{span.first:%Y-%m-%d}", f"{span.last:%Y-%m-%d}")
    return replace_period_partitions(id_sets(named, ["day", *keys], id_column, sums), path, "day", inside, span.first)


def by_period_of(daily: DataFrame, span: Span) -> DataFrame:
    """Daily sets of the span's days, with the ``period`` that each day falls into; days are chosen by folder."""
    chosen = daily.filter(F.col("day").between(f"{span.first:%Y-%m-%d}", f"{span.last:%Y-%m-%d}"))
    return chosen.withColumn("period", span.period(F.to_date("day")))
