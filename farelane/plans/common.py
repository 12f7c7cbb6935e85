"""Pieces shared by the report families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import typed_null


def by_period(rows: DataFrame, span: Span) -> DataFrame:
    """Rows with their ``period``, a date; the label texts are made from it after grouping."""
    return rows.withColumn("period", span.period(F.col("local_day")))


def amount(column: Column, name: str) -> Column:
    """Sum of a money column."""
    return F.sum(column).cast("decimal(28,2)").alias(name)


def null_money(*names: str) -> list[Column]:
    """Typed NULL placeholders for measures that are not defined yet."""
    return [typed_null().alias(name) for name in names]


def price_type_pivot(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``quantity`` and ``amount`` per ticket period in columns, with totals, in one aggregate.

    With distinct counts the rows are one per transaction and ticket period, so a
    transaction with two ticket periods counts once in each and twice in the total.
    """
    measures: list[Column] = []
    for code, name in labels.PRICE_TYPES.items():
        chosen = F.col("price_type") == code
        measures.append(F.sum(F.when(chosen, F.col("quantity"))).cast("bigint").alias(f"{name}_pass_count"))
        measures.append(amount(F.when(chosen, F.col("amount")), f"{name}_pass_revenue"))
    return rows.groupBy(*keys).agg(
        *measures, F.sum("quantity").cast("bigint").alias("total_pass_count"), amount(F.col("amount"), "total_revenue")
    )


def with_vehicle_and_channel_rows(rows: DataFrame, vehicle_label: Column) -> DataFrame:
    """Each row once for its vehicle label and once for the channel total.

    One pass serves both kinds of report row: the fact is scanned and joined once,
    and a row without a vehicle label counts only for the channel.
    """
    vehicle = F.struct(vehicle_label.alias("vehicle_transaction_type"), F.lit(labels.BY_VEHICLE).alias("type"))
    channel = F.struct(F.lit(labels.ETC).alias("vehicle_transaction_type"), F.lit(labels.BY_CHANNEL).alias("type"))
    return (
        rows.withColumn("kind", F.explode(F.array(vehicle, channel)))
        .filter(F.col("kind.vehicle_transaction_type").isNotNull())
        .withColumns({"vehicle_transaction_type": F.col("kind.vehicle_transaction_type"), "type": F.col("kind.type")})
        .drop("kind")
    )


def joined_share(groups: DataFrame, share: DataFrame, day: str) -> DataFrame:
    """Operator split rules in force on ``day``, joined to pre-aggregated groups.

    Groups need ``vehicle_type, price_type, boo, n_rows, amount``. The split is linear
    (a percentage of the sum, or a fixed value once per fact row), so it is exact on
    sums, and the date-range join sees groups instead of fact rows.
    """
    rule = share.select(
        "vehicle_type", "price_type", "boo", "distribution_type", "boo_split_value", "effective_date", "expiry_date"
    )
    in_force = F.col(day).between(F.col("effective_date"), F.col("expiry_date"))
    value = F.coalesce(F.col("boo_split_value"), F.lit(0).cast("decimal(18,2)"))
    percent = F.col("amount").cast("decimal(20,2)") * value.cast("decimal(9,2)") * F.lit("0.01").cast("decimal(3,2)")
    fixed = F.col("n_rows").cast("decimal(18,0)") * value.cast("decimal(18,2)")
    split = (
        F.when(F.col("distribution_type") == "PERCENT", percent.cast("decimal(30,6)"))
        .when(F.col("distribution_type") == "FIXED", fixed.cast("decimal(30,6)"))
        .otherwise(F.lit(0).cast("decimal(30,6)"))
    )
    return (
        groups.join(
            rule,
            (groups["vehicle_type"] == rule["vehicle_type"])
            & (groups["price_type"] == rule["price_type"])
            & (groups["boo"] == rule["boo"])
            & in_force,
            "left",
        )
        .drop(rule["vehicle_type"]).drop(rule["price_type"]).drop(rule["boo"])
        .withColumn("split", split)
    )


def split_sum(name: str) -> Column:
    """Sum of the operator split."""
    return F.sum("split").cast("decimal(38,6)").alias(name)
