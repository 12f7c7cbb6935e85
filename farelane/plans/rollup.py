"""Route revenue from daily sets: a day is made once, and a month, quarter or year is merged from its days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.operators.distinct import by_period_of, counted, merged_sets, refresh_days
from farelane.operators.partitions import Replaced
from farelane.plans.revenue import detail_rows, published
from farelane.sources.star import Star

KEYS = ["route", "revenue_group", "vehicle_label"]


def refresh_route_revenue(star: Star, span: Span, path: str) -> Replaced:
    """Make or renew the daily sets of the span's days; the fact is read once, for these days alone."""
    rows = detail_rows(star, span, "route")
    return refresh_days(rows, path, KEYS, "transport_trans_id", {"amount": F.col("price_amount")}, span)


def route_revenue(daily: DataFrame, span: Span) -> DataFrame:
    """The route report of any level: equal to the one from the fact, without reading it.

    Vehicle rows and channel rows come from one merge; the channel's set is the union of its vehicles' sets.
    """
    sets = by_period_of(daily, span)
    kinds = F.array(
        F.struct(F.col("vehicle_label").alias("vehicle_transaction_type"), F.lit(labels.BY_VEHICLE).alias("type")),
        F.struct(F.lit(labels.ETC).alias("vehicle_transaction_type"), F.lit(labels.BY_CHANNEL).alias("type")),
    )
    spread = sets.withColumn("kind", F.explode(kinds)).filter("kind.vehicle_transaction_type IS NOT NULL").select("*", "kind.*")
    keys = ["period", "route", "revenue_group", "vehicle_transaction_type", "type"]
    totals = counted(merged_sets(spread, keys, ["amount"]), keys, "transaction_count", ["amount"])
    money = totals.withColumn("gross_revenue", F.col("amount").cast("decimal(28,2)")).drop("amount")
    return published(money, span, ("route",), None)
