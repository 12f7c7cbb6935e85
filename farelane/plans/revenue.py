"""Lane, plaza and route revenue: vehicle rows and channel rows of one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import route_of
from farelane.plans.common import amount, by_period, null_money, with_vehicle_and_channel_rows
from farelane.sources.star import Star

LEVEL_KEYS = {
    "lane": ("route", "plaza_name", "lane_name"),
    "plaza": ("route", "plaza_name"),
    "route": ("route",),
}


def transaction_revenue(star: Star, span: Span, level: str) -> DataFrame:
    """Revenue per ``lane``, ``plaza`` or ``route`` from the transaction fact.

    All measures add up, so the transactions are reduced to vehicle-type groups per
    plaza first. Route names are cut from plaza names and channel rows are rolled up
    from those groups, not from the fact and not by a second scan.
    """
    places = ["checkout_toll_name", *(["checkout_lane_name"] if level == "lane" else [])]
    columns = [*places, "vehicle_id", "vehicle_type", "total_amount", "voucher_used_amount"]
    vehicle = star.small(star.table("vehicle").select("vehicle_id", F.col("vehicle_group").alias("revenue_group")), "vehicle")
    by_type = (
        by_period(star.fact("txn", span, columns), span).join(vehicle, "vehicle_id")
        .groupBy("period", *places, "revenue_group", "vehicle_type")
        .agg(
            F.count("*").alias("n"),
            amount(F.col("total_amount"), "gross"),
            amount(F.col("voucher_used_amount"), "discount"),
        )
        .withColumns({"route": route_of(F.col("checkout_toll_name")), "plaza_name": F.col("checkout_toll_name")})
        .withColumnsRenamed({"checkout_lane_name": "lane_name"})
    )
    rows = with_vehicle_and_channel_rows(by_type, labels.vehicle_type_label(F.col("vehicle_type")))
    # Unknown codes share one label text but stay separate rows, hence the code among the keys.
    code = F.when(F.col("type") == labels.BY_VEHICLE, F.col("vehicle_type"))
    totals = rows.groupBy("period", *LEVEL_KEYS[level], "revenue_group", "vehicle_transaction_type", "type", code.alias("code")).agg(
        F.sum("n").alias("transaction_count"), amount(F.col("gross"), "gross_revenue"), amount(F.col("discount"), "discount_amount")
    )
    return published(totals, span, LEVEL_KEYS[level], F.col("discount_amount"))


def detail_revenue(star: Star, span: Span, level: str) -> DataFrame:
    """Revenue per ``plaza`` or ``route`` from the detail fact, with distinct transactions.

    Vehicle rows need a priced, known vehicle type; channel rows of the route report
    do not, those of the plaza report do. The rows are doubled within the scanning task
    and reduced per transaction there before anything is shuffled.
    """
    keys = ["period", *LEVEL_KEYS[level]]
    totals = (
        with_vehicle_and_channel_rows(by_period(detail_rows(star, span, level), span), F.col("vehicle_label"))
        .groupBy(*keys, "revenue_group", "vehicle_transaction_type", "type")
        .agg(F.count_distinct("transport_trans_id").alias("transaction_count"), amount(F.col("price_amount"), "gross_revenue"))
    )
    return published(totals, span, LEVEL_KEYS[level], None)


def detail_rows(star: Star, span: Span, level: str) -> DataFrame:
    """Details of the span with route, plaza, revenue group and vehicle label (NULL only where ``level`` allows it)."""
    columns = ["transport_trans_id", "stage_id", "price_id", "vehicle_id", "price_amount"]
    detail = star.fact("detail", span, columns)
    stage = star.stages().select(
        "stage_id", F.col("cycle_name").alias("route"), F.col("checkout_toll_name").alias("plaza_name")
    )
    priced = star.priced_vehicles().select("price_id", "vehicle_label")
    vehicle = star.small(star.table("vehicle").select("vehicle_id", F.col("vehicle_group").alias("revenue_group")), "vehicle")
    return detail.join(stage, "stage_id").join(priced, "price_id", "inner" if level == "plaza" else "left").join(vehicle, "vehicle_id")


def published(totals: DataFrame, span: Span, keys: tuple[str, ...], discount: Column | None) -> DataFrame:
    """The columns of a revenue report."""
    discounts = null_money("discount_amount") if discount is None else [discount.alias("discount_amount")]
    return totals.select(
        *span.labels(), *keys, "vehicle_transaction_type", "revenue_group", "transaction_count", "gross_revenue",
        *discounts, *null_money("tax_amount", "investment_amount", "net_revenue"),
        "type", F.lit(labels.PUBLIC_INVESTMENT).alias("cycle_type"),
    )
