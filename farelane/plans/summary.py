"""Transaction summaries: counts and revenue per ticket period, with totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import route_of, typed_null
from farelane.plans.common import amount, by_period, price_type_pivot
from farelane.sources.star import Star


def transaction_summary_by_stage(star: Star, span: Span) -> DataFrame:
    """Single-trip tickets by vehicle type, fare category, route and plazas.

    Uses the stage-unique view, so revenue is not repeated per lane; the detail fact
    has no lane id and the lane columns stay NULL. Distinct transactions are made by
    one aggregate per transaction, which the pivot then counts: two shuffles, and no
    group is ever held by one task before it is deduplicated.
    """
    columns = ["transport_trans_id", "stage_id", "price_id", "price_type", "price_ticket_type", "price_amount"]
    detail = by_period(star.fact("detail", span, columns).filter(F.col("price_type") == "L"), span)
    price = star.small(star.table("price").select("price_id", F.col("vehicle_type").alias("vehicle_type")), "price")
    fare = star.domain("PRICE_TICKET_TYPE").toDF("price_ticket_type", "fare_category")
    stage = star.stages().select("stage_id", "cycle_name", "checkin_toll_name", "checkout_toll_name")
    keys = ["period", "vehicle_type", "fare_category", "cycle_name", "checkin_toll_name", "checkout_toll_name"]
    trips = (
        detail.join(stage, "stage_id").join(fare, "price_ticket_type").join(price, "price_id")
        .groupBy(*keys, "price_type", "transport_trans_id").agg(amount(F.col("price_amount"), "amount"))
        .withColumn("quantity", F.col("transport_trans_id").isNotNull().cast("int"))
    )
    return price_type_pivot(trips, keys).select(
        *span.labels(), "vehicle_type", "fare_category", *_measures(),
        F.col("cycle_name").alias("route"), F.col("checkin_toll_name").alias("entry_plaza"),
        F.col("checkout_toll_name").alias("exit_plaza"), F.lit(labels.ETC).alias("toll_channel"),
        typed_null("string").alias("entry_lane"), typed_null("string").alias("exit_lane"),
    )


def transaction_summary_by_price(star: Star, span: Span) -> DataFrame:
    """Transactions joined to the price list of their exit plaza and vehicle type.

    A transaction counts once for every price of the list that it meets; equal ticket kinds are
    counted before the join, so it does not repeat the fact for each of them.
    """
    kinds = star.plaza_prices().groupBy(F.col("toll_id").alias("checkout_toll_id"), "vehicle_type", "price_type", "price_ticket_type")
    price = star.small(kinds.agg(F.count("*").alias("prices")), "price")
    toll = star.tolls().select("toll_id")
    entry = toll.select(F.col("toll_id").alias("checkin_toll_id"), F.col("toll_id").alias("entry_plaza"))
    leave = toll.select(F.col("toll_id").alias("checkout_toll_id"), F.col("toll_id").alias("exit_plaza"))
    route = star.plaza_routes().select(F.col("toll_id").alias("checkout_toll_id"), F.col("cycle_name").alias("route"))
    keys = ["date", "vehicle_type", "price_ticket_type", "route", "entry_plaza", "exit_plaza"]
    columns = ["checkout_commit_datetime", "checkin_toll_id", "checkout_toll_id", "vehicle_type", "total_amount"]
    rows = (
        star.fact("txn", span, columns).withColumnRenamed("checkout_commit_datetime", "date")
        .join(price, ["checkout_toll_id", "vehicle_type"])
        .join(entry, "checkin_toll_id", "left").join(leave, "checkout_toll_id", "left")
        .join(route, "checkout_toll_id")
        .withColumns({"quantity": F.col("prices"), "amount": (F.col("total_amount") * F.col("prices")).cast("decimal(28,2)")})
    )
    return price_type_pivot(rows, keys).select(
        "date", "vehicle_type", F.col("price_ticket_type").alias("fare_category"), *_measures(),
        "route", "entry_plaza", "exit_plaza", F.lit(labels.ETC).alias("toll_channel"),
    )


def transaction_summary_by_lane(star: Star, span: Span) -> DataFrame:
    """Transactions joined to all their ticket details, by lane; route from the plaza name.

    Details are read where they can belong to the period. The joined rows go straight into the report's groups within the
    joining task, so neither details nor tickets are held per transaction, and a transaction with very
    many details may be split over tasks.
    """
    columns = [
        "transport_trans_id", "vehicle_type", "checkin_toll_name", "checkout_toll_name", "checkin_lane_name",
        "checkout_lane_name", "total_amount",
    ]
    txn = by_period(star.fact("txn", span, columns), span)
    tickets = star.partner("detail", "txn", span, ["transport_trans_id", "price_ticket_type", "price_type"])
    keys = [
        "period", "vehicle_type", "price_ticket_type", "checkin_toll_name", "checkout_toll_name",
        "checkin_lane_name", "checkout_lane_name",
    ]
    rows = txn.join(tickets, "transport_trans_id").withColumns({"quantity": F.lit(1), "amount": F.col("total_amount")})
    return price_type_pivot(rows, keys).select(
        *span.labels(), "vehicle_type", F.col("price_ticket_type").alias("fare_category"), *_measures(),
        route_of(F.col("checkout_toll_name")).alias("route"),
        F.col("checkin_toll_name").alias("entry_plaza"), F.col("checkout_toll_name").alias("exit_plaza"),
        F.lit(labels.ETC).alias("toll_channel"),
        F.col("checkin_lane_name").alias("entry_lane"), F.col("checkout_lane_name").alias("exit_lane"),
    )


def _measures() -> list[str]:
    per_type = [f"{name}_pass_{kind}" for name in labels.PRICE_TYPES.values() for kind in ("count", "revenue")]
    return [*per_type, "total_pass_count", "total_revenue"]
