"""Reconciliation of collected, simulated and mediated amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import route_of, typed_null
from farelane.plans.common import amount, by_period, null_money
from farelane.sources.star import Star


def fare_sales_monitoring(star: Star, span: Span) -> DataFrame:
    """Single tickets by vehicle type, unit price and exit plaza."""
    wanted = ["transport_trans_id", "stage_id", "price_id", "price_type", "price_amount"]
    detail = by_period(star.fact("detail", span, wanted).filter(F.col("price_type") == "L"), span)
    stage = star.stages().select("stage_id", F.col("checkout_toll_name").alias("plaza_name"))
    return (
        detail.join(stage, "stage_id").join(star.priced_vehicles().select("price_id", "vehicle_label"), "price_id")
        .groupBy("period", "vehicle_label", F.col("price_amount").alias("unit_price"), "plaza_name")
        .agg(F.count_distinct("transport_trans_id").alias("ticket_count"), amount(F.col("price_amount"), "revenue"))
        .select(
            *span.labels(), F.lit(labels.SINGLE_TICKET).alias("price_name"), F.col("vehicle_label").alias("vehicle_type"),
            F.col("unit_price").alias("price_amount"), "plaza_name", "ticket_count", "revenue",
        )
    )


def frontend_backend_amounts(star: Star, span: Span) -> DataFrame:
    """Amount per front-end transaction, time, route and plaza; both sides and the
    difference carry the one amount that is known so far."""
    plaza = star.tolls().select(F.col("toll_id").alias("checkout_toll_id"), F.col("toll_name").alias("plaza_name"))
    wanted = ["fe_trans_id", "checkout_commit_datetime", "checkout_toll_id", "total_amount"]
    route = star.plaza_routes().select(F.col("toll_id").alias("checkout_toll_id"), F.col("cycle_name").alias("route"))
    return (
        star.fact("txn", span, wanted).join(route, "checkout_toll_id").join(plaza, "checkout_toll_id")
        .groupBy(
            F.col("fe_trans_id").alias("transaction_code"), F.col("checkout_commit_datetime").alias("date"),
            "route", "plaza_name",
        )
        .agg(amount(F.col("total_amount"), "frontend_amount"))
        .select(
            "*", F.col("frontend_amount").alias("backend_amount"), F.col("frontend_amount").alias("difference_amount"),
            F.lit(1).alias("processing_status"),
        )
    )


def reconcile_front_back(star: Star, span: Span) -> DataFrame:
    """Transactions against their mediation record, joined on the transaction id."""
    wanted = ["transport_trans_id", "checkout_toll_name", "etag_number", "plate", "total_amount"]
    txn = by_period(star.fact("txn", span, wanted), span)
    record = star.partner("mediation", "txn", span, ["transport_trans_id", "plate", "price"]).withColumnRenamed("plate", "mediation_plate")
    return txn.join(record, "transport_trans_id").select(
        F.col("transport_trans_id").alias("transaction_code"), *span.labels(),
        route_of(F.col("checkout_toll_name")).alias("route"), F.col("checkout_toll_name").alias("plaza_name"),
        "etag_number", F.col("plate").alias("checkout_plate"), F.col("mediation_plate").alias("plate"),
        F.col("total_amount").alias("frontend_amount"), F.col("price").alias("backend_amount"),
        F.abs(F.col("total_amount") - F.col("price")).cast("decimal(19,2)").alias("difference_amount"),
    )


def revenue_simulation(star: Star, span: Span) -> DataFrame:
    """Details against transactions of the same partition hour.

    The partition columns are join keys, so the span prunes both facts.
    """
    at = ["transport_trans_id", "year", "month", "day", "hour"]
    detail = by_period(star.fact("detail", span, [*at, "stage_id", "price_type"]), span).drop("local_day")
    txn = star.fact("txn", span, [*at, "vehicle_id", "checkout_toll_name", "total_amount", "voucher_used_amount"]).drop("local_day")
    stage = star.small(star.table("stage").select("stage_id", F.col("stage_name").alias("toll_name")), "stage")
    vehicle = star.small(star.table("vehicle").select("vehicle_id", F.col("vehicle_group").alias("revenue_group")), "vehicle")
    return (
        detail.join(txn, at)
        .join(stage, "stage_id").join(vehicle, "vehicle_id")
        .groupBy(
            "period", "toll_name", route_of(F.col("checkout_toll_name")).alias("cycle_name"), "revenue_group",
            F.col("price_type").alias("ticket_type"),
        )
        .agg(
            F.count("*").alias("transaction_count"), amount(F.col("total_amount"), "gross_revenue"),
            amount(F.col("voucher_used_amount"), "discount_amount"),
        )
        .select(
            *span.labels(), "toll_name", "cycle_name", "revenue_group", "ticket_type", "transaction_count", "gross_revenue",
            "discount_amount", F.lit(labels.PUBLIC_INVESTMENT).alias("cycle_type"),
            *null_money("tax_amount", "investment_amount", "net_revenue"), F.lit(labels.BY_VEHICLE).alias("type"),
        )
    )


def surcharge_list(star: Star, span: Span) -> DataFrame:
    """Violations still to be collected against the collected transaction."""
    wanted = [
        "transport_trans_id", "checkout_datetime", "checkout_toll_id", "checkout_channel", "plate", "vehicle_type", "total_amount"
    ]
    txn = by_period(star.fact("txn", span, wanted), span)
    violation = star.partner("violation", "txn", span, ["transport_trans_id", "vehicle_type", "price_amount", "status"]).filter(
        F.col("status") == labels.TO_BE_COLLECTED
    ).select(
        "transport_trans_id", F.col("vehicle_type").alias("reconciled_vehicle_type"),
        F.col("price_amount").alias("reconciled_collected_amount"),
    )
    plaza = star.tolls().select(F.col("toll_id").alias("checkout_toll_id"), F.col("toll_name").alias("plaza_name"))
    return txn.join(violation, "transport_trans_id").join(plaza, "checkout_toll_id").select(
        *span.labels(), F.col("checkout_datetime").alias("pass_time"), F.col("transport_trans_id").alias("transaction_code"),
        "plaza_name", F.col("checkout_channel").alias("transaction_type"), F.col("plate").alias("license_plate"),
        F.col("vehicle_type").alias("collected_vehicle_type"), F.col("total_amount").alias("collected_amount"),
        "reconciled_vehicle_type", "reconciled_collected_amount", typed_null("string").alias("surcharge_reason"),
        F.abs(F.col("total_amount") - F.col("reconciled_collected_amount")).cast("decimal(19,2)").alias("amount_difference"),
    )
