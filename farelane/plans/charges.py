"""Revenue of cancelled and failed charges, and the vehicle transaction reports."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import typed_null
from farelane.plans.common import amount, by_period, null_money
from farelane.sources.star import Star


def failed_charges(star: Star, span: Span, by_plaza: bool, ticket: str) -> DataFrame:
    """Single-trip revenue whose charge was cancelled or failed.

    ``ticket`` is the price-list column to group on: ``price_ticket_type`` or
    ``price_type``. The charge state is applied to the transactions before the join.
    """
    wanted = ["transport_trans_id", "stage_id", "price_id", "price_type", "price_amount"]
    detail = by_period(star.fact("detail", span, wanted).filter(F.col("price_type") == "L"), span)
    failed = star.partner("txn", "detail", span, ["transport_trans_id", "charge_in_status"]).filter(
        F.col("charge_in_status").isin(labels.CANCELLED, labels.FAILED)
    ).select("transport_trans_id")
    stage = star.stages().select("stage_id", "cycle_name", F.col("checkout_toll_name").alias("toll_name"))
    priced = star.priced_vehicles().select("price_id", "vehicle_label", F.col(f"list_{ticket}"))
    places = ["cycle_name", *(["toll_name"] if by_plaza else [])]
    return (
        detail.join(failed, "transport_trans_id").join(stage, "stage_id").join(priced, "price_id")
        .groupBy("period", *places, "vehicle_label", f"list_{ticket}")
        .agg(F.count_distinct("transport_trans_id").alias("quantity"), amount(F.col("price_amount"), "amount"))
        .select(
            *span.labels(), *places, F.col("vehicle_label").alias("vehicle_type"), F.col(f"list_{ticket}").alias(ticket),
            "quantity", "amount",
        )
    )


def _between(star: Star, role: str, columns: list[str], column: str, from_day: date, to_day: date) -> DataFrame:
    """Rows of a fact with an event time between two dates, from the partitions that can hold them."""
    wide = star.window(role, from_day, to_day)
    rows = star.fact(role, wide, columns).drop("local_day") if wide else star.fact(role, columns=columns)
    low, high = datetime.combine(from_day, time.min), datetime.combine(to_day, time.min)
    return rows.filter(F.col(column).between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")))


def vehicle_transactions(star: Star, from_day: date, to_day: date, cycle_name: str | None = None) -> DataFrame:
    """Detail rows of the transactions between two dates, optionally of one route."""
    wanted = [
        "transport_trans_id", "checkin_datetime", "checkout_datetime", "plate", "etag_number", "vehicle_type",
        "charge_status", "total_amount", "checkin_lane_id", "checkout_lane_id",
    ]
    txn = _between(star, "txn", wanted, "checkout_datetime", from_day, to_day)
    stage = star.stages()
    if cycle_name is not None:
        stage = stage.filter(F.col("cycle_name") == cycle_name)
    days = star.window("txn", from_day, to_day)
    ticket = ["transport_trans_id", "stage_id", "price_type", "price_ticket_type", "price_amount"]
    detail = star.partner("detail", "txn", days, ticket) if days else star.fact("detail", columns=ticket)
    return detail.join(txn, "transport_trans_id").join(stage, "stage_id").select(
        F.date_format("checkout_datetime", "yyyyMMddHH").cast("bigint").alias("datetime_id"),
        "transport_trans_id", "checkin_datetime", "checkout_datetime", "plate", "etag_number", "vehicle_type",
        "checkin_toll_name", "checkout_toll_name", "price_type", "price_ticket_type", "charge_status",
        "price_amount", F.col("price_amount").alias("price_amount_tax"), "total_amount", "cycle_name",
        *null_money("price_bot"), F.lit("E").alias("source_trans"), "stage_name", "boo",
        typed_null("string").alias("boo_type"), "checkin_lane_id", "checkout_lane_id",
    )


# Measures of the report that have no definition yet.
UNDEFINED_MEASURES = (
    "bot_price_increase", "bot_amount_increase", "interoperable_price_increase", "interoperable_amount_increase",
    "increase_adjustment", "bot_amount_decrease", "interoperable_amount_decrease", "decrease",
    "bot_amount_total", "interoperable_amount_total", "total", "bot_amount_total_all", "interoperable_amount_total_all",
)


def vehicle_transaction_report(star: Star, from_day: date, to_day: date, cycle_name: str | None = None) -> DataFrame:
    """Distinct transactions per ticket kind, stage and plazas between two dates."""
    stage = star.stages()
    if cycle_name is not None:
        stage = stage.filter(F.col("cycle_name") == cycle_name)
    wanted = ["transport_trans_id", "stage_id", "price_type", "price_ticket_type", "checkin_datetime"]
    return (
        _between(star, "detail", wanted, "checkin_datetime", from_day, to_day)
        .join(stage, "stage_id")
        .groupBy("price_type", "price_ticket_type", "checkin_toll_name", "checkout_toll_name", "stage_name")
        .agg(F.count_distinct("transport_trans_id").alias("quantity"))
        .select("*", *null_money(*UNDEFINED_MEASURES))
    )
