"""Statistics on transactions: suspicious, failed, by channel, station and vehicle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.functions.text import typed_null
from farelane.plans.common import amount, by_period
from farelane.sources.star import Star


def _texts(*names: str) -> list[Column]:
    return [typed_null("string").alias(name) for name in names]


def _relabelled(groups: DataFrame, span: Span) -> DataFrame:
    return groups.select(*span.labels(), *[c for c in groups.columns if c != "period"])


LANE_KEYS = ("checkin_lane_id", "checkout_lane_id", "checkout_toll_id")


def _with_lanes(star: Star, txn: DataFrame) -> DataFrame:
    """Transactions with entry and exit lane names and the type of the exit plaza."""
    lane = star.small(star.table("lane").select("toll_lane_id", "lane_name"), "lane")
    plaza = star.tolls().select(F.col("toll_id").alias("checkout_toll_id"), F.col("toll_name").alias("plaza_name"), "toll_type")
    return (
        txn.join(lane.toDF("checkin_lane_id", "entry_lane"), "checkin_lane_id", "left")
        .join(lane.toDF("checkout_lane_id", "exit_lane"), "checkout_lane_id", "left")
        .join(plaza, "checkout_toll_id", "left")
    )


def _with_tariff(star: Star, txn: DataFrame) -> DataFrame:
    """Transactions with tariff, plazas, route and account, as the listings need them."""
    price = star.small(
        star.plaza_tariff().select(
            F.col("toll_id").alias("checkout_toll_id"), "vehicle_type", "price_type", "price_ticket_type",
            F.col("price_amount").alias("standard_fee"),
        ),
        "price",
    )
    toll = star.tolls()
    entry = toll.select(F.col("toll_id").alias("checkin_toll_id"), F.col("toll_id").alias("entry_toll_id"))
    leave = toll.select(F.col("toll_id").alias("checkout_toll_id"), F.col("toll_id").alias("exit_toll_id"), "toll_type")
    route = star.plaza_routes().select(F.col("toll_id").alias("checkout_toll_id"), "cycle_id", "cycle_name")
    account = star.small(star.table("account").select("account_id", "account_number"), "account")
    return (
        txn.join(price, ["checkout_toll_id", "vehicle_type"])
        .join(entry, "checkin_toll_id", "left").join(leave, "checkout_toll_id", "left")
        .join(route, "checkout_toll_id").join(account, "account_id")
    )


def suspicious_summary(star: Star, span: Span) -> DataFrame:
    """Transactions counted per time, plaza, lanes, charge status and operator."""
    txn = _with_lanes(star, star.fact("txn", span, [*LANE_KEYS, "checkout_commit_datetime", "charge_status", "boo"]))
    keys = {
        "date": "checkout_commit_datetime", "toll_id": "plaza_name", "toll_type": "toll_type",
        "entry_lane_id": "entry_lane", "exit_lane_id": "exit_lane", "transaction_type_id": "charge_status", "boo_id": "boo",
    }
    return (
        txn.groupBy(*[F.col(source).alias(name) for name, source in keys.items()]).agg(F.count("*").alias("quantity"))
        .select(
            "*", *_texts(
                "transaction_source", "reconciliation_request_source", "status", "station_id", "station_name",
                "transaction_source_name", "reconciliation_request_source_name", "total",
            ),
        )
    )


def suspicious_detail(star: Star, span: Span) -> DataFrame:
    """The distinct transactions behind the suspicious summary, with open audit fields."""
    wanted = [*LANE_KEYS, "checkout_commit_datetime", "charge_status", "boo", "plate", "vehicle_type", "total_amount"]
    return _with_lanes(star, star.fact("txn", span, wanted)).select(
        F.col("checkout_commit_datetime").alias("date"), F.col("plaza_name").alias("toll_id"), "toll_type",
        F.col("entry_lane").alias("entry_lane_id"), F.col("exit_lane").alias("exit_lane_id"),
        F.col("charge_status").alias("unusual_transaction_type"), F.col("boo").alias("boo_id"),
        F.col("plate").alias("license_plate"), "vehicle_type", F.col("total_amount").alias("price"),
    ).distinct().select(
        "*", *_texts(
            "transaction_source", "reconciliation_request_source", "post_audit_status", "explanation_status",
            "attribution_source", "reconciliation_status", "station_id", "station_name", "transaction_source_id",
            "transaction_source_name", "reconciliation_request_source_id", "reconciliation_request_source_name",
            "transaction_type_id", "transaction_type_name", "rfid", "status", "status_name", "deduction_count",
            "boo_name", "requester", "request_date", "processor",
        ),
    )


def error_statistics(star: Star, span: Span) -> DataFrame:
    """Distinct times, plazas, charge states and accounts of the transactions."""
    wanted = ["checkin_toll_id", "checkout_toll_id", "vehicle_type", "account_id", "checkout_commit_datetime", "charge_status"]
    return _with_tariff(star, star.fact("txn", span, wanted)).select(
        F.col("checkout_commit_datetime").alias("date"), "entry_toll_id", "exit_toll_id",
        F.col("charge_status").alias("transaction_type_id"), F.col("account_number").alias("account_code"),
    ).distinct().select(
        "*", *_texts(
            "transaction_error", "service_id", "code", "transaction_type", "transaction_type_name",
            "transaction_error_type", "entry_toll_name", "exit_toll_name", "service_name",
        ),
    )


def card_report(star: Star, span: Span, operators: tuple[int, int, int]) -> DataFrame:
    """Count and revenue per ticket class, revenue of three operators, and the share of
    the period's total (from the finished groups)."""
    txn = by_period(star.fact("txn", span, ["checkout_toll_id", "vehicle_type", "boo", "total_amount"]), span)
    price = star.small(
        star.plaza_tariff().select(F.col("toll_id").alias("checkout_toll_id"), "vehicle_type", "price_ticket_type"), "price"
    )
    groups = (
        txn.join(price, ["checkout_toll_id", "vehicle_type"]).groupBy("period", F.col("price_ticket_type").alias("card_type"))
        .agg(
            F.count("*").alias("total_transactions"),
            *[
                amount(F.when(F.col("boo") == boo, F.col("total_amount")).otherwise(0), f"boo{i}_revenue")
                for i, boo in enumerate(operators, start=1)
            ],
            amount(F.col("total_amount"), "total_revenue"),
        )
    )
    totals = groups.groupBy("period").agg(F.sum("total_revenue").alias("period_revenue"))
    rate = F.round(F.col("total_revenue").cast("double") / F.col("period_revenue").cast("double"), 6)
    return groups.join(totals, "period").select(
        *span.labels(), "card_type", "total_transactions", "boo1_revenue", "boo2_revenue", "boo3_revenue", "total_revenue",
        rate.alias("card_revenue_rate"),
    )


def payment_report(star: Star, span: Span, by: str, name: str) -> DataFrame:
    """Counts, success rate, refunds (rolled-back charges) and net amount per channel or provider."""
    txn = by_period(star.fact("txn", span, [by, "charge_status", "total_amount"]), span)
    status = F.col("charge_status")
    sums = txn.groupBy("period", F.col(by).alias(name)).agg(
        F.count("*").alias("total_transactions"), amount(F.col("total_amount"), "total_amount"),
        F.count_if(status.isin(*labels.CHARGE_SUCCESS)).alias("successful_transactions"),
        F.count_if(status == labels.CHARGE_FAILED).alias("failed_transactions"),
        amount(F.when(status == labels.CHARGE_ROLLED_BACK, F.col("total_amount")).otherwise(0), "refund_amount"),
    )
    rate = F.col("successful_transactions").cast("double") / F.col("total_transactions").cast("double")
    net = (F.col("total_amount") - F.col("refund_amount")).cast("decimal(28,2)")
    return sums.withColumns({"success_rate": F.round(rate, 6), "net_amount": net}).select(
        *span.labels(), name, "total_transactions", "total_amount", "successful_transactions", "failed_transactions",
        "success_rate", "refund_amount", "net_amount",
    )


def payment_channel(star: Star, span: Span) -> DataFrame:
    """Payments per checkout channel."""
    return payment_report(star, span, "checkout_channel", "payment_channel")


def payment_provider(star: Star, span: Span) -> DataFrame:
    """Payments per provider (the operator of the exit plaza, by name)."""
    sums = payment_report(star, span, "boo", "boo_id")
    names = star.table("operator").select("boo_id", F.col("boo_name").alias("payment_provider"))
    return sums.join(names, "boo_id", "left").drop("boo_id")


def station_activity(star: Star, span: Span) -> DataFrame:
    """Normal, failed and abnormal transactions and distinct vehicles per plaza, ticket class and channel."""
    wanted = ["checkin_toll_id", "checkout_toll_id", "vehicle_type", "vehicle_id", "account_id", "checkout_channel", "charge_status"]
    txn = by_period(_with_tariff(star, star.fact("txn", span, wanted)), span)
    status = F.col("charge_status")
    groups = txn.groupBy(
        "period", F.col("checkout_toll_id").alias("station_id"), F.col("price_ticket_type").alias("ticket_type_id"),
        F.col("checkout_channel").alias("toll_channel_id"),
    ).agg(
        F.count("*").alias("total_transactions"),
        F.count_if(status == labels.CHARGE_ROLLED_BACK).alias("abnormal_transactions"),
        F.count_if(status == labels.CHARGE_FAILED).alias("error_transactions"),
        F.count_if(status.isin(*labels.CHARGE_SUCCESS)).alias("normal_transactions"),
        F.count_distinct("vehicle_id").alias("total_vehicle_flow"),
    )
    return _relabelled(groups, span)


def other_cases(star: Star, span: Span) -> DataFrame:
    """Transactions without a successful charge, by exit plaza, route and case."""
    txn = star.fact("txn", span).filter(~F.col("charge_status").isin(*labels.CHARGE_SUCCESS))
    route = star.plaza_routes().select(F.col("toll_id").alias("checkout_toll_id"), "cycle_id", "cycle_name")
    return _with_lanes(star, txn).join(route, "checkout_toll_id", "left").select(
        F.col("checkout_commit_datetime").alias("date"), "toll_type", F.col("checkout_toll_id").alias("exit_toll_id"),
        F.col("cycle_id").alias("closed_cycle_id"), F.col("charge_status").alias("wb_type_id"),
        F.col("fe_trans_id").alias("transaction_code"), F.col("plate").alias("plate_number"),
        F.col("etag_number").alias("etag"), "vehicle_type", F.col("charge_in_status").alias("wb_type_name"),
        F.col("plaza_name").alias("exit_toll_name"), F.col("cycle_name").alias("closed_cycle_name"),
        F.col("checkin_datetime").alias("time_check_in"), F.col("checkout_datetime").alias("time_check_out"),
        F.col("total_amount").alias("toll_total"),
    )


def station_transactions(star: Star, span: Span) -> DataFrame:
    """Count and total per plaza, lanes, charge status and operator."""
    wanted = [*LANE_KEYS, "charge_status", "charge_in_status", "boo", "total_amount"]
    txn = by_period(_with_lanes(star, star.fact("txn", span, wanted)), span)
    groups = txn.groupBy(
        "period", F.col("checkout_toll_id").alias("toll_id"), "toll_type", F.col("plaza_name").alias("station_name"),
        F.col("entry_lane").alias("entry_lane_id"), F.col("exit_lane").alias("exit_lane_id"),
        F.col("charge_status").alias("transaction_type_id"), F.col("charge_in_status").alias("transaction_type_name"),
        F.col("boo").alias("boo_id"),
    ).agg(F.count("*").alias("total_transactions"), amount(F.col("total_amount"), "total"))
    return _relabelled(groups, span)


def transaction_detail(star: Star, span: Span) -> DataFrame:
    """Transactions with the tariff fee, the collected fee and their difference."""
    return _with_tariff(star, star.fact("txn", span)).select(
        F.col("checkout_commit_datetime").alias("date"), F.col("fe_trans_id").alias("transaction_code"),
        F.col("checkout_channel").alias("transaction_type"), F.col("charge_status").alias("transaction_status"),
        F.col("checkin_datetime").alias("entry_time"), F.col("checkin_toll_name").alias("entry_station"),
        F.col("checkout_datetime").alias("exit_time"), F.col("checkout_toll_name").alias("exit_station"),
        "etag_number", "vehicle_type", F.col("plate").alias("license_plate"), "account_number", "boo",
        F.col("price_ticket_type").alias("ticket_type"), "standard_fee", F.col("total_amount").alias("actual_fee"),
        (F.col("total_amount") - F.col("standard_fee")).cast("decimal(19,2)").alias("adjustment_amount"),
    )


def transactions_by_station(star: Star, span: Span) -> DataFrame:
    """Listing of transactions with plazas, tariff, account and status."""
    return _with_tariff(star, star.fact("txn", span)).select(
        F.col("checkout_commit_datetime").alias("date"), F.col("cycle_id").alias("station_id"),
        F.col("entry_toll_id").alias("toll_in_id"), F.col("exit_toll_id").alias("toll_out_id"),
        F.col("boo").alias("bot_id"), F.col("price_ticket_type").alias("ticket_type_id"),
        F.col("fe_trans_id").alias("transaction_code"), F.col("checkin_datetime").alias("toll_in_date"),
        F.col("checkout_datetime").alias("toll_out_date"), F.col("plate").alias("plate_number"),
        F.col("etag_number").alias("etag"), "vehicle_type", F.col("checkout_toll_name").alias("toll_name"), "toll_type",
        F.col("price_type").alias("ticket_type"), F.col("standard_fee").alias("ticket_type_price"),
        F.col("account_number").alias("traffic_account"), F.col("charge_status").alias("status"),
    )


def vehicle_violations(star: Star, span: Span) -> DataFrame:
    """Violations counted per vehicle, exit plaza, status and violated charge state."""
    txn = by_period(
        star.fact("txn", span, ["transport_trans_id", "plate", "etag_number", "checkout_toll_id", "charge_status", "account_id"]), span
    )
    violation = star.partner("violation", "txn", span, ["transport_trans_id", "status"]).select("transport_trans_id", F.col("status").alias("violation_status"))
    account = star.small(star.table("account").select("account_id", F.col("account_number").alias("traffic_account")), "account")
    groups = (
        txn.join(violation, "transport_trans_id").join(account, "account_id", "left")
        .groupBy(
            "period", F.col("plate").alias("plate_number"), F.col("etag_number").alias("etag"),
            F.col("checkout_toll_id").alias("toll_id"), F.col("violation_status").alias("status"),
            F.col("charge_status").alias("violation_type"), "traffic_account",
        )
        .agg(F.count("*").alias("violation_count"))
    )
    return _relabelled(groups, span)
