"""Revenue per route and plaza as the base of the investor split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.plans.common import amount, by_period, joined_share, null_money, split_sum
from farelane.sources.star import Star

ALLOCATIONS = ("nsnn_revenue", "dbvn_revenue", "dvvh_revenue")


def plaza_route_share_daily(star: Star, span: Span) -> DataFrame:
    """Single-trip revenue per route and plaza, one row per investment class.

    Both classes carry the same revenue by contract: never add them up. The revenue is
    aggregated once, per stage before names are joined, and the finished rows are
    repeated per class.
    """
    detail = by_period(star.fact("detail", span, ["stage_id", "price_type", "price_amount"]).filter(F.col("price_type") == "L"), span)
    stage = star.stages().select(
        "stage_id", F.col("cycle_name").alias("route"), F.col("checkout_toll_name").alias("plaza_name")
    )
    classes = F.array(F.lit(labels.PRIVATE_INVESTMENT), F.lit(labels.PUBLIC_INVESTMENT))
    return (
        detail.groupBy("period", "stage_id").agg(amount(F.col("price_amount"), "amount"))
        .join(stage, "stage_id")
        .groupBy("period", "route", "plaza_name").agg(amount(F.col("amount"), "gross_revenue"))
        .select(
            *span.labels(), "route", "plaza_name", F.explode(classes).alias("cycle_type"), "gross_revenue",
            *null_money(
                "investment_amount", "discount_amount", "tax_amount", "pre_allocation_revenue",
                "bot1_revenue", "boo1_revenue", *ALLOCATIONS,
            ),
        )
    )


def plaza_route_share(star: Star, span: Span, subscription_types: tuple[str, ...] = ("L",)) -> DataFrame:
    """Trip revenue by entry route and exit plaza, plus subscriptions by entry plaza.

    Trip amounts are summed per transaction before they meet the transaction fact, so
    the join on the transaction id moves one row per transaction and period. Names are
    joined to plaza groups only.
    """
    detail = by_period(star.fact("detail", span, ["transport_trans_id", "price_amount"]), span)
    trips = detail.groupBy("transport_trans_id", "period").agg(amount(F.col("price_amount"), "amount"))
    routes, tolls = star.plaza_routes(), star.tolls()
    entry_route = routes.select(F.col("toll_id").alias("checkin_toll_id"), F.col("cycle_name").alias("route"))
    plaza = tolls.select("toll_id", F.col("toll_name").alias("plaza_name"))
    txn = star.partner("txn", "detail", span, ["transport_trans_id", "checkin_toll_id", "checkout_toll_id"])
    single = (
        trips.join(txn, "transport_trans_id")
        .groupBy("period", "checkin_toll_id", "checkout_toll_id").agg(amount(F.col("amount"), "revenue"))
        .join(entry_route, "checkin_toll_id", "left")
        .join(plaza.withColumnRenamed("toll_id", "checkout_toll_id"), "checkout_toll_id")
        .select("period", "route", "plaza_name", "revenue")
    )
    wanted = ["price_type", "toll_id", "toll_in_id", "toll_out_id", "price_amount"]
    bought = by_period(star.fact("subscription", span, wanted).filter(F.col("price_type").isin(*subscription_types)), span)
    passes = (
        bought.groupBy("period", "toll_id", "toll_in_id", "toll_out_id").agg(amount(F.col("price_amount"), "revenue"))
        .join(routes.select("toll_id", F.col("cycle_name").alias("route")), "toll_id")
        .join(plaza.withColumnRenamed("toll_id", "toll_in_id"), "toll_in_id")
        .join(tolls.select(F.col("toll_id").alias("toll_out_id")), "toll_out_id")
        .select("period", "route", "plaza_name", "revenue")
    )
    return (
        single.unionByName(passes).groupBy("period", "route", "plaza_name").agg(amount(F.col("revenue"), "gross_revenue"))
        .select(
            *span.labels(), "route", "plaza_name", F.lit(labels.PRIVATE_INVESTMENT).alias("cycle_type"), "gross_revenue",
            *null_money(
                "investment_amount", "discount_amount", "tax_amount", "pre_allocation_revenue",
                "bot1_revenue", "bot2_revenue", "boo1_revenue", *ALLOCATIONS,
            ),
        )
    )


def split_groups(star: Star, span: Span, place: str | None, with_passes: bool) -> tuple[DataFrame, DataFrame | None]:
    """Row counts and amounts per period, operator, vehicle and ticket type (and plaza).

    Trips and subscriptions separately. Trips are reduced per transaction before the
    join with the transaction fact, so no fact row meets a split rule.
    """
    wanted = ["transport_trans_id", "vehicle_type", "price_type", "price_amount"]
    detail = by_period(star.fact("detail", span, wanted).filter(F.col("price_type") == "L"), span)
    trips = detail.groupBy("transport_trans_id", "vehicle_type", "price_type", "period").agg(
        F.count("*").alias("n_rows"), amount(F.col("price_amount"), "amount")
    )
    exit_plaza = ["checkout_toll_id"] if place else []
    txn = star.partner("txn", "detail", span, ["transport_trans_id", "boo", *exit_plaza]).withColumnsRenamed({"checkout_toll_id": place or ""})
    keys = ["period", "boo", "vehicle_type", "price_type", *([place] if place else [])]
    single = trips.join(txn, "transport_trans_id").groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), amount(F.col("amount"), "amount")
    )
    if not with_passes:
        return single, None
    columns = ["boo", "vehicle_type", "price_type", "price_amount", *(["toll_id"] if place else [])]
    bought = by_period(star.fact("subscription", span, columns), span).withColumnsRenamed({"toll_id": place or ""})
    return single, bought.groupBy(*keys).agg(F.count("*").alias("n_rows"), amount(F.col("price_amount"), "amount"))


def plaza_route_share_split(star: Star, span: Span) -> DataFrame:
    """Revenue by exit route and plaza with the operator's part by effective rule.

    The rule date is the first local day of each period.
    """
    single, passes = split_groups(star, span, "toll_id", with_passes=True)
    route = star.plaza_routes().select("toll_id", F.col("cycle_name").alias("route"))
    plaza = star.tolls().select("toll_id", F.col("toll_name").alias("plaza_name"))
    share = star.table("share")
    named_single = joined_share(single, share, "period").join(route, "toll_id", "left").join(plaza, "toll_id")
    named_passes = joined_share(passes, share, "period").join(route, "toll_id").join(plaza, "toll_id")
    out = ["period", "route", "plaza_name"]
    return (
        named_single.select(*out, "amount", "split").unionByName(named_passes.select(*out, "amount", "split"))
        .groupBy(*out).agg(amount(F.col("amount"), "gross_revenue"), split_sum("boo1_revenue"))
        .select(
            *span.labels(), "route", "plaza_name", F.lit(labels.PRIVATE_INVESTMENT).alias("cycle_type"), "gross_revenue",
            *null_money("investment_amount", "discount_amount", "tax_amount"),
            F.col("gross_revenue").alias("pre_allocation_revenue"),
            *null_money("bot1_revenue", "bot2_revenue"), "boo1_revenue", *null_money(*ALLOCATIONS),
        )
    )
