"""Operator revenue: pairwise comparison and the view before and after adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import Span, label_columns
from farelane.plans.common import amount, by_period, joined_share, split_sum
from farelane.plans.share import split_groups
from farelane.sources.star import Star


def operator_revenue(star: Star, span: Span, with_passes: bool) -> DataFrame:
    """Split revenue per period and operator, from trips or trips and subscriptions."""
    groups, passes = split_groups(star, span, None, with_passes)
    if passes is not None:
        groups = groups.unionByName(passes)
    return joined_share(groups, star.table("share"), "period").groupBy("period", "boo").agg(split_sum("boo_revenue"))


def operator_pairs(revenue: DataFrame, names: DataFrame | None, difference: str) -> DataFrame:
    """Each pair of operators of one day with the absolute difference.

    The report is the list of pairs. Its input is one row per day and operator, so a
    day holds as many rows as there are operators; the join is on the day, with the
    operator order as the extra condition.
    """
    side = revenue
    if names is not None:
        side = side.join(names.toDF("boo", "boo_name"), "boo", "left")
    else:
        side = side.withColumn("boo_name", F.col("boo"))
    one = side.select("period", F.col("boo").alias("k1"), F.col("boo_name").alias("boo1"), F.col("boo_revenue").alias("boo1_revenue"))
    two = side.select("period", F.col("boo").alias("k2"), F.col("boo_name").alias("boo2"), F.col("boo_revenue").alias("boo2_revenue"))
    gap = F.abs(F.col("boo1_revenue") - F.col("boo2_revenue")).cast("decimal(38,6)")
    day = [column.alias(name) for name, column in label_columns("day", F.col("period")).items()]
    return one.join(two, "period").filter(F.col("k1") < F.col("k2")).select(
        *day, "boo1", "boo1_revenue", "boo2", "boo2_revenue", gap.alias(difference)
    )


def operator_pair_comparison(star: Star, span: Span) -> DataFrame:
    """Daily single-trip revenue of every operator pair, by operator name."""
    names = star.table("operator").select("boo_id", "boo_name")
    return operator_pairs(operator_revenue(star, span, with_passes=False), names, "differ")


def operator_pair_comparison_all(star: Star, span: Span) -> DataFrame:
    """Daily revenue of every operator pair with subscriptions, by operator id, in pair order."""
    pairs = operator_pairs(operator_revenue(star, span, with_passes=True), None, "difference")
    return pairs.drop("date").orderBy("datetime_id", "boo1", "boo2")


def operator_revenue_adjusted(star: Star, span: Span) -> DataFrame:
    """Revenue before adjustment, of the adjusted transactions, and after adjustment.

    Before and adjustment come from one pass over the details: a charged transaction
    adds a second, flagged copy of its rows. The charge list is reduced to distinct ids
    before it meets the fact. All three are reduced per transaction and plaza pair
    before the names are joined.
    """
    charged = star.partner("charge", "before", span, ["transporttransactionid"], "transporttransactionid").distinct().withColumn("charged", F.lit(True))
    key = ["period", "fromtollid", "totollid", "tickettype", "prioritytype", "transporttransactionid"]
    columns = [*key[1:], "paidamount"]

    def per_trip(role: str) -> DataFrame:
        return by_period(star.fact(role, span, columns), span).groupBy(*key).agg(amount(F.col("paidamount"), "paid"))

    kinds = F.array_compact(F.array(F.lit("before_adj_amount"), F.when(F.col("charged"), F.lit("adjustment_amount"))))
    before = per_trip("before").join(charged, "transporttransactionid", "left").withColumn("type", F.explode(kinds)).drop("charged")
    rows = before.unionByName(per_trip("final").withColumn("type", F.lit("after_adj_amount")))
    keys = ["period", "toll_type", "boo", "cycle_id", "cycle_name", "tickettype", "prioritytype", "type"]
    return (
        rows.join(star.stage_pairs(), ["fromtollid", "totollid"]).groupBy(*keys)
        .agg(F.count_distinct("transporttransactionid").alias("qty"), amount(F.col("paid"), "amount"))
        .select(
            *span.labels(), "toll_type", "boo", "cycle_id", "cycle_name", F.col("tickettype").alias("ticket_type"),
            F.col("prioritytype").alias("price_ticket_type"), "qty", "amount", "type",
        )
    )
