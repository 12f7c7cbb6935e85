"""Traffic counts per plaza and per vehicle class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import Span
from farelane.plans.common import amount, by_period
from farelane.sources.star import Star


def plaza_traffic(star: Star, span: Span) -> DataFrame:
    """Tickets, revenue and traffic per stage and vehicle type, set against a second
    source that is not connected yet (constant zero), with the differences."""
    wanted = ["transport_trans_id", "stage_id", "vehicle_type", "price_type", "price_amount"]
    detail = by_period(star.fact("detail", span, wanted).filter(F.col("price_type") == "L"), span)
    known = star.partner("txn", "detail", span, ["transport_trans_id"])
    stage = star.small(star.table("stage").select("stage_id", F.col("stage_name").alias("plaza_name")), "stage")
    per_stage = (
        detail.join(known, "transport_trans_id").groupBy("period", "stage_id", "vehicle_type")
        .agg(F.count("*").alias("n"), amount(F.col("price_amount"), "revenue"))
    )
    zero_money = F.lit(0).cast("decimal(28,2)")
    sums = per_stage.join(stage, "stage_id").groupBy("period", "plaza_name", F.col("vehicle_type").alias("vehicle_type_profile")).agg(
        F.sum("n").alias("n"), amount(F.col("revenue"), "revenue")
    )
    measures_a = {"tickets_sold": F.col("n"), "revenue": F.col("revenue"), "traffic": F.col("n")}
    measures_b = {"tickets_sold": F.lit(0).cast("bigint"), "revenue": zero_money, "traffic": F.lit(0).cast("bigint")}
    return sums.select(
        span.labels()[-1], "plaza_name", "vehicle_type_profile",
        *[c.alias(f"data_a_{m}") for m, c in measures_a.items()],
        *[c.alias(f"data_b_{m}") for m, c in measures_b.items()],
        *[
            (measures_a[m] - measures_b[m]).cast("decimal(28,2)" if m == "revenue" else "bigint").alias(f"total_diff_{m}")
            for m in measures_a
        ],
    )


def station_traffic_by_class(star: Star, span: Span) -> DataFrame:
    """Distinct vehicles per passing time, summed per class into columns; then one row
    per priority type with its distinct vehicles (counted for types 2 and 3 only)."""
    final = by_period(star.fact("final", span, ["checkoutdatetime", "vehicleid", "prioritytype"]), span)
    vehicle = star.small(star.table("vehicle").select(F.col("vehicle_id").alias("vehicleid"), "vehicle_type_id"), "vehicle")
    seen = final.join(vehicle, "vehicleid")
    zero = F.lit(0).cast("bigint")
    classes = (
        seen.groupBy("period", "checkoutdatetime", "vehicle_type_id").agg(F.count_distinct("vehicleid").alias("n"))
        .groupBy("period")
        .agg(*[F.sum(F.when(F.col("vehicle_type_id") == k, F.col("n"))).alias(f"loai_{k}") for k in range(1, 6)])
        .withColumns({"monthly_quarterly_pass": zero, "priority_vehicle": zero})
    )
    passes = F.when(F.col("prioritytype").isin(2, 3), F.col("n"))
    priority = (
        seen.groupBy("period", "prioritytype").agg(F.count_distinct("vehicleid").alias("n"))
        .select(
            "period", *[zero.alias(f"loai_{k}") for k in range(1, 6)],
            passes.alias("monthly_quarterly_pass"), passes.alias("priority_vehicle"),
        )
    )
    rows = classes.unionByName(priority)
    return rows.select(*span.labels(), *[c for c in rows.columns if c != "period"])
