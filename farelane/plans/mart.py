"""Reports that feed the mart: rows with the local day they belong to as ``year, month, day``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import Span
from farelane.sources.star import Star


def stage_transactions(star: Star, span: Span) -> DataFrame:
    """Transactions with tag, vehicle and entry place, as they go to the mart; the day is the row's own local day."""
    wanted = ["transport_trans_id", "etag_number", "vehicle_id", "checkin_toll_id", "checkin_lane_id"]
    rows = star.fact("txn", span, wanted)
    return rows.select(
        "transport_trans_id", F.col("etag_number").alias("etag_id"), "vehicle_id", "checkin_toll_id", "checkin_lane_id",
        *[F.date_format("local_day", p).alias(c) for c, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
    )
