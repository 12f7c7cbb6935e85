"""Report queries on the test tables, over all the periods the tables cover."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions import labels
from farelane.functions.calendar import Span
from farelane.operators import load
from farelane.operators.partitions import read_partitioned
from farelane.plans import charges, operators_compared, reconcile, revenue, rollup, share, statistics, summary, traffic
from farelane.session import scratch_path
from farelane.sources.roles import DerivedStar
from farelane.sources.star import reach_profile

Query = Callable[[SparkSession, str], DataFrame]
FROM_DAY, TO_DAY = "1995-01-01", "2001-12-31"
WINDOW = (date(1995, 6, 1), date(2001, 6, 1))


@lru_cache(maxsize=8)
def star(spark: SparkSession, sf_dir: str) -> DerivedStar:
    """One star per session and folder, as a batch of reports would hold it."""
    return DerivedStar(spark, sf_dir)


def whole(level: str) -> Span:
    """Every period of the level that the test tables touch."""
    return Span.backfill(level, FROM_DAY, TO_DAY)


def backfill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A back-fill of all days as one job, published in one folder per day, a month of it again, and read back."""
    path, held = scratch_path(spark, "backfill"), star(spark, sf_dir)
    result = revenue.transaction_revenue(held, whole("day"), "lane")
    load.write_csv(result, path, by=("date",))
    load.write_csv(revenue.transaction_revenue(held, Span.backfill("day", "1997-03-01", "1997-03-31"), "lane"), path, by=("date",))
    return load.read_csv(spark, path, result.schema).select(result.columns)


# Counts that may be NULL: compared as doubles, which both engines print alike.
NULLABLE_COUNTS = {f"{name}_pass_count" for name in labels.PRICE_TYPES.values()} | {
    "loai_1", "loai_2", "loai_3", "loai_4", "loai_5", "monthly_quarterly_pass", "priority_vehicle"
}


def comparable(df: DataFrame) -> DataFrame:
    """The result with types both engines print alike: decimals as doubles, dates as text."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) or f.name in NULLABLE_COUNTS:
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            changed[f.name] = F.date_format(f.name, "yyyy-MM-dd")
    return df.withColumns(changed) if changed else df


def report(plan: Callable[..., DataFrame], level: str = "day", **options) -> Query:
    """Bind a report to a level."""
    return lambda spark, sf_dir: plan(star(spark, sf_dir), whole(level), **options)


def report_queries() -> dict[str, Query]:
    """One query per report."""
    out: dict[str, Query] = {
        "transaction_summary_day": report(summary.transaction_summary_by_stage),
        "transaction_summary": report(summary.transaction_summary_by_price),
        "transaction_summary_month": report(summary.transaction_summary_by_lane, "month"),
        "transaction_summary_year": report(summary.transaction_summary_by_lane, "year"),
        "lane_revenue_day": _revenue("day", "lane"),
        "plaza_revenue_day": _detail_revenue("plaza"),
        "route_revenue_day": _detail_revenue("route"),
        "plaza_route_share_day": report(share.plaza_route_share_daily),
        "plaza_route_share_split": report(share.plaza_route_share_split, "month"),
        "plaza_traffic": report(traffic.plaza_traffic),
        "operator_pair_comparison": report(operators_compared.operator_pair_comparison),
        "operator_pair_comparison_all": report(operators_compared.operator_pair_comparison_all),
        "fare_sales_monitoring": report(reconcile.fare_sales_monitoring),
        "frontend_backend_amounts": report(reconcile.frontend_backend_amounts),
        "reconcile_front_back": report(reconcile.reconcile_front_back),
        "revenue_simulation": report(reconcile.revenue_simulation),
        "surcharge_list": report(reconcile.surcharge_list),
        "operator_revenue_adjusted": report(operators_compared.operator_revenue_adjusted),
        "station_traffic_by_class": report(traffic.station_traffic_by_class),
        "failed_charge_route": report(charges.failed_charges, by_plaza=False, ticket="price_ticket_type"),
        "failed_charge_route_detail": report(charges.failed_charges, by_plaza=False, ticket="price_type"),
        "failed_charge_plaza": report(charges.failed_charges, by_plaza=True, ticket="price_ticket_type"),
        "failed_charge_plaza_detail": report(charges.failed_charges, by_plaza=True, ticket="price_type"),
        "suspicious_summary": report(statistics.suspicious_summary),
        "suspicious_detail": report(statistics.suspicious_detail),
        "error_statistics": report(statistics.error_statistics),
        "vehicle_trans_detail": lambda spark, sf: charges.vehicle_transactions(star(spark, sf), *WINDOW),
        "vehicle_trans_report": lambda spark, sf: charges.vehicle_transaction_report(star(spark, sf), *WINDOW),
        "card_report": report(statistics.card_report, operators=(1, 2, 3)),
        "payment_channel": report(statistics.payment_channel),
        "payment_provider": report(statistics.payment_provider),
        "station_activity": report(statistics.station_activity),
        "other_cases": report(statistics.other_cases),
        "station_transactions": report(statistics.station_transactions),
        "transaction_detail": report(statistics.transaction_detail),
        "transactions_by_station": report(statistics.transactions_by_station),
        "vehicle_violations": report(statistics.vehicle_violations),
        "backfill_daily": backfill_daily,
    }
    out["transaction_summary_one_month"] = one_month(summary.transaction_summary_by_lane)
    out["plaza_route_share_one_month"] = one_month(share.plaza_route_share)
    out["failed_charge_plaza_one_month"] = one_month(charges.failed_charges, by_plaza=True, ticket="price_type")
    out["second_fact_reach"] = second_fact_reach
    for level in ("day", "month", "year"):
        out[f"route_revenue_rollup_{level}"] = revenue_rollup(level)
    for level in ("month", "quarter", "year"):
        for by in revenue.LEVEL_KEYS:
            out[f"{by}_revenue_{level}"] = _revenue(level, by)
        out[f"plaza_route_share_{level}"] = report(share.plaza_route_share, level)
    return out


MONTH = Span.containing("month", "1997-06-15")


def one_month(plan: Callable[..., DataFrame], **options) -> Query:
    """A report of a single month, as it is run every month."""
    return lambda spark, sf_dir: plan(star(spark, sf_dir), MONTH, **options)


def second_fact_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many days lie between the details and their transactions."""
    return reach_profile(star(spark, sf_dir), "detail", "txn")


def revenue_rollup(level: str) -> Query:
    """Route revenue from daily sets: all days made, June 1997 made again, then merged to longer periods."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, held = scratch_path(spark, "daily-sets"), star(spark, sf_dir)
        rollup.refresh_route_revenue(held, whole("day"), path)
        rollup.refresh_route_revenue(held, Span.backfill("day", "1997-06-01", "1997-06-30"), path)
        return rollup.route_revenue(read_partitioned(spark, path), whole(level))

    return query


def _revenue(level: str, by: str) -> Query:
    return lambda spark, sf_dir: revenue.transaction_revenue(star(spark, sf_dir), whole(level), by)


def _detail_revenue(by: str) -> Query:
    return lambda spark, sf_dir: revenue.detail_revenue(star(spark, sf_dir), whole("day"), by)
