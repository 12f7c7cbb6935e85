"""Reports by name, as the job registry refers to them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame

from farelane.functions.calendar import LEVELS, Span
from farelane.plans import charges, mart, operators_compared, reconcile, revenue, share, statistics, summary, traffic
from farelane.sources.star import Star

# Fixed value: the operators whose revenue the card report sets apart.
CARD_OPERATORS = (1, 2, 3)
ONE_DAY = timedelta(days=1)
Report = Callable[[Star, Span], DataFrame]

REPORTS: dict[str, Report] = {
    "transaction_summary_by_stage": summary.transaction_summary_by_stage,
    "transaction_summary_by_price": summary.transaction_summary_by_price,
    "transaction_summary_by_lane": summary.transaction_summary_by_lane,
    "lane_revenue": partial(revenue.transaction_revenue, level="lane"),
    "plaza_revenue": partial(revenue.transaction_revenue, level="plaza"),
    "route_revenue": partial(revenue.transaction_revenue, level="route"),
    "plaza_revenue_by_stage": partial(revenue.detail_revenue, level="plaza"),
    "route_revenue_by_stage": partial(revenue.detail_revenue, level="route"),
    "plaza_route_share_daily": share.plaza_route_share_daily,
    "plaza_route_share": share.plaza_route_share,
    "plaza_route_share_split": share.plaza_route_share_split,
    "plaza_traffic": traffic.plaza_traffic,
    "station_traffic_by_class": traffic.station_traffic_by_class,
    "operator_pair_comparison": operators_compared.operator_pair_comparison,
    "operator_pair_comparison_all": operators_compared.operator_pair_comparison_all,
    "operator_revenue_adjusted": operators_compared.operator_revenue_adjusted,
    "fare_sales_monitoring": reconcile.fare_sales_monitoring,
    "frontend_backend_amounts": reconcile.frontend_backend_amounts,
    "reconcile_front_back": reconcile.reconcile_front_back,
    "revenue_simulation": reconcile.revenue_simulation,
    "surcharge_list": reconcile.surcharge_list,
    "failed_charge_route": partial(charges.failed_charges, by_plaza=False, ticket="price_ticket_type"),
    "failed_charge_route_detail": partial(charges.failed_charges, by_plaza=False, ticket="price_type"),
    "failed_charge_plaza": partial(charges.failed_charges, by_plaza=True, ticket="price_ticket_type"),
    "failed_charge_plaza_detail": partial(charges.failed_charges, by_plaza=True, ticket="price_type"),
    "suspicious_summary": statistics.suspicious_summary,
    "suspicious_detail": statistics.suspicious_detail,
    "error_statistics": statistics.error_statistics,
    "payment_channel": statistics.payment_channel,
    "payment_provider": statistics.payment_provider,
    "station_activity": statistics.station_activity,
    "other_cases": statistics.other_cases,
    "station_transactions": statistics.station_transactions,
    "transaction_detail": statistics.transaction_detail,
    "transactions_by_station": statistics.transactions_by_station,
    "vehicle_violations": statistics.vehicle_violations,
    "card_report": partial(statistics.card_report, operators=CARD_OPERATORS),
    "vehicle_transactions": lambda star, span: charges.vehicle_transactions(star, span.first, span.last + ONE_DAY),
    "vehicle_transaction_report": lambda star, span: charges.vehicle_transaction_report(star, span.first, span.last + ONE_DAY),
    "stage_transactions": mart.stage_transactions,
}

# Names that registries use for some of these. A period at the end of a name ("lane_revenue_month") is no part of it: the
# job type alone says which periods a run covers.
ALIASES = {
    "transaction_summary": "transaction_summary_by_stage", "boo_comparison": "operator_pair_comparison",
    "frontend_backend_comparison": "frontend_backend_amounts", "plaza_route_revenue": "plaza_route_share",
    "boo_offline_transaction": "stage_transactions",
}
# By name and level, where a report is another one by day.
BY_LEVEL = {("plaza_route_share", "day"): "plaza_route_share_daily"}


def resolved(name: str, level: str | None = None) -> str | None:
    """Name in ``REPORTS`` of a registry's name, or None."""
    stem, _, period = name.rpartition("_")
    for known in (name, stem if period in LEVELS else name):
        known = ALIASES.get(known, known)
        if known in REPORTS:
            return BY_LEVEL.get((known, level), known)
    return None


def report(name: str) -> Report:
    """The report of a registry's name; an unknown name fails when it is run, so a batch can go on."""

    def run(star: Star, span: Span) -> DataFrame:
        known = resolved(name, span.level)
        if known is None:
            raise KeyError(f"unknown report {name}")
        return REPORTS[known](star, span)

    return run
