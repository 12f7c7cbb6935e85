"""Reports on partitioned catalog tables: same results, pruned partitions, no fact shuffle for dimensions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import Span
from farelane.plans import charges, operators_compared, revenue, share, statistics, summary
from farelane.sources import star as star_module
from farelane.sources.roles import DerivedStar
from farelane.sources.star import DIMENSIONS, Star

MONTH = Span.containing("month", "1997-10-15")
NEIGHBOURS = Span.backfill("month", "1997-09-01", "1997-11-30")


@pytest.fixture(scope="module")
def tables(spark):
    """The roles around one month as partitioned tables, and the plain star over the same rows."""
    source = DerivedStar(spark, "/root/testdata/sf0.001")
    spark.sql("CREATE DATABASE gold")
    for role in DIMENSIONS:
        source.table(role).write.saveAsTable(f"gold.{role}")
    parts = ["year", "month", "day", "hour"]
    columns = [c for c in source.fact("detail").columns if c != "local_day"]
    facts = {
        "detail": source.fact("detail", NEIGHBOURS, [*columns, "vehicle_id"]),
        "txn": source.fact("txn"), "subscription": source.fact("subscription", NEIGHBOURS),
    }
    for role, frame in facts.items():
        frame.drop("local_day").coalesce(1).write.partitionBy(*(parts if role != "txn" else parts[:1])).saveAsTable(f"gold.{role}")
    return Star(spark), source


REPORTS = [
    summary.transaction_summary_by_stage,
    share.plaza_route_share_daily,
    share.plaza_route_share,
    lambda s, span: revenue.detail_revenue(s, span, "plaza"),
    lambda s, span: charges.failed_charges(s, span, True, "price_type"),
    operators_compared.operator_pair_comparison_all,
]


@pytest.mark.parametrize("n", range(len(REPORTS)))
def test_tables_give_the_same_report(tables, n):
    catalog, derived = tables
    got, want = (sorted(map(str, REPORTS[n](s, MONTH).collect())) for s in (catalog, derived))
    assert got == want and got


def test_partitions_are_pruned(tables):
    catalog, _ = tables
    plan = catalog.fact("detail", MONTH, ["price_amount"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<price_amount:decimal(18,2)>" in plan


def test_raw_dates_reach_the_scan(star):
    plan = star.fact("detail", MONTH, ["price_amount"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_tax" not in plan


def test_small_dimensions_do_not_shuffle_the_fact(star):
    plan = share.plaza_route_share_daily(star, MONTH)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan


def test_large_dimension_is_not_broadcast_by_hint(spark, monkeypatch):
    monkeypatch.setattr(star_module, "BROADCAST_ROWS", 3)
    star = DerivedStar(spark, "/root/testdata/sf0.001")
    frame = star.table("vehicle")
    assert star.small(frame, "vehicle") is frame
    got = summary.transaction_summary_by_stage(star, MONTH)
    want = summary.transaction_summary_by_stage(DerivedStar(spark, "/root/testdata/sf0.001"), MONTH)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_optional_route_filter(star):
    window = (date(1996, 1, 1), date(1999, 1, 1))
    every = charges.vehicle_transaction_report(star, *window)
    route = star.table("cycle").orderBy("cycle_id").first().cycle_name
    stages = star.stage_closed().filter(F.col("cycle_name") == route).select("stage_name")
    one = charges.vehicle_transaction_report(star, *window, cycle_name=route)
    assert one.count() == every.join(stages, "stage_name", "left_semi").count() > 0


def test_payment_counts_add_up(star):
    bad = statistics.payment_channel(star, MONTH).filter("successful_transactions + failed_transactions > total_transactions")
    assert bad.isEmpty()


def test_command_line_runs_the_active_jobs(tables, spark, tmp_path):
    from farelane.__main__ import run

    jobs = [(1, "3", "payment_channel", True), (2, "3", "plaza_route_share", False), (3, "3", "no_such_report", True), (4, "1", "lane_revenue", True)]
    spark.createDataFrame(jobs, "id int, job_type string, table_name string, is_active boolean").write.saveAsTable("gold.etl_job")
    status = run(spark, ["3", "1997-10-15", "--schema", "gold", "--output", str(tmp_path)])
    assert {(r.job_name, r.status) for r in status.collect()} == {("payment_channel", "success"), ("no_such_report", "error")}
    logged = spark.read.parquet(f"{tmp_path}/run_log")
    assert {(r.job_name, r.error_level) for r in logged.collect()} == {("payment_channel", "INFO"), ("no_such_report", "ERROR")}
    assert spark.read.text(f"{tmp_path}/csv/payment_channel/19971001").count() > 0
    with pytest.raises(ValueError, match="no active job"):
        run(spark, ["5", "--from-date", "1997-10-01", "--to-date", "1997-10-02", "--schema", "gold", "--output", str(tmp_path)])
