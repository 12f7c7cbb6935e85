"""Every registered query against its own SQL, and the properties of the report set."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.query_reports import whole
from farelane.functions import labels
from farelane.plans import revenue, share, summary
from tests.conftest import SF

QUERIES, SQL = contract.queries(), contract.oracle_sql()
# The training-data operators have tests of their own.
SQL = {name: sql for name, sql in SQL.items() if not re.match(r"op\d+_|pipeline$", name)}
OWN = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= OWN
    assert OWN == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert difference(got, duck.execute(SQL[name]).df()) == ""


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert not any(f.dataType.typeName() == "void" for f in result.schema.fields)


def test_batch_isolates_a_failing_job(spark):
    rows = {(r.job_name, r.status) for r in QUERIES["run_batch_status"](spark, SF).collect()}
    assert rows == {
        ("payment_channel", "success"), ("broken", "error"), ("transaction_summary", "success"),
        ("payment_channel", "empty"), ("transaction_summary", "empty"),
    }


def test_ordered_queries_are_ordered(spark):
    runs = QUERIES["latest_failed_runs"](spark, SF).collect()
    assert [(r.run_at, r.id) for r in runs] == sorted([(r.run_at, r.id) for r in runs], reverse=True)
    pairs = [(r.datetime_id, r.boo1, r.boo2) for r in QUERIES["operator_pair_comparison_all"](spark, SF).collect()]
    assert pairs == sorted(pairs)


def test_channel_rows_equal_vehicle_rows(star):
    for level in revenue.LEVEL_KEYS:
        sums = revenue.transaction_revenue(star, whole("month"), level).groupBy("type").agg(
            F.sum("transaction_count").alias("n"), F.sum("gross_revenue").alias("g")
        ).collect()
        assert len({(r.n, r.g) for r in sums}) == 1


def test_pivot_adds_up(star):
    out = summary.transaction_summary_by_lane(star, whole("year"))
    parts = [F.coalesce(F.col(f"{n}_pass_revenue"), F.lit(0)) for n in labels.PRICE_TYPES.values()]
    assert out.filter(sum(parts[1:], parts[0]) != F.col("total_revenue")).count() == 0


def test_lane_summary_holds_nothing_per_transaction(star):
    out = summary.transaction_summary_by_lane(star, whole("year"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [" in line and "l_orderkey" in line] and "LeftSemi" not in plan
    txn = star.fact("txn", whole("year"), ["transport_trans_id", "total_amount"])
    both = txn.join(star.fact("detail", columns=["transport_trans_id"]), "transport_trans_id")
    totals = both.agg(F.count("*").alias("n"), F.sum("total_amount").alias("g")).first()
    assert out.agg(F.sum("total_pass_count").alias("n"), F.sum("total_revenue").alias("g")).first() == totals


def test_stage_view_is_unique_and_keeps_rows(star):
    stage = star.stage_closed()
    assert stage.count() == stage.select("stage_id").distinct().count()
    detail = star.fact("detail")
    active = detail.join(star.table("stage").filter("status = 'true'").select("stage_id"), "stage_id", "left_semi")
    assert detail.join(stage, "stage_id").count() == active.count()


def test_classes_carry_the_same_revenue(star):
    rows = share.plaza_route_share_daily(star, whole("month"))
    sums = rows.groupBy("cycle_type").agg(F.sum("gross_revenue").alias("g")).collect()
    assert len(sums) == 2 and len({r.g for r in sums}) == 1


def test_empty_period_gives_no_rows(star):
    from farelane.functions.calendar import Span

    span = Span.containing("month", "2040-01-01")
    assert summary.transaction_summary_by_stage(star, span).isEmpty()
    assert revenue.transaction_revenue(star, span, "lane").isEmpty()
