"""Partition-scoped replace, publishing with manifest and retention, clearing with undo, parallel and cancelled batches."""

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import LEVELS, Span, label_columns
from farelane.operators import clearing, load, partitions, publishing
from farelane.plans import runner
from farelane.plans.catalog import resolved

DAYS = Span.backfill("day", "1997-03-30", "1997-04-02")


def report(star, span):
    """A row for each day of the span but the last."""
    days = star.spark.range((span.last - span.first).days).select(F.date_add(F.lit(span.first), F.col("id").cast("int")).alias("d"), "id")
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("date"), "id", *[F.date_format("d", p).alias(c) for c, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))])


def test_first_days_from_labels(spark):
    days = spark.range(4000).select(F.date_add(F.lit(date(1995, 1, 1)), F.col("id").cast("int")).alias("d"))
    for level in LEVELS:
        label = label_columns(level, F.col("d"))[publishing.PERIOD_LABELS[level]]
        first = F.date_format(Span(level, date(2000, 1, 1), date(2000, 1, 1)).period(F.col("d")), "yyyyMMdd")
        assert days.filter(publishing.first_day(level, label) != first).count() == 0


def test_only_the_period_changes(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = spark.range(90).select(F.date_format(F.date_add(F.lit(date(1997, 1, 1)), F.col("id").cast("int")), "yyyy-MM").alias("month_id"), "id")
    partitions.replace_period_partitions(rows, path, "month_id", None, "1997-01-01")
    before = partitions.Folder(spark, path).files()
    done = partitions.replace_period_partitions(rows.filter("month_id = '1997-02' AND id % 2 = 0"), path, "month_id", "month", "1997-02-10")
    after = partitions.Folder(spark, path).files()
    assert done == partitions.Replaced(("1997-02",), ("1997-02",))
    assert {k: v for k, v in before.items() if "1997-02" not in k} == {k: v for k, v in after.items() if "1997-02" not in k}
    assert partitions.read_partitioned(spark, path).count() == 90 - 14
    empty = partitions.replace_period_partitions(rows.filter("false"), path, "month_id", "month", "1997-02-10")
    assert empty == partitions.Replaced(("1997-02",), ())
    assert {r.partition for r in partitions.partition_listing(spark, path).collect()} == {"month_id=1997-01", "month_id=1997-03"}
    # New rows of another period are added beside its rows, as an insert after a delete would do.
    partitions.replace_period_partitions(rows.filter("month_id = '1997-03'"), path, "month_id", "month", "1997-02-10")
    assert partitions.read_partitioned(spark, path).filter("month_id = '1997-03'").count() == 62


def test_failed_new_rows_leave_the_target(spark, tmp_path):
    path = str(tmp_path / "target")
    partitions.replace_period_partitions(spark.range(3).withColumn("year_id", F.lit("1997")), path, "year_id", None, "1997-01-01")
    before = partitions.Folder(spark, path).files()
    with pytest.raises(Exception, match="broken row"):
        bad = spark.range(3).withColumn("id", F.raise_error(F.lit("broken row")).cast("long")).withColumn("year_id", F.lit("1997"))
        partitions.replace_period_partitions(bad, path, "year_id", "year", "1997-01-01")
    assert partitions.Folder(spark, path).files() == before


def test_stale_days_leave_the_mart(star, spark, tmp_path):
    path = str(tmp_path / "mart")
    load.write_mart(report(star, Span.backfill("day", "1997-03-01", "1997-04-30")), path)
    before = partitions.Folder(spark, path).files()
    done = partitions.replace_days(report(star, DAYS), path, DAYS.first, DAYS.last)
    assert done == partitions.Replaced(("1997-04-02",), ("1997-03-30", "1997-03-31", "1997-04-01"))
    after = partitions.Folder(spark, path).files()
    untouched = [k for k in before if not any(d in k for d in ("day=30", "day=31", "month=04/day=01", "month=04/day=02"))]
    assert all(after[k] == before[k] for k in untouched)
    assert load.read_mart(spark, path).count() == 59


def test_publishing_again_changes_nothing(star, spark, tmp_path):
    base, at = str(tmp_path / "out"), datetime(2024, 1, 1)
    for _ in range(2):
        assert publishing.publish(report(star, DAYS), base, "r", DAYS, at) == 3
        rows = sorted((r.period, r.rows, r.files) for r in publishing.manifest(spark, base).collect())
        assert rows == [("19970330", 1, 1), ("19970331", 1, 1), ("19970401", 1, 1)]
        assert sorted(r.period for r in publishing.published(spark, base).collect()) == ["19970330", "19970331", "19970401"]
    assert publishing.publish(report(star, DAYS).filter("false"), base, "r", DAYS, at) == 0
    assert publishing.manifest(spark, base).isEmpty() and publishing.published(spark, base).isEmpty()


def test_levels_share_a_day_and_reports_a_base(star, spark, tmp_path):
    base, month = str(tmp_path / "out"), Span.containing("month", "1997-04-01")
    monthly = spark.range(2).select(F.lit("1997-04").alias("month_id"), "id")
    publishing.publish(report(star, DAYS), base, "r", DAYS)
    publishing.publish(monthly, base, "r", month)
    publishing.publish(monthly, base, "s", month)
    publishing.publish(report(star, DAYS).filter("false"), base, "r", DAYS)
    left = {(r.report, r.level, r.period) for r in publishing.published(spark, base).collect()}
    assert left == {("r", "month", "19970401"), ("s", "month", "19970401")}
    assert {(r.report, r.level, r.period) for r in publishing.manifest(spark, base).collect()} == left


def test_expiry_goes_by_the_periods_end(spark):
    rows = [("r", p, lv) for p, lv in (("19970301", "day"), ("19970302", "day"), ("19970224", "week"), ("19970201", "month"), ("19970101", "quarter"), ("19970101", "year"))]
    listing = spark.createDataFrame(rows, "report string, period string, level string")
    gone = {(r.period, r.level) for r in publishing.expired_periods(listing, "1997-03-31", 30).collect()}
    assert gone == {("19970301", "day"), ("19970201", "month")}


def test_a_run_keeps_thirty_days_and_what_it_published(star, spark, tmp_path):
    base = str(tmp_path / "out")
    job = runner.Job("r", report, csv_path=base, keep_days=30)
    runner.run_batch(star, [Span.backfill("day", "1997-01-01", "1997-03-02")], [job])
    assert publishing.manifest(spark, base).count() == 60
    runner.run_batch(star, [Span.backfill("day", "1997-03-02", "1997-03-03")], [job])
    kept = sorted(r.period for r in publishing.published(spark, base).collect())
    assert kept[0] == "19970202" and kept[-1] == "19970302"
    assert sorted(r.period for r in publishing.manifest(spark, base).collect()) == kept
    runner.run_batch(star, [Span.backfill("day", "1997-03-02", "1997-03-03")], [job])
    assert sorted(r.period for r in publishing.published(spark, base).collect()) == kept


def test_empty_run_clears_what_its_periods_had(star, spark, tmp_path):
    csv, mart = str(tmp_path / "csv"), str(tmp_path / "mart")
    full, none = (runner.Job("r", r, csv_path=csv, mart_path=mart) for r in (report, lambda s, span: report(s, span).filter("false")))
    assert runner.run_job(star, DAYS, full)[2:5] == ("success", 3, "csv,mart")
    assert runner.run_job(star, DAYS, none)[2:4] == ("empty", 0)
    assert publishing.published(spark, csv).isEmpty() and partitions.partition_listing(spark, mart).isEmpty()


def _tables(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("parent", "child", "grandchild")}
    for n, path in paths.items():
        spark.range(len(n)).write.parquet(path)
    return paths, spark.createDataFrame([("child", "parent"), ("grandchild", "child")], "child string, parent string")


@pytest.mark.parametrize("fail_at", ["grandchild", "child", "parent"])
def test_a_failure_restores_all_tables(spark, tmp_path, fail_at):
    paths, references = _tables(spark, tmp_path)
    before = {n: partitions.Folder(spark, p).files() for n, p in paths.items()}

    def after_step(name):
        if name == fail_at:
            raise RuntimeError("planted")

    with pytest.raises(RuntimeError, match="planted"):
        clearing.clear_tables(spark, paths, references, after_step=after_step)
    assert {n: partitions.Folder(spark, p).files() for n, p in paths.items()} == before
    rows = clearing.clear_tables(spark, paths, references).collect()
    assert [tuple(r) for r in rows] == [("grandchild", 1, 10, 0), ("child", 2, 5, 0), ("parent", 3, 6, 0)]


def test_a_dead_driver_is_undone_from_the_journal(spark, tmp_path):
    paths, references = _tables(spark, tmp_path)
    journal = str(tmp_path / "journal")
    notes = clearing.Journal(spark, journal)
    # The state after a driver died between setting the second table aside and emptying it.
    for k, name in enumerate(("grandchild", "child")):
        notes.note(k, name, paths[name], f"{paths[name]}__aside")
        partitions.Folder(spark, paths[name]).move_to(partitions.Folder(spark, f"{paths[name]}__aside"))
    spark.range(0).write.parquet(paths["grandchild"])
    notes.note(2, "parent", paths["parent"], f"{paths['parent']}__aside")  # noted, not taken
    assert clearing.undo(spark, journal) == ["child", "grandchild"]
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {"parent": 6, "child": 5, "grandchild": 10}
    assert clearing.undo(spark, journal) == []


def test_referenced_tables_are_not_cleared(spark, tmp_path):
    paths, references = _tables(spark, tmp_path)
    with pytest.raises(ValueError, match="child by grandchild"):
        clearing.clear_tables(spark, {n: paths[n] for n in ("parent", "child")}, references)
    assert spark.read.parquet(paths["child"]).count() == 5


def test_four_at_once_give_the_sequential_rows(star, spark, tmp_path):
    def broken(s, span):
        return s.spark.range(1).select("no_such_column")

    def jobs(base):
        return [runner.Job(f"r{k}", broken if k == 3 else report, csv_path=f"{base}/{k}") for k in range(6)]

    spans = [DAYS, Span.containing("day", "1997-05-05")]
    one, four = (runner.run_batch(star, spans, jobs(str(tmp_path / str(n))), workers=n).drop("message").collect() for n in (1, 4))
    assert one == four
    assert [r.status for r in one] == ["success"] * 3 + ["error"] + ["success"] * 2 + ["empty"] * 3 + ["error"] + ["empty"] * 2
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty() and not star._frames


@pytest.mark.parametrize("workers", [1, 3])
def test_a_cancelled_batch_is_logged_and_ends(star, spark, workers):
    def endless(s, span):
        return s.spark.range(10**13).filter(F.hash("id") == F.lit(1) + F.hash(F.col("id") + 1)).groupBy().count()

    logged = []
    batch = runner.Batch(star, [DAYS], [runner.Job(f"r{k}", endless) for k in range(4)], lambda row, ms, trace: logged.append(row[2]), workers)
    from threading import Timer

    Timer(4, batch.cancel).start()
    began = time.monotonic()
    rows = batch.run().collect()
    assert time.monotonic() - began < 60
    assert [r.status for r in rows] == ["cancelled"] * 4 == logged
    assert spark.range(5).count() == 5


def test_log_has_the_registrys_fields(spark, tmp_path):
    path = str(tmp_path / "log")
    job = runner.Job("r", report, definition="sql/r.sql", job_type="1", delete_column="date", delete_condition="day")
    log = runner.log_to(spark, path, [job])
    log(("r", "day 1997-03-30..1997-04-02", "error", 0, "", "[UNRESOLVED_COLUMN.WITH_SUGGESTION] no"), 5, "trace")
    log(("r", "day 1997-03-30..1997-04-02", "success", 3, "csv", ""), 5, None)
    rows = {r.error_level: r for r in spark.read.parquet(path).collect()}
    bad, good = rows["ERROR"], rows["INFO"]
    assert (bad.sql_path, bad.job_type, bad.delete_column, bad.delete_condition) == ("sql/r.sql", "1", "date", "day")
    assert (bad.year, bad.month, bad.day, bad.error_code) == ("1997", "03", "30", "UNRESOLVED_COLUMN.WITH_SUGGESTION")
    assert (good.error_code, good.rows_inserted) == (None, 3)


def test_registry_names_resolve():
    assert resolved("boo_comparison") == "operator_pair_comparison"
    assert resolved("frontend_backend_comparison") == "frontend_backend_amounts"
    assert resolved("lane_revenue_month") == resolved("lane_revenue") == "lane_revenue"
    assert resolved("plaza_route_revenue", "day") == "plaza_route_share_daily"
    assert resolved("plaza_route_revenue_quarter", "quarter") == "plaza_route_share"
    assert resolved("transaction_summary") == "transaction_summary_by_stage"
    assert resolved("no_such_report") is None


def test_a_catalog_report_reaches_the_mart(star, spark, tmp_path):
    from farelane.plans.catalog import report as named

    span, path = Span.backfill("day", "1997-03-01", "1997-03-03"), str(tmp_path / "mart")
    row = runner.run_job(star, span, runner.Job("boo_offline_transaction", named("boo_offline_transaction"), mart_path=path))
    assert row[2] == "success" and row[4] == "mart"
    days = load.read_mart(spark, path).select("year", "month", "day").distinct().collect()
    assert {date(*map(int, r)) for r in days} <= {span.first + timedelta(days=k) for k in range(3)}
