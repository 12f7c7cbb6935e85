"""Published periods: a folder for each report and period, a manifest of what stands there, and their expiry.

A period's CSV stands in ``<base>/<report>/<first day as yyyymmdd>/level=<level>``. The manifest holds one row for each such
folder; it is kept per report and level, so publishing one report never rewrites another one's rows. All that reaches the driver
is a row for each period of the run.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.calendar import Span, parse_day, period_last
from farelane.operators.load import write_csv
from farelane.operators.partitions import Folder

# The label column that names a row's period, by level.
PERIOD_LABELS = {"day": "date", "week": "week_id", "month": "month_id", "quarter": "quarter_id", "year": "year_id"}
MANIFEST = "report string, level string, period string, path string, rows bigint, files int, bytes bigint, published_at timestamp_ntz"
FOLDER = "_manifest"


def first_day(level: str, label: Column) -> Column:
    """First day of the period that a label names, as ``yyyymmdd``."""
    year = F.substring(label, 1, 4)
    if level == "day":
        return F.translate(label, "-", "")
    if level == "month":
        return F.concat(year, F.substring(label, 6, 2), F.lit("01"))
    if level == "quarter":
        month = F.substring(label, 7, 1).cast("int") * 3 - 2
        return F.concat(year, F.lpad(month.cast("string"), 2, "0"), F.lit("01"))
    if level == "year":
        return F.concat(year, F.lit("0101"))
    fourth = F.make_date(year.cast("int"), F.lit(1), F.lit(4))  # always in the first ISO week
    return F.date_format(F.date_add(F.trunc(fourth, "WEEK"), (F.substring(label, 5, 2).cast("int") - 1) * 7), "yyyyMMdd")


def periods_of(span: Span) -> list[date]:
    """First days of the span's periods."""
    found, day = [], span.first
    while day <= span.last:
        found.append(day)
        day = period_last(span.level, day) + timedelta(days=1)
    return found


def with_first_day(result: DataFrame, span: Span, name: str = "_first") -> DataFrame:
    """The result with each row's period; a result without text labels is one period, the whole span."""
    label = PERIOD_LABELS[span.level]
    labelled = dict(result.dtypes).get(label) == "string"
    return result.withColumn(name, first_day(span.level, F.col(label)) if labelled else F.lit(f"{span.first:%Y%m%d}"))


def publish(result: DataFrame, base: str, report: str, span: Span, published_at: datetime | None = None) -> int:
    """Publish a result and note it in the manifest; returns its rows.

    The rows are complete beside the target before the first period is moved, and each period is replaced as a whole. A period
    of the span without rows loses its folder and its manifest row, so nothing stale stays. The result is read twice (rows per
    period, then the rows), so the caller holds it if it is costly. Publishing again gives the same folders and manifest.
    """
    spark = result.sparkSession
    rows = with_first_day(result, span)
    counts = {r["_first"]: r["count"] for r in rows.groupBy("_first").count().collect()}
    home = Folder(spark, f"{base}/{report}")
    staged = Folder(spark, f"{base}/.staged-{uuid4().hex}")
    if counts:
        write_csv(rows, staged.path, by=("_first",))
    at, entries = published_at or datetime.now(), []
    for first in sorted({f"{d:%Y%m%d}" for d in periods_of(span)} | counts.keys()):
        place = home.child(f"{first}/level={span.level}")
        if first not in counts:
            drop_period(home, first, span.level)
            continue
        staged.child(f"_first={first}").replace(place)
        files = place.files()
        entries.append((report, span.level, first, place.path, counts[first], len(files), sum(size for size, _ in files.values()), at))
    staged.remove()
    touched = [f"{d:%Y%m%d}" for d in periods_of(span)] + [e[2] for e in entries]
    _note(spark, base, report, span.level, touched, entries)
    return sum(counts.values())


def drop_period(home: Folder, first: str, level: str) -> None:
    """Remove one published period, and its day's folder if nothing else is in it."""
    home.child(f"{first}/level={level}").remove()
    if not home.child(first).names():
        home.child(first).remove()


def _note(spark: SparkSession, base: str, report: str, level: str, touched: list[str], entries: list[tuple]) -> None:
    """The manifest of a report and level without the touched periods, and with their new rows."""
    place = Folder(spark, f"{base}/{FOLDER}/report={report}/level={level}")
    if not entries and not place.exists():
        return
    staged = Folder(spark, f"{base}/.manifest-{uuid4().hex}")
    new = spark.createDataFrame(entries, MANIFEST)
    if place.exists():
        old = spark.read.schema(MANIFEST).parquet(place.path)
        gone = spark.createDataFrame([(t,) for t in set(touched)], "period string")
        new = old.join(F.broadcast(gone), "period", "left_anti").select(new.columns).unionByName(new)
    new.coalesce(1).write.parquet(staged.path)  # one row for each period that is kept
    staged.replace(place)


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """All published periods of all reports."""
    folder = Folder(spark, f"{base}/{FOLDER}")
    paths = [f"{folder.path}/{r}/{lv}" for r in folder.names() for lv in folder.child(r).names()]
    return spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)


def published(spark: SparkSession, base: str) -> DataFrame:
    """``report, period, level, files, bytes``: the published folders as they stand, read from their names."""
    home, rows = Folder(spark, base), []
    for report in home.names():
        for period in home.child(report).names():
            for level in home.child(f"{report}/{period}").names() if period.isdigit() and len(period) == 8 else []:
                files = home.child(f"{report}/{period}/{level}").files()
                rows.append((report, period, level.removeprefix("level="), len(files), sum(size for size, _ in files.values())))
    return spark.createDataFrame(rows, "report string, period string, level string, files int, bytes bigint")


def expired_periods(listing: DataFrame, base_day: str | date, keep_days: int = 30) -> DataFrame:
    """Rows of a listing whose period ended on or before ``base_day`` less ``keep_days``."""
    cutoff = parse_day(base_day) - timedelta(days=keep_days)
    first = F.to_date("period", "yyyyMMdd")
    months = {"month": 1, "quarter": 3, "year": 12}
    end = F.when(F.col("level") == "week", F.date_add(first, 6))
    for level, n in months.items():
        end = end.when(F.col("level") == level, F.date_sub(F.to_date(F.add_months(first, n)), 1))
    return listing.filter(end.otherwise(first) <= F.lit(cutoff))


def expire(spark: SparkSession, base: str, report: str, base_day: str | date, keep_days: int = 30, spare: Span | None = None) -> int:
    """Remove a report's expired periods and their manifest rows; returns how many. The periods of ``spare`` stay."""
    listing = published(spark, base).filter(F.col("report") == report)
    kept = {(f"{d:%Y%m%d}", spare.level) for d in periods_of(spare)} if spare else set()
    gone = [(r.period, r.level) for r in expired_periods(listing, base_day, keep_days).collect() if (r.period, r.level) not in kept]
    home = Folder(spark, f"{base}/{report}")
    for period, level in gone:
        drop_period(home, period, level)
    for level in {level for _, level in gone}:
        _note(spark, base, report, level, [p for p, lv in gone if lv == level], [])
    return len(gone)
