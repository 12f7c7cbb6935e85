"""Local calendar (UTC+7) over facts partitioned by UTC hour.

A local day is the last seven UTC hours of the day before plus the first
seventeen of the day itself. ``Span`` selects whole local periods, turns them into
a short predicate on the partition columns and labels each row with its period,
so that a back-fill over many periods is one job.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_OFFSET_HOURS = 7
FIRST_HOUR = f"{24 - LOCAL_OFFSET_HOURS:02d}"
LAST_HOUR = f"{23 - LOCAL_OFFSET_HOURS:02d}"
LEVELS = ("day", "week", "month", "quarter", "year")

# The Spark truncation unit of each level.
_TRUNC = {"week": "WEEK", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}

log = logging.getLogger(__name__)


def parse_day(text: str | date) -> date:
    """A ``yyyy-mm-dd`` text (or a date) as a date; any other format raises."""
    return text if isinstance(text, date) else datetime.strptime(text, "%Y-%m-%d").date()


def level_for(job_type: str | int | None) -> str:
    """Period level of a job type 1-5; anything else means a day, with a warning."""
    text = str(job_type)
    if text in ("1", "2", "3", "4", "5"):
        return LEVELS[int(text) - 1]
    log.warning("unknown job type %r, using day", job_type)
    return "day"


def level_column(job_type: Column) -> Column:
    """``level_for`` over a column."""
    code = job_type.try_cast("int")
    return F.coalesce(F.get(F.array(*[F.lit(x) for x in LEVELS]), code - 1), F.lit("day"))


def period_first(level: str, day: date) -> date:
    """First local day of the period around ``day``."""
    if level == "week":
        return day - timedelta(days=day.weekday())
    month = {"month": day.month, "quarter": (day.month - 1) // 3 * 3 + 1, "year": 1}.get(level)
    return day if month is None else date(day.year, month, 1)


def period_last(level: str, day: date) -> date:
    """Last local day of the period around ``day``."""
    if level == "day":
        return day
    first = period_first(level, day)
    if level == "week":
        return first + timedelta(days=6)
    reach = {"month": 31, "quarter": 100, "year": 366}[level]
    return period_first(level, first + timedelta(days=reach)) - timedelta(days=1)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


@dataclass(frozen=True)
class Span:
    """Whole local periods of one level, first to last day inclusive."""

    level: str
    first: date
    last: date

    @classmethod
    def containing(cls, level: str, day: str | date | None = None) -> Span:
        """The one period around ``day`` (default: yesterday)."""
        chosen = parse_day(day) if day else date.today() - timedelta(days=1)
        return cls(level, period_first(level, chosen), period_last(level, chosen))

    @classmethod
    def backfill(cls, level: str, from_day: str | date, to_day: str | date) -> Span:
        """All periods touched by the inclusive date range."""
        start, end = parse_day(from_day), parse_day(to_day)
        if start > end:
            raise ValueError("from_day must not be after to_day")
        return cls(level, period_first(level, start), period_last(level, end))

    @property
    def start_utc(self) -> datetime:
        """First UTC instant of the span."""
        return datetime.combine(self.first, datetime.min.time()) - timedelta(hours=LOCAL_OFFSET_HOURS)

    @property
    def end_utc(self) -> datetime:
        """First UTC instant after the span."""
        return self.start_utc + timedelta(days=(self.last - self.first).days + 1)

    def partition_filter(self) -> Column:
        """Predicate on the zero-padded string columns ``year, month, day, hour``.

        The two edge days are cut by hour. Everything between is whole days, which
        fold into at most five arms of whole years, whole months and day ranges, so
        the predicate stays short at every level and prunes partitions.
        """
        eve = self.first - timedelta(days=1)
        arms = [
            _on_day(eve) & (F.col("hour") >= FIRST_HOUR),
            _on_day(self.last) & (F.col("hour") <= LAST_HOUR),
        ]
        inner_last = self.last - timedelta(days=1)
        if self.first <= inner_last:
            arms += _whole_days(self.first, inner_last)
        return reduce(lambda a, b: a | b, arms)

    def period(self, day: Column) -> Column:
        """First local day of the period a day falls into: the cheap grouping key of a report."""
        return day if self.level == "day" else F.trunc(day, _TRUNC[self.level])

    def labels(self, period: str = "period") -> list[Column]:
        """Published label columns of a period, made from its first day."""
        return [column.alias(name) for name, column in label_columns(self.level, F.col(period)).items()]


def _on_day(day: date) -> Column:
    return _all(
        [
            F.col("year") == f"{day.year:04d}",
            F.col("month") == f"{day.month:02d}",
            F.col("day") == f"{day.day:02d}",
        ]
    )


def _whole_days(a: date, b: date) -> list[Column]:
    if a.year != b.year:
        arms = _within_year(a, date(a.year, 12, 31)) + _within_year(date(b.year, 1, 1), b)
        if b.year - a.year > 1:
            arms.append(F.col("year").between(f"{a.year + 1:04d}", f"{b.year - 1:04d}"))
        return arms
    return _within_year(a, b)


def _within_year(a: date, b: date) -> list[Column]:
    this_year = F.col("year") == f"{a.year:04d}"
    if a.month == b.month:
        in_month = this_year & (F.col("month") == f"{a.month:02d}")
        return [in_month & F.col("day").between(f"{a.day:02d}", f"{b.day:02d}")]
    arms, low, high = [], a.month, b.month
    if a.day > 1:
        head = (F.col("month") == f"{a.month:02d}") & (F.col("day") >= f"{a.day:02d}")
        arms.append(this_year & head)
        low += 1
    if b != period_last("month", b):
        tail = (F.col("month") == f"{b.month:02d}") & (F.col("day") <= f"{b.day:02d}")
        arms.append(this_year & tail)
        high -= 1
    if low <= high:
        arms.append(this_year & F.col("month").between(f"{low:02d}", f"{high:02d}"))
    return arms


def local_day() -> Column:
    """Local date of a row from its UTC partition columns."""
    utc = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return F.date_add(utc, F.when(F.col("hour") >= FIRST_HOUR, 1).otherwise(0))


def local_day_of(instant: Column) -> Column:
    """Local date of a UTC timestamp."""
    return F.to_date(instant + F.make_interval(hours=F.lit(LOCAL_OFFSET_HOURS)))


def iso_week(day: Column) -> Column:
    """ISO year and week as ``YYYYWW``."""
    week_year = F.date_part(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(week_year, F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def label_columns(level: str, day: Column) -> dict[str, Column]:
    """The label columns a report of this level carries."""
    if level == "day":
        return {
            "datetime_id": F.concat(F.date_format(day, "yyyyMMdd"), F.lit("00")),
            "date": F.date_format(day, "yyyy-MM-dd"),
        }
    if level == "week":
        return {"week_id": iso_week(day)}
    if level == "month":
        return {"month_id": F.date_format(day, "yyyy-MM")}
    if level == "quarter":
        name = F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string"))
        return {"quarter_id": name}
    return {"year_id": F.date_format(day, "yyyy")}


def period_attributes(days: DataFrame, day: str) -> DataFrame:
    """Attributes of each target date, one row per distinct date."""
    d = F.col(day)
    return days.select(day).distinct().select(
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.date_format(d, "yyyy")).alias("quarter"),
        iso_week(d).alias("week"),
        F.date_format(d, "yyyy-MM-dd").alias("date_str"),
    )


_LAST = {
    "week": lambda first: F.date_add(first, 6),
    "month": F.last_day,
    "quarter": lambda first: F.last_day(F.to_date(F.add_months(first, 2))),
    "year": lambda first: F.last_day(F.to_date(F.add_months(first, 11))),
}


def utc_ranges(days: DataFrame, day: str, level: str) -> DataFrame:
    """UTC hour ranges of the local periods around the given dates.

    Two ranges per local day. Dates of one period collapse before the days are
    generated, so the work grows with the number of periods.
    """
    d = F.col(day)
    first = d if level == "day" else F.trunc(d, _TRUNC[level])
    last = F.col("first") if level == "day" else _LAST[level](F.col("first"))
    eve, own = F.date_sub(F.col("local_day"), 1), F.col("local_day")
    ranges = F.array(
        F.struct(eve.alias("utc_day"), F.lit(FIRST_HOUR).alias("hour_start"), F.lit("23").alias("hour_end")),
        F.struct(own.alias("utc_day"), F.lit("00").alias("hour_start"), F.lit(LAST_HOUR).alias("hour_end")),
    )
    return (
        days.select(first.alias("first")).distinct()
        .select("first", F.explode(F.sequence("first", last)).alias("local_day"))
        .select("first", F.explode(ranges).alias("r"))
        .select(
            F.date_format("first", "yyyy-MM-dd").alias("period_start"),
            F.date_format("r.utc_day", "yyyy").alias("year"),
            F.date_format("r.utc_day", "MM").alias("month"),
            F.date_format("r.utc_day", "dd").alias("day"),
            "r.hour_start",
            "r.hour_end",
        )
    )


def calendar_dimension(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar rows between the two dates of a one-row frame."""
    d = F.col("d")
    week_start, month_start = F.trunc(d, "WEEK"), F.trunc(d, "MM")
    quarter_start = F.trunc(d, "QUARTER")
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("d")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d.alias("date_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        iso_week(d).alias("week_id"),
        F.weekofyear(d).alias("week_of_year"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        F.date_format(d, "yyyy-MM").alias("month_id"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        month_start.alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("quarter_id"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.date_format(d, "yyyy")).alias("quarter_name"),
        quarter_start.alias("quarter_start_date"),
        F.last_day(F.to_date(F.add_months(quarter_start, 2))).alias("quarter_end_date"),
        F.date_format(d, "yyyy").alias("year_id"),
        F.year(d).alias("year"),
    )
