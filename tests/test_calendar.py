from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelane.functions import calendar
from farelane.functions.calendar import Span
from farelane.sources.roles import with_partitions


@pytest.fixture(scope="module")
def hours(spark):
    """Every UTC hour from 2023-11 to 2027-01-04."""
    start, count = datetime(2023, 11, 1), 24 * 1161
    rows = spark.range(count).select(
        (F.lit(start).cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int"))).alias("t")
    )
    return with_partitions(rows, "t").cache()


def selected(hours, span):
    found = hours.filter(span.partition_filter()).agg(F.count("*"), F.min("t"), F.max("t")).first()
    return tuple(found)


@pytest.mark.parametrize("level", calendar.LEVELS)
@pytest.mark.parametrize("day", ["2024-02-29", "2026-01-01", "2024-12-31", "2025-06-15"])
def test_partition_filter_is_the_utc_range(hours, level, day):
    span = Span.containing(level, day)
    n, first, last = selected(hours, span)
    assert n == 24 * ((span.last - span.first).days + 1)
    assert first == span.start_utc and last == span.end_utc - timedelta(hours=1)


@settings(max_examples=25, deadline=None)
@given(st.dates(date(2023, 12, 1), date(2025, 12, 31)), st.integers(0, 500))
def test_partition_filter_of_any_range(hours, first, length):
    last = min(first + timedelta(days=length), date(2026, 1, 31))
    span = Span.backfill("day", first, last)
    n, low, high = selected(hours, span)
    assert (n, low, high) == (24 * ((last - first).days + 1), span.start_utc, span.end_utc - timedelta(hours=1))


def test_filter_stays_short_for_many_years():
    text = str(Span.backfill("day", "1995-03-07", "2024-11-19").partition_filter())
    assert text.count("or(") <= 6


def test_days_of_a_month_cover_the_month_once(hours):
    month = Span.containing("month", "2024-02-10")
    days = [Span.containing("day", month.first + timedelta(days=i)) for i in range(29)]
    assert month.last == date(2024, 2, 29)
    assert sum(selected(hours, d)[0] for d in days) == selected(hours, month)[0]
    assert all(a.end_utc == b.start_utc for a, b in zip(days, days[1:]))


def test_local_day_matches_the_clock(hours):
    assert hours.filter(calendar.local_day() != calendar.local_day_of(F.col("t"))).count() == 0


def test_iso_year_boundary(spark):
    span = Span.containing("week", "2026-01-01")
    assert (span.first, span.last) == (date(2025, 12, 29), date(2026, 1, 4))
    row = spark.createDataFrame([(date(2026, 1, 1),), (date(2024, 12, 30),)], "d date")
    weeks = {r.date_str: r.week for r in calendar.period_attributes(row, "d").collect()}
    assert weeks == {"2026-01-01": "202601", "2024-12-30": "202501"}
    ranges = calendar.utc_ranges(row.limit(1), "d", "day").orderBy("year", "month", "day").collect()
    assert [tuple(r) for r in ranges] == [
        ("2026-01-01", "2025", "12", "31", "17", "23"), ("2026-01-01", "2026", "01", "01", "00", "16")
    ]


def test_levels_and_dates():
    assert [calendar.level_for(t) for t in ("1", 2, "3", 4, "5", "9", None, "x")] == [
        "day", "week", "month", "quarter", "year", "day", "day", "day"
    ]
    with pytest.raises(ValueError):
        Span.backfill("day", "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        Span.containing("day", "01/02/2024")
    yesterday = date.today() - timedelta(days=1)
    assert Span.containing("day").first == yesterday


def test_labels(spark):
    rows = spark.createDataFrame([(date(2024, 5, 9),)], "period date")
    out = {}
    for level in calendar.LEVELS:
        out.update(rows.select(*Span.containing(level, "2024-05-09").labels()).first().asDict())
    assert out == {
        "datetime_id": "2024050900", "date": "2024-05-09", "week_id": "202419", "month_id": "2024-05",
        "quarter_id": "2024-Q2", "year_id": "2024",
    }
