"""The star schema the reports read, by role.

``Star`` reads catalog tables. Facts come with a
``local_day`` column. A subclass may derive the roles from other tables (see
``roles.py``); reports only use the methods below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.calendar import Span, local_day

DIMENSIONS = frozenset(
    ("stage", "toll", "lane", "cycle", "toll_cycle", "price", "vehicle", "domain", "operator", "share", "account")
)


def held(build: Callable) -> Callable:
    """Build a dimension frame once per star; it stays lazy."""

    @wraps(build)
    def frame(self, *args):
        key = (build.__name__, *args)
        if key not in self._frames:
            self._frames[key] = build(self, *args)
        return self._frames[key]

    return frame


# Most rows a dimension may have to be broadcast (some 100 MB of names and ids).
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Reach:
    """Where the partners of a fact's row are partitioned in another fact: local days before and after its own."""

    before: int
    after: int

    def turned(self) -> Reach:
        """The same bound seen from the other fact."""
        return Reach(self.after, self.before)


class Star:
    """Facts and dimensions as lazy frames.

    ``names`` maps a role to a table name; a role without an entry uses its own
    name below ``schema``. Facts take a span and filter on their partition columns.

    ``reach`` declares how two facts are partitioned relative to each other: for (fact, second fact) the days between rows that
    share a key. A report of a span then reads only those partitions of its second fact; ``reach_profile`` measures what holds.
    ``by_key`` names facts whose files keep to ranges of the key (ids that grow with time): of those without a reach a report reads
    the range of its first fact's keys. Of any other second fact all rows are read, and only Spark's runtime filters cut them before
    the join. ``slack`` is the days by which a fact's event times may lie away from its partition's day.
    """

    def __init__(
        self, spark: SparkSession, schema: str = "gold", names: dict[str, str] | None = None,
        reach: dict[tuple[str, str], Reach] | None = None, slack: dict[str, int] | None = None, by_key: frozenset[str] = frozenset(),
    ):
        self._reach = {(b, a): r.turned() for (a, b), r in (reach or {}).items()} | (reach or {})
        self._slack = slack or {}
        self._by_key = by_key
        self.spark = spark
        self._schema = schema
        self._names = names or {}
        self._rows: dict[str, int] = {}
        self._frames: dict[tuple, DataFrame] = {}

    def release(self) -> None:
        """Forget held frames and row counts, so that the next batch sees dimensions as they then are."""
        self._frames.clear()
        self._rows.clear()

    def table(self, role: str) -> DataFrame:
        """The whole table of a role."""
        return self.spark.table(self._names.get(role, f"{self._schema}.{role}"))

    def fact(self, role: str, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        """Rows of a fact, pruned to the partitions of the span, with the named columns.

        Without ``columns`` all columns come along; ``local_day`` comes with any span.
        """
        rows = self.table(role)
        if span is not None:
            rows = rows.filter(span.partition_filter())
        if "hour" in rows.columns:
            rows = rows.withColumn("local_day", local_day())
        return _chosen(rows, columns, span)

    def partner_span(self, role: str, of: str, span: Span) -> Span | None:
        """The days of ``role`` that can hold partners of the span's rows of the fact ``of``; None if not declared."""
        bound = self._reach.get((of, role))
        return bound and Span("day", span.first - timedelta(days=bound.before), span.last + timedelta(days=bound.after))

    def partner(self, role: str, of: str, span: Span, columns: list[str], key: str = "transport_trans_id") -> DataFrame:
        """Rows of a second fact that can belong to the span's rows of the fact ``of``: all that do, and as few others as is known."""
        wide = self.partner_span(role, of, span)
        if wide is not None:
            return self.fact(role, wide, columns).drop("local_day")
        rows = self.fact(role, columns=columns)
        if role not in self._by_key:
            return rows
        # Two values that Spark finds before it scans the second fact, whose files' statistics then rule most of them out.
        ends = self.fact(of, span, [key]).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        return rows.filter(F.col(key).between(ends.select("low").scalar(), ends.select("high").scalar()))

    def window(self, role: str, from_day: date, to_day: date) -> Span | None:
        """The days of ``role`` that can hold events between two dates, both included; None if not declared."""
        if role not in self._slack:
            return None
        slack = timedelta(days=self._slack[role])
        return Span("day", from_day - slack, to_day + slack)

    def rows(self, role: str) -> int:
        """Row count of a dimension, read once (from file footers)."""
        if role not in self._rows:
            self._rows[role] = self._count(role)
        return self._rows[role]

    def _count(self, role: str) -> int:
        return self.table(role).count()

    def small(self, frame: DataFrame, role: str) -> DataFrame:
        """``frame``, to be broadcast if the dimension that bounds its rows is small enough.

        Spark cannot size a frame joined from several dimensions and would shuffle the
        fact to meet it. Above the limit no hint is given and the join shuffles, with
        adaptive skew handling.
        """
        return F.broadcast(frame) if self.rows(role) <= BROADCAST_ROWS else frame

    @held
    def plaza_prices(self) -> DataFrame:
        """The whole price list; a plaza and vehicle type may have several prices."""
        return self.table("price")

    @held
    def plaza_tariff(self) -> DataFrame:
        """One price per plaza and vehicle type: the one with the smallest price id of the whole list."""
        prices = self.plaza_prices()
        first = F.min_by(F.struct(*prices.columns), "price_id")
        return prices.groupBy("toll_id", "vehicle_type").agg(first.alias("_first")).select("_first.*")

    @held
    def domain(self, kind: str) -> DataFrame:
        """Code and name of one code list."""
        return self.table("domain").filter(F.col("type") == kind).select("code", F.col("name").alias("domain_name"))

    @held
    def stage_closed(self) -> DataFrame:
        """Active stages with plaza and route names; one row per stage.

        Lanes are left out: they would repeat a stage once per pair of an entry and
        an exit lane and inflate every sum over a fact.
        """
        entry = self.table("toll").select(F.col("toll_id").alias("toll_a"), F.col("toll_name").alias("checkin_toll_name"))
        leave = self.table("toll").select(F.col("toll_id").alias("toll_b"), F.col("toll_name").alias("checkout_toll_name"))
        cycle = self.table("cycle").select("cycle_id", "cycle_name")
        return (
            self.table("stage").filter(F.col("status") == "true")
            .join(entry, "toll_a", "left")
            .join(leave, "toll_b", "left")
            .join(cycle, "cycle_id", "left")
            .select(
                "stage_id", "stage_code", "stage_name", "cycle_id", "cycle_name",
                F.col("toll_a").alias("checkin_toll_id"), "checkin_toll_name",
                F.col("toll_b").alias("checkout_toll_id"), "checkout_toll_name",
                "status", "boo",
            )
        )

    def stage_closed_lanes(self) -> DataFrame:
        """Active stages repeated per entry lane and exit lane (dimension listing only)."""
        lane = self.table("lane")
        entry = lane.select(
            F.col("toll_id").alias("checkin_toll_id"),
            F.col("toll_lane_id").alias("checkin_lane_id"), F.col("lane_name").alias("checkin_lane_name"),
        )
        leave = lane.select(
            F.col("toll_id").alias("checkout_toll_id"),
            F.col("toll_lane_id").alias("checkout_lane_id"), F.col("lane_name").alias("checkout_lane_name"),
        )
        return self.stage_closed().join(entry, "checkin_toll_id", "left").join(leave, "checkout_toll_id", "left")

    def cycle_lanes(self) -> DataFrame:
        """Routes with their plazas and lanes."""
        cycle = self.table("cycle").select("cycle_id", "cycle_code", "cycle_name")
        toll = self.table("toll").select("toll_id", "toll_name")
        lane = self.table("lane").select("toll_id", "lane_code", "lane_name")
        return (
            self.table("toll_cycle")
            .join(cycle, "cycle_id", "left").join(toll, "toll_id", "left").join(lane, "toll_id", "left")
            .select("cycle_id", "cycle_code", "cycle_name", "toll_id", "toll_name", "lane_code", "lane_name")
        )

    @held
    def stages(self) -> DataFrame:
        """``stage_closed`` as the small side of a join."""
        return self.small(self.stage_closed(), "stage")

    @held
    def stage_pairs(self) -> DataFrame:
        """Distinct entry/exit plaza pairs of the active stages with their operator and route."""
        toll = self.table("toll").select(F.col("toll_id").alias("checkout_toll_id"), "toll_type")
        pairs = (
            self.stage_closed().join(toll, "checkout_toll_id", "left")
            .select(
                F.col("checkin_toll_id").alias("fromtollid"), F.col("checkout_toll_id").alias("totollid"),
                "toll_type", "boo", "cycle_id", "cycle_name",
            ).distinct()
        )
        return self.small(pairs, "stage")

    @held
    def plaza_routes(self) -> DataFrame:
        """Plaza id with the name of its route."""
        cycle = self.table("cycle").select("cycle_id", "cycle_name")
        routes = self.table("toll_cycle").join(cycle, "cycle_id").select("toll_id", "cycle_id", "cycle_name")
        return self.small(routes, "toll_cycle")

    @held
    def priced_vehicles(self) -> DataFrame:
        """Price id with the label of its vehicle type; unknown types are left out."""
        known = self.domain("VEHICLE_TYPE").toDF("code", "vehicle_label")
        price = self.table("price").select(
            "price_id", F.col("vehicle_type").alias("code"),
            F.col("price_type").alias("list_price_type"), F.col("price_ticket_type").alias("list_price_ticket_type"),
        )
        return self.small(price.join(known, "code").drop("code"), "price")

    @held
    def tolls(self) -> DataFrame:
        """Plazas as the small side of a join."""
        return self.small(self.table("toll").select("toll_id", "toll_name", "toll_type"), "toll")


def reach_profile(star: Star, of: str, role: str, key: str = "transport_trans_id") -> DataFrame:
    """``pairs, days_before, days_after``: the least reach that holds for all rows of two facts that share a key; one row."""
    first = star.fact(of, columns=[key, "local_day"])
    second = star.fact(role, columns=[key, "local_day"]).withColumnRenamed("local_day", "partner_day")
    # Partners of a key are reduced to their first and last day before the facts meet.
    days = second.groupBy(key).agg(F.min("partner_day").alias("low"), F.max("partner_day").alias("high"), F.count("*").alias("n"))
    return first.join(days, key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.max(F.date_diff("local_day", "low")).alias("days_before"),
        F.max(F.date_diff("high", "local_day")).alias("days_after"),
    )


def _chosen(rows: DataFrame, columns: list[str] | None, span: Span | None) -> DataFrame:
    if columns is None:
        return rows
    return rows.select(*columns, *(["local_day"] if span is not None else []))
