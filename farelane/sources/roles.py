"""The star schema derived from the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions import labels
from farelane.functions.calendar import LOCAL_OFFSET_HOURS, Span, local_day_of
from farelane.functions.text import MONEY, money
from farelane.sources.star import DIMENSIONS, Star, held
from farelane.sources.testtables import read_table

# Code lists of the fixture star.
DOMAIN = [
    ("VEHICLE_TYPE", "1", "Class 1"),
    ("VEHICLE_TYPE", "2", "Class 2"),
    ("VEHICLE_TYPE", "3", "Class 3"),
    ("VEHICLE_TYPE", "4", "Class 4"),
    ("VEHICLE_TYPE", "5", "Class 5"),
    ("PRICE_TICKET_TYPE", "0", "Normal"),
    ("PRICE_TICKET_TYPE", "1", "Reduced"),
    ("PRICE_TICKET_TYPE", "2", "Priority"),
]
SUBSCRIPTION_SHIFT_DAYS = 9588
# The test table that bounds the rows of each dimension.
SOURCE_OF = {
    "stage": "supplier", "toll": "nation", "lane": "nation", "cycle": "region", "toll_cycle": "nation", "price": "part",
    "vehicle": "customer", "operator": "nation", "share": "nation", "account": "customer",
}
PARTITION_VALUES = {
    "year": "date_format(event_time, 'yyyy')", "month": "date_format(event_time, 'MM')", "day": "date_format(event_time, 'dd')",
    "hour": "date_format(event_time, 'HH')", "local_day": "local_day",
}


def with_partitions(df: DataFrame, instant: str) -> DataFrame:
    """Zero-padded ``year, month, day, hour`` of a UTC timestamp."""
    return df.withColumns(
        {name: F.date_format(instant, pattern)
         for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    )


def _by_state(failed: str, cancelled: str, otherwise: str) -> str:
    return f"CASE o_orderstatus WHEN 'F' THEN '{failed}' WHEN 'P' THEN '{cancelled}' ELSE '{otherwise}' END"


def _vehicle_type(part_key: Column) -> Column:
    return (F.floor(part_key / 25) % 5 + 1).cast("string")


class DerivedStar(Star):
    """Roles computed from the test tables; each fact filters its raw timestamp first,
    so a span reaches the Parquet scan as pushed filters."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, slack={"txn": 1, "detail": 1})  # lines and orders of one key lie years apart: no reach
        self._dir = sf_dir

    @held
    def raw(self, name: str) -> DataFrame:
        """One test table."""
        return read_table(self.spark, self._dir, name)

    @held
    def table(self, role: str) -> DataFrame:
        return getattr(self, f"_{role}")() if role in DIMENSIONS else self.fact(role)

    def fact(self, role: str, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        rows = getattr(self, f"_{role}")(span, columns)
        return rows if columns is None else rows.select(*columns, *(["local_day"] if span is not None else []))

    def _count(self, role: str) -> int:
        return self.raw(SOURCE_OF[role]).count()

    # facts ---------------------------------------------------------------

    @staticmethod
    def _timed(rows: DataFrame, instant: str, key: str, span: Span | None) -> DataFrame:
        """Event time = date plus ``key % 24`` hours, and its local day.

        The local day comes from whole hours, so a span costs no timestamp arithmetic;
        its bounds on the raw date go to the scan.
        """
        if span is not None:
            early = span.start_utc - timedelta(hours=23)
            rows = rows.filter(f"{instant} >= timestamp_ntz '{early}' AND {instant} < timestamp_ntz '{span.end_utc}'")
        hours = f"hour({instant}) + cast({key} % 24 as int)"
        rows = rows.withColumns({
            "local_day": F.expr(f"date_add(to_date({instant}), cast(floor(({hours} + {LOCAL_OFFSET_HOURS}) / 24) as int))"),
            "event_time": F.expr(f"{instant} + make_interval(0, 0, 0, 0, cast({key} % 24 as int))"),
        })
        return rows if span is None else rows.filter(f"local_day BETWEEN date '{span.first}' AND date '{span.last}'")

    @staticmethod
    def _selected(rows: DataFrame, values: dict[str, str], columns: list[str] | None) -> DataFrame:
        """The wanted columns of a role, each given as an expression, with the partition columns."""
        values = {**values, **PARTITION_VALUES}
        wanted = values if columns is None else {*columns, "local_day"}
        return rows.selectExpr(*[f"{value} AS {name}" for name, value in values.items() if name in wanted])

    def _lines(self, span: Span | None) -> DataFrame:
        return self._timed(self.raw("lineitem"), "l_shipdate", "l_orderkey", span)

    def _detail(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        rows = self._selected(self._lines(span), {
            "transport_trans_id": "l_orderkey", "stage_id": "l_suppkey", "price_id": "l_partkey",
            "price_type": "CASE WHEN l_returnflag = 'N' THEN 'L' WHEN l_returnflag = 'A' THEN 'T' WHEN l_linestatus = 'F' THEN 'Q' ELSE 'N' END",
            "price_ticket_type": "cast(l_linenumber % 3 as string)",
            "price_amount": f"cast(l_extendedprice as {MONEY})",
            "vehicle_type": "cast((l_partkey div 25) % 5 + 1 as string)",
            "checkin_datetime": "event_time",
        }, None if columns is None else [*columns, "transport_trans_id"])
        if columns is None or "vehicle_id" not in columns:
            return rows
        owner = self.raw("orders").selectExpr("o_orderkey AS transport_trans_id", "o_custkey AS vehicle_id")
        return rows.join(owner, "transport_trans_id")

    def _txn(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        """Transactions; plaza ids and plaza names are joined in only if they are asked for."""
        total, exit_id, entry_id = f"cast(o_totalprice as {MONEY})", "cast(c_nationkey as bigint)", "(cast(c_nationkey as bigint) + 1) % 25"
        values = {
            "transport_trans_id": "o_orderkey", "fe_trans_id": "concat('FE', o_orderkey)", "vehicle_id": "o_custkey",
            "account_id": "o_custkey", "vehicle_type": "cast(o_custkey % 5 + 1 as string)",
            "checkin_lane_name": "concat('Lane ', 2 - o_orderkey % 2)", "checkout_lane_name": "concat('Lane ', 1 + o_orderkey % 2)",
            "checkout_channel": "o_orderpriority",
            "charge_status": _by_state(labels.CHARGE_FAILED, labels.CHARGE_ROLLED_BACK, labels.CHARGE_SUCCESS[0]),
            "charge_in_status": _by_state(labels.FAILED, labels.CANCELLED, "Thành công"),
            "total_amount": total,
            "voucher_used_amount": f"cast(CASE WHEN o_orderkey % 10 = 0 THEN {total} * 0.01 ELSE 0 END as {MONEY})",
            "etag_number": "concat('E', o_custkey)", "plate": "concat('P', o_custkey)",
            "checkin_datetime": "event_time - interval 1 hour", "checkout_datetime": "event_time", "checkout_commit_datetime": "event_time",
        }
        placed = {
            "checkout_toll_id": exit_id, "checkin_toll_id": entry_id, "boo": exit_id,
            "checkin_lane_id": f"({entry_id}) * 2 + 2 - o_orderkey % 2", "checkout_lane_id": f"{exit_id} * 2 + 1 + o_orderkey % 2",
        }
        named = ("checkout_toll_name", "checkin_toll_name")
        wanted = {*placed, *named} if columns is None else {*columns}
        rows = self._timed(self.raw("orders"), "o_orderdate", "o_orderkey", span)
        if wanted & {*placed, *named}:
            customer = self.raw("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
            rows = rows.join(self.small(customer, "vehicle"), "o_custkey")
            values.update(placed)
        if wanted & {*named}:
            toll = self.tolls().select("toll_id", "toll_name")
            rows = (
                rows.withColumns({"_out": F.expr(exit_id), "_in": F.expr(entry_id)})
                .join(toll.toDF("_out", "checkout_toll_name"), "_out").join(toll.toDF("_in", "checkin_toll_name"), "_in")
            )
            values.update({name: name for name in named})
        return self._selected(rows, values, columns)

    def _subscription(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        shift = timedelta(days=SUBSCRIPTION_SHIFT_DAYS)
        rows = self.raw("events").filter("event_type = 'purchase'")
        if span is not None:
            rows = rows.filter(f"ts >= timestamp_ntz '{span.start_utc + shift}' AND ts < timestamp_ntz '{span.end_utc + shift}'")
        rows = rows.withColumn("event_time", F.expr(f"ts - interval {SUBSCRIPTION_SHIFT_DAYS} days"))
        rows = rows.withColumn("local_day", local_day_of(F.col("event_time")))
        return self._selected(rows, {
            "boo": "user_id % 25", "vehicle_type": "cast(user_id % 5 + 1 as string)",
            "price_type": f"element_at(array{tuple(labels.PRICE_TYPES)}, cast(event_id % 4 + 1 as int))",
            "price_amount": f"cast(value as {MONEY})", "toll_id": "user_id % 25", "toll_in_id": "(user_id + 1) % 25",
            "toll_out_id": "user_id % 25",
        }, columns)

    def _mediation(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("transport_trans_id")).agg(
            F.concat(F.lit("P"), F.max("l_orderkey").cast("string")).alias("plate"),
            money(F.sum(money(F.col("l_extendedprice")))).alias("price"),
        )

    def _violation(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        returned = self.raw("lineitem").filter(F.col("l_returnflag") == "R")
        return returned.groupBy(F.col("l_orderkey").alias("transport_trans_id")).agg(
            (F.max("l_linenumber") % 5 + 1).cast("string").alias("vehicle_type"),
            money(F.sum(money(F.col("l_extendedprice")))).alias("price_amount"),
        ).withColumn("status", F.lit(labels.TO_BE_COLLECTED))

    def _charged_lines(self, lines: DataFrame, columns: list[str] | None) -> DataFrame:
        return self._selected(lines, {
            "transporttransactionid": "l_orderkey", "fromtollid": "l_suppkey % 25", "totollid": "(l_suppkey + 1) % 25",
            "tickettype": "CASE l_returnflag WHEN 'N' THEN 'L' WHEN 'A' THEN 'T' ELSE 'Q' END",
            "prioritytype": "l_linenumber % 4", "paidamount": f"cast(l_extendedprice as {MONEY})", "checkoutdatetime": "event_time",
        }, None if columns is None else [*columns, "transporttransactionid"])

    def _before(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        return self._charged_lines(self._lines(span), columns)

    def _final(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        lines = self._charged_lines(self._lines(span).filter("l_linestatus = 'F'"), columns)
        if columns is not None and "vehicleid" not in columns:
            return lines
        return lines.join(self.raw("orders").selectExpr("o_orderkey AS transporttransactionid", "o_custkey AS vehicleid"), "transporttransactionid")

    def _charge(self, span: Span | None = None, columns: list[str] | None = None) -> DataFrame:
        return self.raw("orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("transporttransactionid"))

    # dimensions ----------------------------------------------------------

    def _stage(self) -> DataFrame:
        toll_a = F.col("s_nationkey").cast("bigint")
        cycle = self.small(self._toll_cycle().toDF("toll_a", "cycle_id"), "toll_cycle")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("stage_id"), F.concat(F.lit("ST"), F.col("s_suppkey").cast("string")).alias("stage_code"),
            F.col("s_name").alias("stage_name"), toll_a.alias("toll_a"), ((toll_a + 1) % 25).alias("toll_b"),
            F.when(F.col("s_suppkey") % 10 == 9, "false").otherwise("true").alias("status"), toll_a.alias("boo"),
        ).join(cycle, "toll_a")

    def _toll(self) -> DataFrame:
        region = self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.raw("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").cast("bigint").alias("toll_id"),
            F.concat("n_name", F.lit(" - "), "r_name").alias("toll_name"),
            F.when(F.col("n_nationkey") % 2 == 0, "OPEN").otherwise("CLOSED").alias("toll_type"),
            F.col("n_nationkey").cast("bigint").alias("boo"),
        )

    def _lane(self) -> DataFrame:
        toll = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(toll.alias("toll_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).select(
            (F.col("toll_id") * 2 + F.col("k")).alias("toll_lane_id"), "toll_id", F.col("k").cast("bigint").alias("lane_code"),
            F.concat(F.lit("Lane "), F.col("k").cast("string")).alias("lane_name"),
        )

    def _cycle(self) -> DataFrame:
        key = F.col("r_regionkey").cast("bigint")
        return self.raw("region").select(
            key.alias("cycle_id"), F.concat(F.lit("C"), key.cast("string")).alias("cycle_code"), F.col("r_name").alias("cycle_name")
        )

    def _toll_cycle(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("toll_id"), F.col("n_regionkey").cast("bigint").alias("cycle_id")
        )

    def _price(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("price_id"), (key % 25).alias("toll_id"), _vehicle_type(key).alias("vehicle_type"),
            F.element_at(F.array(*[F.lit(t) for t in labels.PRICE_TYPES]), (F.col("p_size") % 4 + 1)).alias("price_type"),
            (F.col("p_size") % 3).cast("string").alias("price_ticket_type"),
            money(F.col("p_retailprice")).alias("price_amount"),
        )

    def _vehicle(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("vehicle_id"), (F.col("c_custkey") % 5 + 1).cast("int").alias("vehicle_type_id"),
            F.col("c_mktsegment").alias("vehicle_group"),
        )

    def _domain(self) -> DataFrame:
        rows = ", ".join(str(row) for row in DOMAIN)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS domain(type, code, name)")

    def _operator(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("bigint").alias("boo_id"), F.col("n_name").alias("boo_name"))

    def _share(self) -> DataFrame:
        vehicle = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("vt")
        ticket = F.explode(F.array(*[F.lit(t) for t in labels.PRICE_TYPES])).alias("price_type")
        boo = F.col("n_nationkey").cast("bigint")
        odd = F.col("boo") % 2 == 1
        return (
            self.raw("nation").select(boo.alias("boo"), vehicle).select("boo", "vt", ticket)
            .select(
                F.col("vt").cast("string").alias("vehicle_type"), "price_type", "boo",
                F.when((F.col("vt") + F.col("boo")) % 3 == 0, "FIXED").otherwise("PERCENT").alias("distribution_type"),
                money(F.col("boo") % 20 + 1).alias("boo_split_value"),
                F.when(odd, F.lit("1998-01-01")).otherwise("1995-01-01").cast("date").alias("effective_date"),
                F.when(odd, F.lit("2001-12-31")).otherwise("1999-12-31").cast("date").alias("expiry_date"),
            )
        )

    def _account(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_number"))
