"""Whole-table migrations, mergeable distinct counts, and bounds on second facts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import Span
from farelane.operators import distinct, partitions
from farelane.operators.migration_graph import Code, CodeList, Graph, KeyMap, Link, Step, Through
from farelane.plans import charges, operators_compared, share, summary
from farelane.sources.roles import DerivedStar
from farelane.sources.star import DIMENSIONS, Reach, Star, reach_profile

RUN_AT = datetime(2024, 1, 1)
MONTH = Span.containing("month", "1997-10-15")


def given(spark):
    return {
        "old_person": spark.createDataFrame([(1, "A1"), (2, " A2"), (3, None), (4, "A4")], "pn_id long, file string"),
        "old_case": spark.createDataFrame([(10, 1, "x", "p;q"), (11, 2, None, "q,,z"), (12, 3, "y", None), (13, 9, "x", "p")], "case_id long, pn_id long, code string, many string"),
        "codes": spark.createDataFrame([(100, "x", 0), (101, "y", 1), (102, " p ", 0), (103, "q", 0)], "id long, code string, is_deleted int"),
    }


PERSONS = Step("person", "old_person", {"file": "trim(file)"}, prepared=lambda df: df.filter("file IS NOT NULL"), id_column="id",
               makes={"person_map": KeyMap("old_person", "person", "pn_id", "id", "file", "file", as_text=True)})
CASES = Step("case", "old_case", {"person_id": "person_id", "code_id": "code_id", "many_ids": "many_ids"}, through=[Through("person_map", "pn_id", "person_id")],
             codes=[Code("code", "codes", "code_id", live_only=True)], lists=[CodeList("many", "codes", "many_ids")])


def test_steps_run_in_the_order_of_what_they_need(spark, tmp_path):
    graph = Graph((CASES, PERSONS))
    assert [s.target for s in graph.order({"old_person", "old_case", "codes"})] == ["person", "case"]
    out = graph.run(spark, given(spark), str(tmp_path), RUN_AT)
    assert sorted((r.id, r.file) for r in out["person"].collect()) == [(1, "A1"), (2, "A2"), (3, "A4")]
    assert sorted(map(tuple, out["person_map"].collect())) == [(1, 1), (2, 2), (4, 3)]
    rows = sorted((r.person_id, r.code_id or 0, r.many_ids) for r in out["case"].collect())
    assert rows == [(1, 100, "[102,103]"), (2, 0, "[103]")]
    assert {r.creation_time for r in out["case"].collect()} == {RUN_AT}
    first = sorted(map(str, out["case"].collect()))
    again = graph.run(spark, given(spark), str(tmp_path), RUN_AT)
    assert sorted(map(str, again["case"].collect())) == first


def test_left_maps_keep_rows(spark, tmp_path):
    step = Step("case", "old_case", {"case_id": "case_id", "person_id": "person_id"}, through=[Through("person_map", "pn_id", "person_id", "left")], audit=False)
    out = Graph((PERSONS, step)).run(spark, given(spark), str(tmp_path), RUN_AT)
    assert sorted(tuple(r) for r in out["case"].fillna(0).collect()) == [(10, 1), (11, 2), (12, 0), (13, 0)]


def test_headers_and_links_null_safe(spark, tmp_path):
    rows = [("a", None, "x"), ("a", None, "y"), ("a", "b", "x"), (None, "b", "z")]
    source = {"old": spark.createDataFrame(rows, "giver string, rank string, person string")}
    headers = Step("header", "old", {"giver": "giver", "rank": "rank"}, distinct=True, id_column="id", audit=False)
    link = Step("link", "old", {"person": "person", "header_id": "header_id"}, links=[Link("header", {"giver": "giver"}, {"rank": "rank"}, "header_id")], audit=False)
    out = Graph((link, headers)).run(spark, source, str(tmp_path), RUN_AT)
    ids = {(r.giver, r["rank"]): r.id for r in out["header"].collect()}
    assert len(ids) == 3 and set(ids.values()) == {1, 2, 3}
    links = sorted(tuple(r) for r in out["link"].collect())
    assert links == sorted([("x", ids["a", None]), ("y", ids["a", None]), ("x", ids["a", "b"])])  # a NULL strict attribute links nothing


@pytest.mark.parametrize(
    ("steps", "message"),
    [
        ((Step("a", "b", {}), Step("b", "a", {})), "circle"),
        ((Step("a", "nowhere", {}),), "nobody makes: \\['nowhere'\\]"),
        ((PERSONS, PERSONS), "made twice"),
    ],
)
def test_bad_graphs_fail_before_any_step(steps, message):
    with pytest.raises(ValueError, match=message):
        Graph(steps).order({"old_person"})


def test_sets_count_exactly(spark):
    rows = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 10 != 0, F.pmod(F.hash("id"), F.lit(70_000)).cast("long") - 9).alias("k"), (F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("d"))
    sets = distinct.id_sets(rows, ["d", "g"], "k", {"total": F.col("x")})
    for keys in (["d", "g"], ["g"], ["d"]):
        got = distinct.counted(distinct.merged_sets(sets, keys, ["total"]), keys, "n", ["total"])
        want = rows.groupBy(*keys).agg(F.count_distinct("k").alias("n"), F.sum("x").alias("total"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    none = distinct.counted(distinct.id_sets(rows.filter("k IS NULL"), ["g"], "k"), ["g"], "n")
    assert {r.n for r in none.collect()} == {0}


def test_sets_of_scattered_ids_stay_as_small_as_their_rows(spark, tmp_path):
    path = str(tmp_path / "scattered")
    rows = spark.range(2_000).select((F.col("id") % 300).alias("g"), (F.col("id") * 1_000_003).alias("k"), F.lit(1).alias("x"))
    sets = distinct.id_sets(rows, ["g"], "k", {"total": F.col("x")})
    sets.coalesce(1).write.option("compression", "none").parquet(path)
    assert sum(size for size, _ in partitions.Folder(spark, path).files().values()) < 100 * 2_000
    assert sets.groupBy("g", distinct.MEMBER).count().filter("count > 1").isEmpty()


def test_one_day_is_renewed_alone(spark, tmp_path):
    path, span = str(tmp_path / "sets"), Span.backfill("day", "1997-01-01", "1997-01-10")
    rows = spark.range(100).select(F.date_add(F.lit(date(1997, 1, 1)), (F.col("id") % 10).cast("int")).alias("local_day"), F.lit("r").alias("route"), "id", F.lit(1).alias("x"))
    distinct.refresh_days(rows, path, ["route"], "id", {"total": F.col("x")}, span)
    before = partitions.Folder(spark, path).files()
    day = Span.containing("day", "1997-01-04")
    distinct.refresh_days(rows.filter("local_day = '1997-01-04' AND id < 50"), path, ["route"], "id", {"total": F.col("x")}, day)
    after = partitions.Folder(spark, path).files()
    assert {k: v for k, v in after.items() if "01-04" not in k} == {k: v for k, v in before.items() if "01-04" not in k}
    merged = distinct.merged_sets(distinct.by_period_of(partitions.read_partitioned(spark, path), Span.containing("month", "1997-01-04")), ["period"], ["total"])
    assert [(r.n, r.total) for r in distinct.counted(merged, ["period"], "n", ["total"]).collect()] == [(95, 95)]
    distinct.refresh_days(rows.filter("false"), path, ["route"], "id", {"total": F.col("x")}, day)
    assert not any("01-04" in k for k in partitions.Folder(spark, path).files())


@pytest.fixture(scope="module")
def aligned(spark, tmp_path_factory):
    """Facts partitioned by day in which each detail comes up to 20 days after its transaction, and the plain star over them."""
    source = DerivedStar(spark, "/root/testdata/sf0.001")
    spark.sql("CREATE DATABASE aligned")
    for role in DIMENSIONS:
        source.table(role).write.saveAsTable(f"aligned.{role}")
    around = Span.backfill("day", "1997-09-01", "1997-12-01")
    txn = source.fact("txn").withColumn("moved", F.date_add(F.lit(date(1997, 9, 5)), (F.col("transport_trans_id") % 70).cast("int")))
    days = {c: F.date_format("moved", p) for c, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}
    txn.withColumns({**days, "hour": F.lit("03")}).drop("moved", "local_day").coalesce(1).write.partitionBy("year", "month", "day").saveAsTable("aligned.txn")
    columns = [c for c in source.fact("detail").columns if c not in ("local_day", "year", "month", "day", "hour")]
    detail = source.fact("detail", None, [*columns, "vehicle_id"]).withColumn("moved", F.date_add(F.lit(date(1997, 9, 5)), (F.col("transport_trans_id") % 70 + F.col("stage_id") % 21).cast("int")))
    detail.withColumns({**days, "hour": F.lit("03")}).drop("moved").coalesce(1).write.partitionBy("year", "month", "day").saveAsTable("aligned.detail")
    source.fact("subscription", around).drop("local_day").write.saveAsTable("aligned.subscription")
    yield Star(spark, "aligned"), Star(spark, "aligned", reach={("detail", "txn"): Reach(20, 0)}), Star(spark, "aligned", by_key=frozenset({"txn"}))
    spark.sql("DROP DATABASE aligned CASCADE")


SECOND_FACT = [
    share.plaza_route_share, operators_compared.operator_pair_comparison, share.plaza_route_share_split,
    lambda s, span: charges.failed_charges(s, span, True, "price_type"), summary.transaction_summary_by_lane,
]


def scans(df):
    """The partition filters of each fact scan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.split("\n") if "FileScan" in line and ("aligned.txn" in line or "aligned.detail" in line)]


@pytest.mark.parametrize("n", range(len(SECOND_FACT)))
def test_declared_reach_prunes_both_facts(aligned, n):
    plain, bounded, keyed = aligned
    want = sorted(map(str, SECOND_FACT[n](plain, MONTH).collect()))
    assert want and sorted(map(str, SECOND_FACT[n](bounded, MONTH).collect())) == want
    assert sorted(map(str, SECOND_FACT[n](keyed, MONTH).collect())) == want
    both, whole = scans(SECOND_FACT[n](bounded, MONTH)), scans(SECOND_FACT[n](plain, MONTH))
    assert len(both) >= 2 and all("year" in f and "day" in f for f in both)
    assert any("year" not in f for f in whole)


def test_keyed_second_fact_reads_a_range_of_keys(aligned):
    plan = share.plaza_route_share(aligned[2], MONTH)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan


def test_profile_gives_the_least_reach(aligned):
    row = reach_profile(aligned[0], "detail", "txn").first()
    most = aligned[0].fact("detail").agg(F.max(F.col("stage_id") % 21)).first()[0]
    assert (row.days_before, row.days_after) == (most, 0) and row.pairs == aligned[0].fact("detail").count()
    back = reach_profile(aligned[0], "txn", "detail").first()
    assert (back.days_before, back.days_after, back.pairs) == (0, most, row.pairs)
