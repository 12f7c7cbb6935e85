"""Operators against brute force on small and skewed fixtures."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farelane.functions import text
from farelane.operators import load, lookups, migrate, numbering, runlog
from farelane.session import scratch_path
from farelane.sources import dimensions


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# text ---------------------------------------------------------------------


def test_texts(spark):
    rows = spark.createDataFrame(
        [("North - East", "31/02/2020"), ("plain", "99/99/2020"), ("a-b - c", "2020-01-05"), (None, "05/03/2020"), ("x -", "5/3/2020")],
        "name string, d string",
    )
    out = rows.select(text.route_of(F.col("name")).alias("r"), text.normalize_date_text(F.col("d")).alias("d"))
    assert values(out, "r", "d") == [("East", None), (None, None), ("b", "2020-01-05"), (None, "2020-03-05"), ("", None)]


def test_numbers_and_lists(spark):
    rows = spark.createDataFrame([("1x", None), (" 7.5 ", 4), (None, 1), ("", 2)], "t string, i int")
    out = rows.select(text.lenient_number(F.col("t")).cast("string").alias("n"), text.wrap_id(F.col("i")).alias("w"))
    assert values(out, "n", "w") == [(None, "[]"), ("7.5000", "[4]"), (None, "[1]"), (None, "[2]")]


def test_null_parts_keep_their_separators(spark):
    rows = spark.createDataFrame([("a", None, "c"), (None, None, None)], "a string, b string, c string")
    out = rows.select(text.compose_text(", ", F.col("a"), F.col("b"), F.col("c")).alias("x"), text.compose_text("", F.col("a"), F.col("b")).alias("y"))
    assert values(out, "x", "y") == [("a, , c", "a"), (", , ", None)]


def test_letters_include_accents(spark):
    rows = spark.createDataFrame([("012", None), ("Đ12", None), (None, "9"), (None, None)], "a string, b string")
    digits, letters = text.split_by_content(F.col("a"), F.col("b"))
    assert values(rows.select(digits.alias("d"), letters.alias("l")), "d", "l") == [("012", None), (None, "Đ12"), ("9", None), (None, None)]


# lookups ------------------------------------------------------------------


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([(30, "a", 0), (10, "b", 0), (20, "c", 1)], "id long, code string, is_deleted int")


LISTS = ["b;a;zz", "a;;b", "", None, "a;a;b", "zz", " b , a ", ";"]


def test_code_lists(spark, dictionary):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(LISTS)] * 3, "k int, codes string")
    placed = lookups.resolve_code_list(rows, "codes", dictionary, "ids", ",;", by_position=True)
    assert sorted(values(placed, "k", "ids")) == sorted(
        [(0, "[10,30]"), (1, "[30,10]"), (2, "[]"), (3, "[]"), (4, "[30,30,10]"), (5, "[]"), (6, "[10,30]"), (7, "[]")] * 3
    )
    distinct = lookups.resolve_code_list(rows, "codes", dictionary, "ids", ";", by_position=False)
    assert set(values(distinct, "k", "ids")) == {
        (0, "[10,30]"), (1, "[10,30]"), (2, None), (3, None), (4, "[10,30]"), (5, None), (6, None), (7, None)
    }


def test_explode_keeps_rows_without_codes(spark):
    rows = spark.createDataFrame([(1, "a;;b"), (2, ""), (3, None)], "k int, codes string")
    assert sorted(values(lookups.explode_codes(rows, "codes", "c"), "k", "c"), key=str) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_few_codes_of_a_derived_dictionary_do_not_gather_rows(spark):
    rows = spark.range(1_000).select("id", (F.col("id") % 4).alias("code"))
    derived = spark.range(5_000_000).select((F.col("id") % 3).alias("code")).distinct().select("code", (F.col("code") + 10).alias("value"))
    out = lookups.resolve(rows, [lookups.Lookup("code", derived, "got", value="value")])
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.code, r.got): r["count"] for r in out.groupBy("code", "got").count().collect()} == {(0, 10): 250, (1, 11): 250, (2, 12): 250, (3, None): 250}



def test_live_rows_and_text_keys(spark, dictionary):
    rows = spark.createDataFrame([("a",), ("c",), (" b ",), (None,)], "code string")
    out = lookups.resolve(rows.withColumnRenamed("code", "k"), [
        lookups.Lookup("k", dictionary, "any_id"), lookups.Lookup("k", dictionary, "live_id", live_only=True),
        lookups.Lookup("k", dictionary, "trimmed_id", as_text=True),
    ])
    assert sorted(values(out, "k", "any_id", "live_id", "trimmed_id"), key=str) == sorted(
        [("a", 30, 30, 30), ("c", 20, None, 20), (" b ", None, None, 10), (None, None, None, None)], key=str
    )


def test_headers_match_null_safe_but_strict_keys_do_not(spark):
    rows = spark.createDataFrame([(1, "g", None), (2, "g", "x"), (3, None, "x"), (4, "g", None)], "r int, giver string, post string")
    headers = rows.groupBy("giver", "post").agg(F.min("r").alias("id"))
    linked = migrate.link_to_headers(rows, headers, ["giver"], ["post"], "h")
    assert sorted(values(linked, "r", "h")) == [(1, 1), (2, 2), (4, 1)]


# numbering ----------------------------------------------------------------


def skewed(spark, n=6000):
    """One key holds a third of the rows; many ties."""
    rng = random.Random(7)
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(200), rng.randrange(20), rng.choice(["error", "success"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, stmt_id long, run_at long, status string").repartition(16)


def test_latest_runs_brute_force(spark):
    rows, df = skewed(spark)
    latest, good = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        latest[r[1]] = r
        if r[3] == "success":
            good[r[1]] = r
    failed = [r for r in latest.values() if r[3] == "error"]
    got = [tuple(r) for r in runlog.latest_runs(df, "error", judged_after=True).collect()]
    assert got == sorted(failed, key=lambda r: (r[2], r[0]), reverse=True)
    assert {tuple(r) for r in runlog.latest_runs(df, "success", judged_after=False).collect()} == set(good.values())


@pytest.mark.parametrize("merge_small", ["true", "false"])
def test_numbers_are_gapless_in_order(spark, merge_small):
    rows, df = skewed(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge_small)
    try:
        got = numbering.numbered(df, [F.col("stmt_id"), F.col("id").desc()], "n", 11)
        want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], -r[0])), start=11)}
        assert dict(values(got, "id", "n")) == want
        assert (got.rdd.getNumPartitions() > 1) == (merge_small == "false")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_continue_from_the_greatest(spark):
    _, df = skewed(spark, 500)
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    assert sorted(values(numbering.continue_ids(new, df, [F.col("name")]), "name", "id")) == [("a", 500), ("b", 501)]
    assert values(numbering.continue_ids(new.limit(1), df.filter("id < 0"), [F.col("name")]), "id") == [(1,)]


def test_pages(spark):
    rows = [(i, "Mart_A" if i % 2 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, table_name string")
    page = runlog.search_page(df, " mart ", page=3, page_size=70).orderBy(F.col("id").desc())
    assert values(page, "id", "total", "total_pages") == [(i, 500, 8) for i in range(999 - 280, 999 - 420, -2)]
    assert runlog.search_page(df, "none such").count() == 0
    assert runlog.search_page(df, "", page=0, page_size=999).count() == 200


# load ---------------------------------------------------------------------


def test_csv_round_trip(spark):
    rows = spark.createDataFrame([(1, 'a,"b"', None), (2, "", date(2024, 2, 29)), (3, "Đợt\n2", None)], "k int, t string, d date")
    path = scratch_path(spark, "csv")
    load.write_csv(rows, path, "|")
    back = load.read_csv(spark, path, rows.schema, "|")
    assert sorted(values(back, "k", "t", "d")) == [(1, 'a,"b"', None), (2, None, date(2024, 2, 29)), (3, "Đợt\n2", None)]
    plain = scratch_path(spark, "csv")
    load.write_csv(rows.filter("k < 3"), plain)
    load.write_csv(rows.filter("k = 2"), plain)
    assert values(load.read_csv(spark, plain, rows.schema), "k", "t") == [(2, None)]


def test_named_parts_whatever_the_size(spark):
    rows = spark.range(100).repartition(4)
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    assert load.write_named_csv(rows, one, "data.csv", single_file=True) == ["data.csv"]
    assert load.write_named_csv(rows, many, "data.csv") == [f"data-0000{i}.csv" for i in range(4)]
    assert load.read_csv(spark, f"{one}/data.csv", "id long").count() == load.read_csv(spark, many, "id long").count() == 100


def test_mart_replaces_touched_days_and_repeats(spark):
    path = scratch_path(spark, "mart")
    first = spark.createDataFrame([(1, 2024, 1, 5), (2, 2024, 1, 6)], "v int, year int, month int, day int")
    load.write_mart(first, path)
    again = spark.createDataFrame([(9, 2024, 1, 6)], first.schema)
    for _ in range(2):
        load.write_mart(again, path)
    assert sorted(values(load.read_mart(spark, path), "v", "year", "month", "day")) == [(1, "2024", "01", "05"), (9, "2024", "01", "06")]
    with pytest.raises(ValueError):
        load.write_mart(first.drop("day"), path)
    assert load.missing_partitions(first.withColumnRenamed("day", "DAY")) == []


@pytest.mark.parametrize(
    "condition, key, kept",
    [("day", "2024051000", 1), ("day", "2024-05-10", 1), ("month", "2024-05", 1), ("quarter", "2024-Q2", 1), ("month", "202405", 1), ("year", "2024", 1), ("quarter", "2024Q2", 1), ("time", "2024051013", 1), ("none", "x", 2)],
)
def test_period_replace(spark, condition, key, kept):
    target = spark.createDataFrame([(key, 1), (None, 2)], "p string, v int")
    out = load.replace_period(target, target.limit(0), "p", condition, "2024-05-10")
    assert out.count() == kept
    with pytest.raises(ValueError):
        load.replace_period(target, target, "p", "decade", "2024-05-10")


def test_retention_drops_old_partitions(spark):
    rows = spark.createDataFrame([(1, "2024", "01", "05"), (2, "2024", "01", "07"), (3, "2024", "02", "01")], "v int, year string, month string, day string")
    rows.write.partitionBy("year", "month", "day").saveAsTable("mart_kept")
    assert load.drop_expired(spark, "mart_kept", "2024-01-10", 3) == 2
    assert values(spark.table("mart_kept"), "v") == [(3,)]
    assert load.drop_expired(spark, "mart_kept", "2024-01-10", 3) == 0


def test_refresh_counts(spark):
    path = scratch_path(spark, "refresh")
    assert load.full_refresh(spark.range(7), path) == {"deleted": 0, "inserted": 7}
    assert load.full_refresh(spark.range(3), path) == {"deleted": 7, "inserted": 3}
    assert spark.read.parquet(path).count() == 3


def test_refresh_may_read_its_own_target(spark):
    path = scratch_path(spark, "refresh")
    load.full_refresh(spark.range(10), path)
    assert load.full_refresh(spark.read.parquet(path).filter("id > 3"), path) == {"deleted": 10, "inserted": 6}
    assert sorted(values(spark.read.parquet(path), "id")) == [(i,) for i in range(4, 10)]


def test_failed_refresh_leaves_the_target(spark):
    path = scratch_path(spark, "refresh")
    load.full_refresh(spark.range(5), path)
    with pytest.raises(Exception, match="broken row"):
        load.full_refresh(spark.range(5).withColumn("id", F.raise_error(F.lit("broken row")).cast("long")), path)
    assert spark.read.parquet(path).count() == 5


def test_mart_table(spark):
    first = spark.createDataFrame([(1, 2024, 1, 5), (2, 2024, 1, 6)], "v int, year int, month int, day int")
    load.write_mart_table(first, "mart_days")
    load.write_mart_table(first.filter("day = 6").withColumn("v", F.lit(9)), "mart_days")
    assert sorted(values(spark.table("mart_days"), "v", "day")) == [(1, "05"), (9, "06")]


def test_children_are_cleared_first(spark):
    edges = spark.createDataFrame([("line", "order"), ("order", "person"), ("line", "person"), ("note", "person")], "child string, parent string")
    assert dict(values(load.clear_order(spark, edges), "table_name", "step")) == {"line": 1, "note": 1, "order": 2, "person": 3}
    ladder = [(f"t{i}", f"t{j}") for i in range(24) for j in (i + 1, i + 2)]  # millions of chains
    steps = load.clear_order(spark, spark.createDataFrame(ladder, "child string, parent string"))
    assert dict(values(steps, "table_name", "step"))["t25"] == 25
    with pytest.raises(ValueError):
        load.clear_order(spark, spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string"))


# registry and dimensions --------------------------------------------------


def test_validation(spark):
    rows = spark.createDataFrame(
        [("1", "s", "t", "p", " yes "), ("9", "", " ", None, None), ("2", "s", "t", "p", "off")],
        "job_type string, schema_name string, table_name string, sql_path string, is_active string",
    ).withColumn("description", F.lit(None).cast("string"))
    checked = runlog.validate_jobs(rows)
    assert values(checked, "valid", "is_active") == [(True, True), (False, None), (True, False)]
    assert values(runlog.validation_summary(checked), "total", "valid", "invalid") == [(3, 2, 1)]
    with pytest.raises(ValueError):
        runlog.validate_jobs(rows.drop("table_name"))


def test_log_texts_are_cut(spark):
    path = scratch_path(spark, "log")
    runlog.append_log(runlog.log_entry(spark, datetime(2024, 1, 1), job_name="j", message="m" * 9000, error_level="odd"), path)
    runlog.append_log(runlog.log_entry(spark, datetime(2024, 1, 2), job_name="k"), path)
    got = spark.read.parquet(path).orderBy("created_at").select(F.length("message").alias("n"), "error_level")
    assert values(got, "n", "error_level") == [(8000, "ERROR"), (None, "INFO")]


def test_dimension_cache(spark):
    spark.range(3).createOrReplaceTempView("src_dim")
    held = dimensions.cache_dimensions(spark, dimensions.parse_config("# c\nno_table|x\n\nsrc_dim|dim_three\n"))
    assert list(held) == ["dim_three"] and held["dim_three"].is_cached
    dimensions.release_dimensions(spark, held)
    assert not held["dim_three"].is_cached and not spark.catalog.tableExists("dim_three")
