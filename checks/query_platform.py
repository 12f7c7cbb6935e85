"""Calendar, dimension, load, migration and run-log queries on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.query_reports import star, whole
from farelane.functions import calendar, text
from farelane.operators import clearing, load, lookups, migrate, numbering, partitions, publishing, runlog
from farelane.plans import revenue, statistics, summary
from farelane.plans.runner import Job, run_batch
from farelane.session import scratch_path
from farelane.sources import dimensions
from farelane.sources.testtables import read_table

Query = Callable[[SparkSession, str], DataFrame]
RUN_AT = datetime(2024, 6, 1, 12, 0, 0)


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# calendar and dimensions -------------------------------------------------


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct local dates of the transactions."""
    return star(spark, sf_dir).fact("txn").select(F.col("local_day").alias("d")).distinct()


def period_attributes(spark, sf_dir):
    return calendar.period_attributes(local_days(spark, sf_dir), "d")


def utc_ranges(level: str) -> Query:
    return lambda spark, sf_dir: calendar.utc_ranges(local_days(spark, sf_dir), "d", level)


def partition_hour_filter(spark, sf_dir):
    """Detail rows per partition hour of a local quarter, selected on the partition columns."""
    span = calendar.Span.containing("quarter", "1997-10-15")
    rows = star(spark, sf_dir).fact("detail").filter(span.partition_filter())
    return rows.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("n"), F.sum("price_amount").cast("decimal(28,2)").alias("amount")
    )


def level_dispatch(spark, sf_dir):
    """Jobs per declared type and the level each type means."""
    jobs = registry(spark, sf_dir)
    return jobs.groupBy("job_type", calendar.level_column(F.col("job_type")).alias("time_level")).agg(F.count("*").alias("jobs"))


def period_labels(spark, sf_dir):
    """Every label form of each local day."""
    days = local_days(spark, sf_dir)
    found = {}
    for level in calendar.LEVELS:
        found.update(calendar.label_columns(level, F.col("d")))
    return days.select(*[column.alias(name) for name, column in found.items()])


def dim_date(spark, sf_dir):
    bounds = local_days(spark, sf_dir).agg(F.min("d").alias("a"), F.max("d").alias("b"))
    return calendar.calendar_dimension(bounds, "a", "b")


def scan_fact_detail(spark, sf_dir):
    columns = ["transport_trans_id", "stage_id", "price_id", "price_type", "price_amount", "year", "month", "day", "hour"]
    return star(spark, sf_dir).fact("detail", whole("month"), columns).drop("local_day")


def dim_load_cached(spark, sf_dir):
    """Row counts of the cached dimensions; a table that does not exist is skipped."""
    held = star(spark, sf_dir)
    held.table("toll").createOrReplaceTempView("src_toll")
    held.table("vehicle").createOrReplaceTempView("src_vehicle")
    config = dimensions.parse_config("# table|view\nsrc_toll|dim_toll\nno_such_table|dim_none\n\nsrc_vehicle|dim_vehicle\n")
    cached = dimensions.cache_dimensions(spark, config)
    counts = [spark.table(v).agg(F.lit(v).alias("view_name"), F.count("*").alias("n")) for v in cached]
    return counts[0].unionAll(counts[1])


def copy_columns(spark, sf_dir):
    return dimensions.copy_columns(
        _raw(spark, sf_dir, "customer"), {"c_custkey": "id", "c_name": "full_name", "c_mktsegment": "segment"}, "c_acctbal > 0"
    )


def mart_feed_projection(spark, sf_dir):
    """Transaction columns with literal partition columns."""
    day = calendar.parse_day("1997-10-15")
    return star(spark, sf_dir).fact("txn").select(
        "transport_trans_id", "etag_number", "vehicle_id", "checkin_toll_id", "checkin_lane_id",
        F.lit(day.year).alias("year"), F.lit(day.month).alias("month"), F.lit(day.day).alias("day"),
    )


def detail_base_join(spark, sf_dir):
    held = star(spark, sf_dir)
    detail = held.fact("detail").select("transport_trans_id", "stage_id", "price_id", "price_type", "price_ticket_type", "price_amount")
    txn = held.fact("txn").select("transport_trans_id", "vehicle_id", "checkout_channel", "charge_status", "total_amount")
    stage = held.stage_closed().select("stage_id", "stage_name", "cycle_name", "checkin_toll_name", "checkout_toll_name")
    return detail.join(txn, "transport_trans_id").join(stage, "stage_id")


# registry and history ----------------------------------------------------


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job registry: one row per part; types 0 to 6, so that some are unknown."""
    key = F.col("p_partkey")
    return _raw(spark, sf_dir, "part").select(
        key.alias("id"), (key % 7).cast("string").alias("job_type"), F.col("p_brand").alias("schema_name"),
        F.concat(F.lower("p_type"), F.lit("_"), key.cast("string")).alias("table_name"),
        F.concat(F.lit("sql/"), F.col("p_name")).alias("sql_path"), (key % 3 != 0).alias("is_active"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history: one run per event, the job being the user; minutes give tied run times."""
    return _raw(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("stmt_id"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("run_at"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.floor("value").cast("bigint").alias("insert_rows"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: one row per event, some without a table name."""
    return _raw(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("Job_"), F.col("event_type")).alias("job_name"),
        F.when(F.col("event_id") % 9 != 0, F.concat(F.lit("Mart_"), F.initcap("event_type"), F.lit("_"), (F.col("user_id") % 10).cast("string"))).alias("table_name"),
        F.col("ts").alias("created_at"),
    )


def imported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an imported registry file with every kind of fault."""
    key = F.col("o_orderkey")
    flags = F.array(*[F.lit(x) for x in ("TRUE", " yes ", "0", "no", "Y")])
    return _raw(spark, sf_dir, "orders").select(
        key.alias("row_number"), (key % 8).cast("string").alias("job_type"),
        F.when(key % 11 != 0, F.concat(F.lit(" "), F.col("o_orderpriority"))).alias("schema_name"),
        F.when(key % 13 == 0, "  ").otherwise(F.concat(F.lit("t"), F.col("o_custkey").cast("string"))).alias("table_name"),
        F.when(key % 17 != 0, F.concat(F.lit("sql/"), F.col("o_orderstatus"))).alias("sql_path"),
        F.lit(None).cast("string").alias("description"),
        F.when(key % 19 != 0, F.element_at(flags, (key % 5 + 1).cast("int"))).alias("is_active"),
    )


def assign_ids(spark, sf_dir):
    valid = runlog.validate_jobs(imported(spark, sf_dir)).filter("valid").select("row_number", "job_type", "schema_name", "table_name")
    return numbering.continue_ids(valid, registry(spark, sf_dir), [F.col("row_number")])


def bulk_delete_ids(spark, sf_dir):
    doomed = _raw(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 40").select(F.col("l_partkey").alias("id"))
    return numbering.without_ids(registry(spark, sf_dir), doomed).select("id", "job_type", "table_name")


def dedupe_pairs(spark, sf_dir):
    """First line per (part, supplier) pair in order of a unique position."""
    lines = _raw(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.count("*").alias("copies"))
    position = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    pairs = lines.select(
        F.col("l_partkey").alias("target"), F.col("l_suppkey").alias("source"), "l_orderkey", "l_linenumber", "copies", position.alias("position")
    )
    return runlog.first_of_pairs(pairs).drop("position")


def job_preview(spark, sf_dir):
    """Previews of the document texts."""
    jobs = _raw(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return runlog.previewed(jobs, "text").select("id", "preview")


def run_log_append(spark, sf_dir):
    """Two appends of the run log, read back."""
    path = scratch_path(spark, "run-log")
    rows = run_log(spark, sf_dir).select(
        "job_name", F.lit("1").alias("job_type"), "table_name", F.lit("RUN").alias("operation_type"),
        F.when(F.col("id") % 3 == 0, "ERROR").when(F.col("id") % 3 == 1, "INFO").otherwise("NOTE").alias("error_level"),
        F.repeat(F.col("job_name"), (F.col("id") % 1500).cast("int")).alias("message"), F.lit(None).cast("string").alias("error_traceback"),
        F.col("id").alias("rows_inserted"), F.lit(0).cast("bigint").alias("execution_time_ms"), "created_at",
    )
    runlog.append_log(rows.filter("rows_inserted % 2 = 0"), path)
    runlog.append_log(rows.filter("rows_inserted % 2 = 1"), path)
    return spark.read.parquet(path).select(
        F.col("rows_inserted").alias("id"), "job_name", "error_level", F.length("message").alias("message_length")
    )


# load --------------------------------------------------------------------


def _lane_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.transaction_revenue(star(spark, sf_dir), whole("day"), "lane")


def csv_roundtrip(spark, sf_dir):
    result, path = _lane_day(spark, sf_dir), scratch_path(spark, "lane-csv")
    load.write_csv(result, path)
    return load.read_csv(spark, path, result.schema)


def csv_single_part(spark, sf_dir):
    """A result as named, numbered parts, read back."""
    held, path = star(spark, sf_dir), scratch_path(spark, "channel-csv")
    result = statistics.payment_channel(held, whole("month"))
    files = load.write_named_csv(result, path, "data.csv")
    return load.read_csv(spark, [f"{path}/{name}" for name in files] or path, result.schema)


def _mart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = star(spark, sf_dir).fact("txn")
    return txn.groupBy("checkout_toll_id", "local_day").agg(
        F.count("*").alias("n"), F.sum("total_amount").cast("decimal(28,2)").alias("amount")
    ).select(
        "checkout_toll_id", "n", "amount", F.year("local_day").alias("year"),
        F.month("local_day").alias("month"), F.dayofmonth("local_day").alias("day"),
    )


def normalize_partitions(spark, sf_dir):
    return load.normalize_partitions(_mart_rows(spark, sf_dir))


def mart_overwrite(spark, sf_dir):
    """All days written, then the days of 1997 written again with other counts."""
    path, rows = scratch_path(spark, "mart"), _mart_rows(spark, sf_dir)
    load.write_mart(rows, path)
    load.write_mart(rows.filter("year = 1997").withColumn("n", F.col("n") + 1000), path)
    return load.read_mart(spark, path)


def mart_guard(spark, sf_dir):
    """Which results may go to the mart."""
    held = star(spark, sf_dir)
    found = {"mart_rows": _mart_rows(spark, sf_dir), "payment_channel": statistics.payment_channel(held, whole("day"))}
    frames = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("result"), F.lit(not load.missing_partitions(df)).alias("to_mart"), "n")
        for name, df in found.items()
    ]
    return frames[0].unionAll(frames[1])


# Query suffix: level, label column, condition and the label of 1997-06-30.
REPLACED = {
    "": ("year", "year_id", "year", "1997"), "_quarter": ("quarter", "quarter_id", "quarter", "1997-Q2"),
    "_month": ("month", "month_id", "month", "1997-06"), "_day_date": ("day", "date", "day", "1997-06-30"),
    "_day_datetime": ("day", "datetime_id", "day", "1997063000"), "_time": ("day", "datetime_id", "time", "1997063000"),
}


def replace_period(level, column, condition, own):
    """Route revenue with the rows of one period replaced by the channel rows alone, their counts set to 0."""

    def query(spark, sf_dir):
        target = revenue.transaction_revenue(star(spark, sf_dir), whole(level), "route").select(
            column, "route", "vehicle_transaction_type", "revenue_group", "transaction_count", "gross_revenue"
        )
        new = target.filter((F.col(column) == own) & (F.col("vehicle_transaction_type") == "ETC"))
        new = new.withColumn("transaction_count", F.lit(0).cast("bigint"))
        return load.replace_period(target, new, column, condition, "1997-06-30")

    return query


def retention_expired(spark, sf_dir):
    return load.expired_partitions(load.normalize_partitions(_mart_rows(spark, sf_dir)), "1999-03-02", 30)


def full_refresh_counts(spark, sf_dir):
    """A refresh over an older copy: rows removed and rows written."""
    path, orders = scratch_path(spark, "refresh"), _raw(spark, sf_dir, "orders")
    load.full_refresh(orders.filter("o_orderstatus <> 'P'"), path)
    counts = load.full_refresh(orders, path)
    left = spark.read.parquet(path).agg(F.count("*").alias("rows_after"))
    return left.select(
        F.lit(counts["deleted"]).cast("bigint").alias("deleted"), F.lit(counts["inserted"]).cast("bigint").alias("inserted"), "rows_after"
    )


def source_target_counts(spark, sf_dir):
    source = _raw(spark, sf_dir, "lineitem")
    target = source.join(_raw(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    return load.source_target_counts(source, target, "lineitem")


def clear_order(spark, sf_dir):
    """Clearing steps of the tables whose rows really reference another table."""
    keys = [
        ("lineitem", "orders", "l_orderkey", "o_orderkey"), ("lineitem", "part", "l_partkey", "p_partkey"),
        ("lineitem", "supplier", "l_suppkey", "s_suppkey"), ("orders", "customer", "o_custkey", "c_custkey"),
        ("customer", "nation", "c_nationkey", "n_nationkey"), ("supplier", "nation", "s_nationkey", "n_nationkey"),
        ("nation", "region", "n_regionkey", "r_regionkey"),
    ]
    found = None
    for child, parent, fk, pk in keys:
        hit = (
            _raw(spark, sf_dir, child).select(F.col(fk).alias("k"))
            .join(_raw(spark, sf_dir, parent).select(F.col(pk).alias("k")), "k", "left_semi")
            .agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(child).alias("child"), F.lit(parent).alias("parent"))
        )
        found = hit if found is None else found.unionAll(hit)
    path = scratch_path(spark, "references")
    found.write.parquet(path)
    return load.clear_order(spark, spark.read.parquet(path))


def replace_partitioned(spark, sf_dir):
    """A target partitioned by month, with the rows of one month replaced by its channel rows alone."""
    level, column, condition, own = REPLACED["_month"]
    target = revenue.transaction_revenue(star(spark, sf_dir), whole(level), "route").select(
        column, "route", "vehicle_transaction_type", "revenue_group", "transaction_count", "gross_revenue"
    )
    path = scratch_path(spark, "by-month")
    partitions.replace_period_partitions(target, path, column, None, "1997-06-30")
    kept = partitions.read_partitioned(spark, path)
    new = kept.filter((F.col(column) == own) & (F.col("vehicle_transaction_type") == "ETC")).withColumn("transaction_count", F.lit(0).cast("bigint"))
    partitions.replace_period_partitions(new, path, column, condition, "1997-06-30")
    return partitions.read_partitioned(spark, path)


def replace_days(spark, sf_dir):
    """June 1997 of the mart replaced by its even days; the odd ones go."""
    path, rows = scratch_path(spark, "mart"), _mart_rows(spark, sf_dir)
    load.write_mart(rows, path)
    partitions.replace_days(rows.filter("year = 1997 AND month = 6 AND day % 2 = 0"), path, date(1997, 6, 1), date(1997, 6, 30))
    return load.read_mart(spark, path)


def published_manifest(spark, sf_dir):
    """All months published, those of 1997 a second time: the manifest, checked against the folders."""
    base, held = scratch_path(spark, "published"), star(spark, sf_dir)
    for span in (whole("month"), calendar.Span.backfill("month", "1997-01-01", "1997-12-31")):
        publishing.publish(revenue.transaction_revenue(held, span, "route"), base, "route_revenue", span)
    there = publishing.published(spark, base).filter("files > 0").select("report", "period", "level", "files", "bytes")
    return publishing.manifest(spark, base).join(there, ["report", "period", "level", "files", "bytes"]).select("report", "level", "period", "rows")


def retention_after_publish(spark, sf_dir):
    """Two months of days published, then the last day again by a run that keeps thirty days."""
    base = scratch_path(spark, "retained")
    job = Job("route_revenue", lambda s, span: revenue.transaction_revenue(s, span, "route"), csv_path=base)
    run_batch(star(spark, sf_dir), [calendar.Span.backfill("day", "1997-03-01", "1997-04-30")], [job])
    run_batch(star(spark, sf_dir), [calendar.Span.containing("day", "1997-04-30")], [replace(job, keep_days=30)])
    there = publishing.published(spark, base).select("report", "period", "level")
    return publishing.manifest(spark, base).join(there, ["report", "period", "level"]).select("report", "level", "period", "rows")


CLEARABLE = {"lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey", "o_custkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}
CLEAR_REFERENCES = [("lineitem", "orders"), ("lineitem", "part"), ("orders", "customer")]


def cleared(fail_at):
    """Rows of copies of four tables after three of them were cleared, or after a failure while clearing."""

    def query(spark, sf_dir):
        paths = {name: scratch_path(spark, f"clear-{name}") for name in CLEARABLE}
        for name, columns in CLEARABLE.items():
            _raw(spark, sf_dir, name).select(columns).write.parquet(paths[name])

        def after_step(name):
            if name == fail_at:
                raise ValueError(f"planted failure after {name}")

        wanted = {name: paths[name] for name in ("lineitem", "orders", "customer")}
        references = spark.createDataFrame(CLEAR_REFERENCES, "child string, parent string")
        try:
            clearing.clear_tables(spark, wanted, references, after_step=after_step)
        except ValueError:
            pass
        counts = [
            spark.read.parquet(path).agg(F.count("*").alias("rows_left")).select(F.lit(name).alias("table_name"), "rows_left")
            for name, path in paths.items()
        ]
        return reduce(DataFrame.unionAll, counts)

    return query


def clear_tables(spark, sf_dir):
    """The report of a clearing run."""
    paths = {name: scratch_path(spark, f"clear-{name}") for name in ("lineitem", "orders", "customer")}
    for name, path in paths.items():
        _raw(spark, sf_dir, name).select(CLEARABLE[name]).write.parquet(path)
    references = spark.createDataFrame(CLEAR_REFERENCES, "child string, parent string")
    return clearing.clear_tables(spark, paths, references)


def run_batch_parallel(spark, sf_dir):
    """The batch of ``run_batch_status``, four reports at once."""
    return run_batch_status(spark, sf_dir, workers=4)


def run_batch_status(spark, sf_dir, workers=1):
    """A batch of three jobs, one of which cannot be resolved."""
    held = star(spark, sf_dir)
    jobs = [
        Job("payment_channel", statistics.payment_channel, csv_path=scratch_path(spark, "batch-csv")),
        Job("broken", lambda s, span: s.fact("txn", span).select("no_such_column")),
        Job("transaction_summary", summary.transaction_summary_by_stage, mart_path=scratch_path(spark, "batch-mart")),
    ]
    # The texts of errors are Spark's own.
    return run_batch(held, [whole("month"), calendar.Span.containing("day", "2030-01-01")], jobs, workers=workers).drop("message")


# migration ---------------------------------------------------------------


def legacy_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pn_id"), F.col("c_name").alias("so_hsld"))


def new_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The migrated persons; customers with a negative balance were left out."""
    return _raw(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        (F.col("c_custkey") * 3 + 1_000_000).alias("id"), F.col("c_name").alias("ll_so_ho_so_lan_dau"), F.col("c_mktsegment").alias("segment")
    )


def _person_keys(spark, sf_dir, how="inner"):
    return lookups.key_map(legacy_person(spark, sf_dir), new_person(spark, sf_dir), "pn_id", "id", "so_hsld", "ll_so_ho_so_lan_dau", how)


def key_remap(how: str) -> Query:
    def run(spark, sf_dir):
        records = _raw(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("pn_id"), "o_orderstatus")
        remapped = lookups.remap(records, _person_keys(spark, sf_dir, how), "pn_id", "person_id", how)
        return remapped.select("o_orderkey", _or_minus("person_id"), "o_orderstatus")
    return run


def nation_dictionary(spark, sf_dir):
    key = F.col("n_nationkey").cast("bigint")
    return _raw(spark, sf_dir, "nation").select(
        (key + 100).alias("id"), key.cast("string").alias("code"), F.col("n_name").alias("title"), (key % 7 == 0).cast("int").alias("is_deleted")
    )


def part_dictionary(spark, sf_dir):
    key = F.col("p_partkey")
    return _raw(spark, sf_dir, "part").select(
        (key + 5000).alias("id"), F.concat(F.lit("P"), key.cast("string")).alias("code"), F.col("p_name").alias("title"),
        (key % 10 == 0).cast("int").alias("is_deleted"),
    )


def supplier_dictionary(spark, sf_dir):
    key = F.col("s_suppkey")
    return _raw(spark, sf_dir, "supplier").select(
        (key + 9000).alias("id"), key.alias("code"), F.col("s_name").alias("title"), (key % 5 == 0).cast("int").alias("is_deleted")
    )


def coded_lines(spark, sf_dir):
    """Lines with part, supplier and nation codes; some nation codes are unknown or NULL."""
    supp = F.col("l_suppkey")
    return _raw(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part_code"),
        supp.alias("supplier_code"), F.when(F.col("l_partkey") % 50 != 0, (supp % 27).cast("string")).alias("nation_code"),
        F.concat(F.lit("  "), (supp % 25).cast("string"), F.lit(" ")).alias("padded_code"),
    )


def multi_code_lookup(spark, sf_dir):
    parts, suppliers, nations = part_dictionary(spark, sf_dir), supplier_dictionary(spark, sf_dir), nation_dictionary(spark, sf_dir)
    resolved = lookups.resolve(coded_lines(spark, sf_dir), [
        lookups.Lookup("part_code", parts, "part_id"),
        lookups.Lookup("supplier_code", suppliers, "supplier_id"),
        lookups.Lookup("nation_code", nations, "nation_id"),
        lookups.Lookup("nation_code", nations, "nation_title", value="title"),
        lookups.Lookup("padded_code", nations, "place_id", as_text=True),
    ])
    return resolved.select(
        "l_orderkey", "l_linenumber", "part_id", "supplier_id", _or_minus("nation_id"), "nation_title", "place_id"
    )


def _or_minus(name: str) -> Column:
    """An id for comparison, -1 standing for NULL."""
    return F.coalesce(F.col(name), F.lit(-1)).cast("bigint").alias(name)


def role_playing_lookup(spark, sf_dir):
    """Seven grade columns against one dictionary."""
    grades = nation_dictionary(spark, sf_dir)
    names = [f"grade_{i}" for i in range(1, 8)]
    rows = _raw(spark, sf_dir, "orders").select(
        "o_orderkey", *[((F.col("o_orderkey") * i + F.col("o_custkey")) % 29).cast("string").alias(n) for i, n in enumerate(names, start=1)]
    )
    resolved = lookups.resolve(rows, [lookups.Lookup(n, grades, f"{n}_id") for n in names])
    return resolved.select("o_orderkey", *[_or_minus(f"{n}_id") for n in names])


def lookup_live_rows(spark, sf_dir):
    resolved = lookups.resolve(coded_lines(spark, sf_dir), [
        lookups.Lookup("part_code", part_dictionary(spark, sf_dir), "part_id", live_only=True),
        lookups.Lookup("nation_code", nation_dictionary(spark, sf_dir), "nation_id", live_only=True),
    ])
    return resolved.select("l_orderkey", "l_linenumber", "part_code", _or_minus("part_id"), _or_minus("nation_id"))


def text_key_join(spark, sf_dir):
    """Numeric dictionary keys against padded text codes."""
    suppliers = supplier_dictionary(spark, sf_dir)
    resolved = lookups.resolve(coded_lines(spark, sf_dir), [lookups.Lookup("padded_code", suppliers, "supplier_id", as_text=True)])
    return resolved.select("l_orderkey", "l_linenumber", "padded_code", _or_minus("supplier_id"))


def code_rows(spark, sf_dir):
    """Orders with a delimited list of nation codes: empty, NULL, with gaps and unknown codes."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    a, b, c = (key % 28).cast("string"), (cust % 30).cast("string"), (key % 5).cast("string")
    listed = (
        F.when(key % 11 == 0, "").when(key % 13 == 0, F.concat(a, F.lit(";;"), b))
        .when(key % 17 != 0, F.concat(a, F.lit(";"), b, F.lit(";"), c))
    )
    return _raw(spark, sf_dir, "orders").select("o_orderkey", listed.alias("codes"))


def explode_codes(spark, sf_dir):
    return lookups.explode_codes(code_rows(spark, sf_dir), "codes", "code")


def code_list(by_position: bool) -> Query:
    def run(spark, sf_dir):
        separators = ",;" if by_position else ";"
        return lookups.resolve_code_list(
            code_rows(spark, sf_dir), "codes", nation_dictionary(spark, sf_dir), "id_list", separators, by_position
        )
    return run


def date_texts(spark, sf_dir):
    """Order dates as texts: two accepted forms and several that are not."""
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    value = (
        F.when(key % 5 == 0, F.date_format(d, "dd/MM/yyyy")).when(key % 5 == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(key % 5 == 2, F.date_format(d, "yyyy/MM/dd"))
        .when(key % 35 == 3, "31/02/2020").when(key % 35 == 8, "99/99/2020").when(key % 35 == 13, "1/2/2020")
        .when(key % 35 == 18, "").when(key % 5 == 3, F.date_format(d, "dd/MM/yyyy"))
    )
    return _raw(spark, sf_dir, "orders").select("o_orderkey", value.alias("date_text"))


def normalize_date_text(spark, sf_dir):
    stamp = F.date_format(text.day_first_timestamp(F.col("date_text")), "yyyy-MM-dd HH:mm:ss")
    return date_texts(spark, sf_dir).select(
        "*", text.normalize_date_text(F.col("date_text")).alias("iso_date"), stamp.alias("start_time")
    )


def split_by_content(spark, sf_dir):
    key = F.col("c_custkey")
    rows = _raw(spark, sf_dir, "customer").select(
        "c_custkey", F.when(key % 4 == 0, F.concat(F.lit("0"), key.cast("string"))).when(key % 4 == 1, F.concat(F.lit("Đ"), key.cast("string"))).alias("a"),
        F.when(key % 4 != 3, F.concat("c_mktsegment", key.cast("string"))).alias("b"),
    )
    digits, letters = text.split_by_content(F.col("a"), F.col("b"))
    return rows.select("c_custkey", digits.alias("id_number"), letters.alias("passport"))


def compose_text(spark, sf_dir):
    key = F.col("o_orderkey")
    one, two = F.when(key % 3 != 0, F.col("o_orderpriority")), F.when(key % 4 != 0, F.col("o_orderstatus"))
    three = F.when(key % 6 != 0, F.col("o_custkey").cast("string"))
    return _raw(spark, sf_dir, "orders").select(
        "o_orderkey", text.compose_text(", ", one, two, three).alias("address"), text.compose_text("\n", one, two).alias("remark")
    )


def lenient_number(spark, sf_dir):
    key = F.col("o_orderkey")
    value = (
        F.when(key % 4 == 0, F.concat(key.cast("string"), F.lit("x"))).when(key % 4 == 1, key.cast("string"))
        .when(key % 4 == 2, F.concat(F.lit(" "), (key % 100).cast("string"), F.lit(".5 ")))
    )
    return _raw(spark, sf_dir, "orders").select("o_orderkey", text.lenient_number(value).alias("number"))


def null_safe_arithmetic(spark, sf_dir):
    key, total = F.col("o_orderkey"), text.money(F.col("o_totalprice"))
    paid = F.when(key % 3 != 0, text.money(total / 2))
    extra = F.when(key % 5 != 0, text.money(F.lit(10)))
    return _raw(spark, sf_dir, "orders").select(
        "o_orderkey", (total - text.or_zero(paid)).cast("decimal(20,2)").alias("left_to_pay"),
        (text.or_zero(paid) + text.or_zero(extra)).cast("decimal(20,2)").alias("received"),
    )


def truncate_text(spark, sf_dir):
    return _raw(spark, sf_dir, "documents").select("doc_id", text.truncate_text(F.col("text"), 1000).alias("note"))


def wrap_id(spark, sf_dir):
    resolved = lookups.resolve(coded_lines(spark, sf_dir), [lookups.Lookup("nation_code", nation_dictionary(spark, sf_dir), "nation_id")])
    return resolved.select("l_orderkey", "l_linenumber", text.wrap_id(F.col("nation_id")).alias("nation_list"))


def header_detail_count(spark, sf_dir):
    headers = _raw(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    details = _raw(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return migrate.header_detail_count(headers, details, "o_orderkey", "line_count")


STRICT = ["giver", "signed_on"]
NULL_SAFE = ["rank", "post", "office_id"]


def handover_rows(spark, sf_dir):
    """Orders as handover records: attributes repeat, some are NULL, also among the strict ones."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return _raw(spark, sf_dir, "orders").select(
        key.alias("record_id"), F.when(cust % 50 != 0, F.concat(F.lit("G"), (cust % 40).cast("string"))).alias("giver"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("rank"), F.when(cust % 2 == 0, F.col("o_orderstatus")).alias("post"),
        F.when(cust % 3 != 0, cust % 7).alias("office_id"), F.date_format("o_orderdate", "yyyy-MM").alias("signed_on"),
    )


def distinct_header_link(spark, sf_dir):
    """Distinct headers get an id; each record is linked to its header."""
    rows = handover_rows(spark, sf_dir)
    headers = rows.groupBy(*STRICT, *NULL_SAFE).agg(F.min("record_id").alias("id"))
    return migrate.link_to_headers(rows, headers, STRICT, NULL_SAFE, "header_id").select("record_id", "header_id")


def id_map_detail(spark, sf_dir):
    """Old report ids mapped to one new id each; the details follow."""
    old = handover_rows(spark, sf_dir).filter("giver IS NOT NULL").select(
        F.col("record_id").alias("old_report"), "giver", "signed_on"
    )
    new = old.select((F.col("old_report") + 700000).alias("new_report"), "giver", "signed_on").filter("new_report % 2 = 0")
    mapped = migrate.id_map(old, new, ["giver", "signed_on"], "old_report", "new_report")
    details = _raw(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("old_id"), "l_partkey", "l_linenumber")
    return details.join(mapped, "old_id").select("new_id", "l_partkey", "l_linenumber")


def multi_key_lookup(spark, sf_dir):
    """Yearly money of a person joined on person and year."""
    graded = _raw(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year_of"))
    paid = (
        _raw(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year_of"))
        .agg(F.sum(text.money(F.col("o_totalprice"))).cast("decimal(28,2)").alias("money"))
    )
    return graded.join(paid, ["person_id", "year_of"], "left")


def audit_columns(spark, sf_dir):
    """A whole table migration: key map, lookups, scalar rules, audit columns."""
    source = _raw(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("pn_id"), (F.col("o_custkey") % 27).cast("string").alias("office_code"), "o_orderpriority", "o_totalprice"
    )
    spec = migrate.Migration(
        key_column="pn_id", key_out="person_id", run_at=RUN_AT, creator=1,
        lookups=[lookups.Lookup("office_code", nation_dictionary(spark, sf_dir), "office_id", live_only=True)],
        columns={
            "id": "o_orderkey", "person_id": "person_id", "office_id": _or_minus("office_id"),
            "note": text.truncate_text(F.col("o_orderpriority"), 5), "amount": text.money(F.col("o_totalprice")),
        },
    )
    rows = spec.apply(source, _person_keys(spark, sf_dir))
    empty = ["creator_user_id", "last_modifier_user_id", "deleter_user_id", "last_modification_time", "deletion_time"]
    return rows.withColumns({c: F.col(c).cast("string") for c in empty})


def cast_and_label(spark, sf_dir):
    d = F.col("o_orderdate")
    year = F.date_format(d, "yyyy")
    return _raw(spark, sf_dir, "orders").select(
        "o_orderkey", year.alias("year_text"), F.concat(F.lit("Đợt đặc xá "), year).alias("round_name"),
        F.to_date(d).cast("timestamp_ntz").alias("reviewed_at"),
    )


def dictionary_copy(spark, sf_dir):
    return _raw(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("title"), F.lit(1).alias("state"),
        F.lit(RUN_AT).cast("timestamp_ntz").alias("creation_time"), F.lit(0).alias("is_deleted"),
    )


def platform_queries() -> dict[str, Query]:
    """One query per calendar, dimension, load, migration and run-log operator."""
    def view(method: str) -> Query:
        return lambda spark, sf_dir: getattr(star(spark, sf_dir), method)()

    out: dict[str, Query] = {
        "scan_fact_detail": scan_fact_detail, "dim_load_cached": dim_load_cached,
        "dim_stage_closed": view("stage_closed"), "dim_stage_closed_lanes": view("stage_closed_lanes"),
        "dim_cycle_lane": view("cycle_lanes"), "copy_columns": copy_columns, "dim_date": dim_date,
        "job_select": lambda spark, sf: runlog.active_jobs(registry(spark, sf), "3"),
        "mart_feed_projection": mart_feed_projection, "detail_base_join": detail_base_join,
        "period_attributes": period_attributes, "partition_hour_filter": partition_hour_filter,
        "level_dispatch": level_dispatch, "period_labels": period_labels,
        "csv_roundtrip": csv_roundtrip, "csv_single_part": csv_single_part, "normalize_partitions": normalize_partitions,
        "mart_overwrite": mart_overwrite, "mart_guard": mart_guard, **{f"replace_period{suffix}": replace_period(*how) for suffix, how in REPLACED.items()},
        "retention_expired": retention_expired, "full_refresh_counts": full_refresh_counts,
        "source_target_counts": source_target_counts, "clear_order": clear_order, "run_batch_status": run_batch_status, "run_batch_parallel": run_batch_parallel,
        "replace_partitioned": replace_partitioned, "replace_days": replace_days, "published_manifest": published_manifest,
        "retention_after_publish": retention_after_publish, "clear_tables": clear_tables,
        "cleared_tables": cleared(None), "cleared_tables_undone": cleared("orders"),
        "key_remap_inner": key_remap("inner"), "key_remap_left": key_remap("left"),
        "multi_code_lookup": multi_code_lookup, "role_playing_lookup": role_playing_lookup,
        "lookup_live_rows": lookup_live_rows, "text_key_join": text_key_join, "explode_codes": explode_codes,
        "code_list_by_position": code_list(True), "code_list_distinct": code_list(False),
        "normalize_date_text": normalize_date_text, "split_by_content": split_by_content, "compose_text": compose_text,
        "lenient_number": lenient_number, "null_safe_arithmetic": null_safe_arithmetic, "truncate_text": truncate_text,
        "wrap_id": wrap_id, "header_detail_count": header_detail_count, "distinct_header_link": distinct_header_link,
        "id_map_detail": id_map_detail, "multi_key_lookup": multi_key_lookup, "audit_columns": audit_columns,
        "cast_and_label": cast_and_label, "dictionary_copy": dictionary_copy,
        "run_log_append": run_log_append,
        "latest_failed_runs": lambda spark, sf: runlog.latest_runs(history(spark, sf), "error", judged_after=True),
        "latest_success_runs": lambda spark, sf: runlog.latest_runs(history(spark, sf), "success", judged_after=False),
        "job_history": lambda spark, sf: runlog.job_history(history(spark, sf), 7),
        "all_history": lambda spark, sf: runlog.newest_first(history(spark, sf)),
        "log_search_page": lambda spark, sf: runlog.search_page(run_log(spark, sf), "CLICK", page=2, page_size=50),
        "log_search_deep_page": lambda spark, sf: runlog.search_page(run_log(spark, sf), "", page=12, page_size=40),
        "log_purge_date": lambda spark, sf: runlog.purge_day(run_log(spark, sf), "2024-01-15"),
        "validate_job_rows": lambda spark, sf: runlog.validate_jobs(imported(spark, sf)).drop("description").withColumn("is_active", F.col("is_active").cast("string")),
        "assign_ids": assign_ids, "job_preview": job_preview,
        "top_500": lambda spark, sf: runlog.newest(history(spark, sf)), "bulk_delete_ids": bulk_delete_ids,
        "dedupe_pairs": dedupe_pairs,
    }
    for level in calendar.LEVELS:
        out[f"utc_ranges_{level}"] = utc_ranges(level)
    return out
