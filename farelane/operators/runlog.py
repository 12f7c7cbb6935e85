"""Run log, run history and job registry analytics."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.calendar import parse_day
from farelane.operators.numbering import best_per_key, numbered

MESSAGE_LIMIT = 8000
PREVIEW_LIMIT = 180
MAX_PAGE_SIZE = 200

# Accepted job types and true texts of an imported registry row.
JOB_TYPES = ("1", "2", "3", "4", "5")
TRUE_TEXTS = ("TRUE", "1", "YES", "Y")
REQUIRED_COLUMNS = ("job_type", "schema_name", "table_name")

LOG_SCHEMA = (
    "job_name string, job_type string, table_name string, operation_type string, error_level string, "
    "message string, error_code string, error_traceback string, sql_path string, year string, month string, day string, "
    "delete_column string, delete_condition string, created_by string, rows_inserted bigint, execution_time_ms bigint, created_at timestamp_ntz"
)


def active_jobs(registry: DataFrame, job_type: str) -> DataFrame:
    """Active jobs of a type in id order."""
    return registry.filter(F.col("is_active") & (F.col("job_type") == job_type)).orderBy("id")


def log_rows(rows: DataFrame) -> DataFrame:
    """Rows ready for the log: texts cut to the limit, known levels only."""
    level = F.when(F.col("error_level").isin("ERROR", "WARNING", "INFO"), F.col("error_level")).otherwise("ERROR")
    return rows.withColumns({
        "message": F.substring("message", 1, MESSAGE_LIMIT),
        "error_traceback": F.substring("error_traceback", 1, MESSAGE_LIMIT),
        "error_level": level,
    })


def append_log(rows: DataFrame, path: str) -> None:
    """Append rows to the log table."""
    log_rows(rows).write.mode("append").parquet(path)


def log_entry(spark: SparkSession, created_at: datetime, **values) -> DataFrame:
    """One log row; fields not given are NULL."""
    fields = [f.split()[0] for f in LOG_SCHEMA.split(", ")]
    record = {**{f: None for f in fields}, "error_level": "INFO", **values, "created_at": created_at}
    return spark.createDataFrame([tuple(record[f] for f in fields)], LOG_SCHEMA)


def latest_runs(history: DataFrame, status: str, judged_after: bool) -> DataFrame:
    """Latest run per job with the given status, newest first.

    ``judged_after`` takes the latest run of all and keeps it only if it has the status;
    otherwise the latest among the runs that have it.
    """
    order = [F.col("run_at"), F.col("id")]
    if judged_after:
        chosen = best_per_key(history, ["stmt_id"], order).filter(F.col("status") == status)
    else:
        chosen = best_per_key(history.filter(F.col("status") == status), ["stmt_id"], order)
    return newest_first(chosen)


def newest_first(history: DataFrame) -> DataFrame:
    """History ordered by run time, newest first."""
    return history.orderBy(F.col("run_at").desc(), F.col("id").desc())


def job_history(history: DataFrame, stmt_id: int) -> DataFrame:
    """Runs of one job, newest first."""
    return newest_first(history.filter(F.col("stmt_id") == stmt_id))


def search_page(log: DataFrame, table_name: str, page: int = 1, page_size: int = 50) -> DataFrame:
    """One page of the log by descending id, with the total and the page count.

    The name filter is a case-insensitive substring; a NULL name counts as empty. All pages
    are cut the same way: the hits are numbered in parallel and the page is taken by number. Rows that share an id come in the order of their remaining columns.
    """
    page, size = max(1, page), max(1, min(page_size, MAX_PAGE_SIZE))
    hits = log
    if table_name.strip():
        hits = log.filter(F.lower(F.coalesce("table_name", F.lit(""))).contains(table_name.strip().lower()))
    total = hits.agg(F.count("*").alias("n")).scalar()
    skip = (page - 1) * size
    order = [F.col("id").desc(), *[F.col(c) for c in hits.columns if c != "id"]]
    rows = numbered(hits, order, "_n").filter(F.col("_n").between(skip + 1, skip + size)).drop("_n").orderBy(*order)
    return rows.withColumns({
        "total": total,
        "total_pages": F.greatest(F.ceil(total / F.lit(size)), F.lit(1)).cast("bigint"),
    })


def purge_day(log: DataFrame, day: str | date) -> DataFrame:
    """The log without the rows created on one calendar date."""
    same = F.to_date("created_at") == F.lit(parse_day(day))
    return log.filter(~F.coalesce(same, F.lit(False)))


def missing_columns(rows: DataFrame) -> list[str]:
    """Required registry columns an import lacks."""
    return [c for c in REQUIRED_COLUMNS if c not in rows.columns]


def validate_jobs(rows: DataFrame) -> DataFrame:
    """Imported registry rows, cleaned, with their list of faults and a validity flag."""
    lacking = missing_columns(rows)
    if lacking:
        raise ValueError(f"required columns missing: {lacking}")

    def clean(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name).cast("string")), F.lit(""))

    active = F.upper(F.trim(F.col("is_active").cast("string"))).isin(*TRUE_TEXTS)
    texts = {name: clean(name) for name in ("job_type", "schema_name", "table_name", "sql_path", "description")}
    rows = rows.withColumns({**texts, "is_active": active})
    # Fault texts of the import check.
    faults = [
        (~F.col("job_type").isin(*JOB_TYPES), "Loại job không hợp lệ (phải là 1-5)"),
        (F.col("schema_name") == "", "Schema name không được rỗng"),
        (F.col("table_name") == "", "Table name không được rỗng"),
        (F.col("sql_path") == "", "SQL Path không được rỗng"),
        (F.col("is_active").isNull(), "is_active không hợp lệ (phải là TRUE/FALSE)"),
    ]
    found = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in faults]))
    return rows.withColumn("errors", F.array_join(found, ", ")).withColumn("valid", F.col("errors") == "")


def validation_summary(checked: DataFrame) -> DataFrame:
    """Total, valid and invalid row counts."""
    return checked.agg(
        F.count("*").alias("total"), F.count_if(F.col("valid")).alias("valid"), F.count_if(~F.col("valid")).alias("invalid")
    )


def previewed(jobs: DataFrame, column: str) -> DataFrame:
    """Registry in id order with a single-line preview of a text column."""
    line = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), "\r", ""), "\n", " "))
    cut = F.when(F.length(line) > PREVIEW_LIMIT, F.concat(F.substring(line, 1, PREVIEW_LIMIT), F.lit("..."))).otherwise(line)
    return jobs.withColumn("preview", cut).orderBy("id")


def newest(rows: DataFrame, limit: int = 500) -> DataFrame:
    """The newest rows by id."""
    return rows.orderBy(F.col("id").desc()).limit(limit)


def first_of_pairs(pairs: DataFrame, position: str = "position") -> DataFrame:
    """The first of repeated (target, source) pairs in input order."""
    return best_per_key(pairs, ["target", "source"], [F.col(position)], newest=False)
