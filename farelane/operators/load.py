"""Publishing and loading: CSV, mart partitions, period replace, retention, refresh."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelane.functions.calendar import parse_day
from farelane.session import checkpointed

MART_PARTITIONS = ("year", "month", "day")


def write_csv(df: DataFrame, path: str, delimiter: str = ",", by: tuple[str, ...] = ()) -> None:
    """Headerless UTF-8 CSV; NULL and empty text are both written as nothing.

    ``by`` names columns (a period's labels) with a folder for each of their values; only the folders of
    the result's values are replaced, so a single day can be published again without the rest of its back-fill.
    """
    out = (
        (df.hint("rebalance", *by) if by else df).write.mode("overwrite").option("header", "false").option("sep", delimiter)
        .option("encoding", "UTF-8").option("emptyValue", "").option("nullValue", "")
    )
    if not by:
        out.csv(path)
        return
    # A period is one file unless it is large; merging small tasks would only leave the files to fewer of them.
    with _setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        out.option("partitionOverwriteMode", "dynamic").partitionBy(*by).csv(path)


def read_csv(spark: SparkSession, path: str, schema, delimiter: str = ",") -> DataFrame:
    """Read such a CSV back with its schema; nothing becomes NULL."""
    return (
        spark.read.schema(schema).option("header", "false").option("sep", delimiter).option("encoding", "UTF-8")
        .option("emptyValue", "").option("nullValue", "").option("mode", "FAILFAST").option("multiLine", "true").csv(path)
    )


def write_named_csv(df: DataFrame, path: str, file_name: str, delimiter: str = ",", single_file: bool = False) -> list[str]:
    """CSV parts with the given name and a number, whatever the size; returns the names in order.

    A caller that knows its result to be small may ask for ``single_file``: one task then writes all of it
    under the plain name.
    """
    write_csv(df.coalesce(1) if single_file else df, path, delimiter)
    jvm = df.sparkSession._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    stem, dot, end = file_name.rpartition(".")
    names = [file_name] if single_file else [f"{stem or end}-{i:05d}{dot}{end if stem else ''}" for i in range(len(parts))]
    for part, name in zip(parts, names):
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(folder, part), jvm.org.apache.hadoop.fs.Path(folder, name)):
            raise OSError(f"{part} could not be named {name}")
    return names[: len(parts)]


def normalize_partitions(df: DataFrame) -> DataFrame:
    """``year`` as text, ``month`` and ``day`` as two-digit text."""
    return df.withColumns({
        "year": F.col("year").cast("string"),
        "month": F.lpad(F.col("month").cast("string"), 2, "0"),
        "day": F.lpad(F.col("day").cast("string"), 2, "0"),
    })


def missing_partitions(df: DataFrame) -> list[str]:
    """Mart partition columns the result lacks (names compared without case)."""
    present = {name.lower() for name in df.columns}
    return [name for name in MART_PARTITIONS if name not in present]


def write_mart(df: DataFrame, path: str) -> None:
    """Replace exactly the touched day partitions of a Parquet mart.

    The rows are rebalanced by day: each day goes to one task and becomes one file,
    except a very large day, which is split. Merging small tasks is switched off for
    the write: it would not make fewer files, only leave them to fewer tasks.
    """
    lacking = missing_partitions(df)
    if lacking:
        raise ValueError(f"partition columns missing: {lacking}")
    with _setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        (
            normalize_partitions(df).hint("rebalance", *MART_PARTITIONS)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MART_PARTITIONS).parquet(path)
        )


def write_mart_table(df: DataFrame, table: str, catalog_v2: bool = False) -> None:
    """Replace exactly the touched day partitions of a catalog table, creating it if needed.

    ``catalog_v2`` is for tables of a v2 catalog, which replace partitions themselves.
    """
    lacking = missing_partitions(df)
    if lacking:
        raise ValueError(f"partition columns missing: {lacking}")
    spark = df.sparkSession
    values = [c for c in df.columns if c not in MART_PARTITIONS]
    rows = normalize_partitions(df).select(*values, *MART_PARTITIONS).hint("rebalance", *MART_PARTITIONS)
    with _setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        if catalog_v2 and spark.catalog.tableExists(table):
            rows.writeTo(table).overwritePartitions()
        elif catalog_v2:
            rows.writeTo(table).partitionedBy(*[F.col(c) for c in MART_PARTITIONS]).create()
        elif spark.catalog.tableExists(table):
            with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                rows.write.insertInto(table, overwrite=True)
        else:
            rows.write.partitionBy(*MART_PARTITIONS).saveAsTable(table)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart with its partition columns kept as text."""
    with _setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        return spark.read.parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    kept = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, kept)


def period_condition(column: str, condition: str, day: str | date) -> Column:
    """Predicate on a target's period key: ``day``, ``month``, ``year``, ``quarter`` or ``time`` range."""
    d = parse_day(day)
    quarter = (d.month - 1) // 3 + 1
    # The notations of each period, the reports' labels among them.
    keys = {
        "day": [f"{d:%Y%m%d}00", f"{d:%Y-%m-%d}", f"{d:%Y%m%d}"],
        "month": [f"{d:%Y-%m}", f"{d:%Y%m}"],
        "year": [f"{d:%Y}"],
        "quarter": [f"{d.year}-Q{quarter}", f"{d.year}Q{quarter}"],
    }
    if condition == "time":
        return F.col(column).between(f"{d:%Y%m%d}00", f"{d:%Y%m%d}23")
    if condition not in keys:
        raise ValueError("condition must be day, month, year, time or quarter")
    return F.col(column).cast("string").isin(keys[condition])


def replace_period(target: DataFrame, new: DataFrame, column: str, condition: str | None, day: str | date) -> DataFrame:
    """The target with the period's rows replaced by the new ones; no condition only appends."""
    if condition in (None, "", "none"):
        return target.unionByName(new)
    gone = F.coalesce(period_condition(column, condition, day), F.lit(False))
    return target.filter(~gone).unionByName(new)


def expired_partitions(partitions: DataFrame, base: str | date, days_before: int = 3) -> DataFrame:
    """Day partitions on or before ``base`` minus ``days_before``."""
    cutoff = parse_day(base) - timedelta(days=days_before)
    held = F.make_date(*[F.col(c).cast("int") for c in MART_PARTITIONS])
    return partitions.select(*MART_PARTITIONS).distinct().filter(held <= F.lit(cutoff))


def drop_expired(spark: SparkSession, table: str, base: str | date, days_before: int = 3) -> int:
    """Drop the expired day partitions of a catalog table; returns how many.

    Only partition names are read here, one per day kept.
    """
    specs = spark.sql(f"SHOW PARTITIONS {table}").select(
        *[F.regexp_extract("partition", rf"(?:^|/){c}=([^/]+)", 1).alias(c) for c in MART_PARTITIONS]
    )
    gone = expired_partitions(specs, base, days_before).collect()
    if gone:
        clauses = ", ".join("PARTITION (" + ", ".join(f"{c}='{row[c]}'" for c in MART_PARTITIONS) + ")" for row in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")
    return len(gone)


def full_refresh(source: DataFrame, path: str) -> dict[str, int]:
    """Replace a Parquet target by the source; returns deleted and inserted row counts.

    The new rows are written beside the target, counted on the way, and swapped in when
    complete: a failed run leaves the old rows, and the source may read the target.
    """
    spark = source.sparkSession
    jvm = spark._jvm
    target, staged, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}__new-{uuid4().hex}", f"{path}__old-{uuid4().hex}"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    exists = fs.exists(target)
    deleted = spark.read.parquet(path).count() if exists else 0
    seen = Observation()
    source.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged.toString())
    _swap_in(fs, staged, target, old)
    return {"deleted": deleted, "inserted": seen.get["rows"]}


def _swap_in(fs, staged, target, old) -> None:
    """Put a complete folder in the place of the target; a failed step restores the old one."""
    exists = fs.exists(target)
    if exists and not fs.rename(target, old):
        fs.delete(staged, True)
        raise OSError(f"{target} could not be set aside; it is unchanged")
    if not fs.rename(staged, target):
        if exists:
            fs.rename(old, target)
        raise OSError(f"the new rows could not be moved to {target}; the old ones were put back")
    if exists:
        fs.delete(old, True)


def publish_csv(df: DataFrame, path: str) -> int:
    """Write a CSV beside the target and swap it in; returns its rows. An empty result leaves the target as it is."""
    spark = df.sparkSession
    make = spark._jvm.org.apache.hadoop.fs.Path
    target, staged, old = make(path), make(f"{path}__new-{uuid4().hex}"), make(f"{path}__old-{uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    seen = Observation()
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), staged.toString())
    rows = seen.get["rows"]
    if rows:
        _swap_in(fs, staged, target, old)
    else:
        fs.delete(staged, True)
    return rows


def source_target_counts(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """Row counts of both sides and their gap, as one row."""
    tagged = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target.select(F.lit(0), F.lit(1)))
    return tagged.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows")
    ).select(F.lit(name).alias("table_name"), "*", (F.col("source_rows") - F.col("target_rows")).alias("missing_rows"))


def clear_order(spark: SparkSession, references: DataFrame) -> DataFrame:
    """Step in which to clear each table, children before the tables they reference.

    ``references`` holds one row per (child, parent) pair of tables. A table comes after
    every chain of children below it; a cycle is an error. Tables are taken layer by layer, each once per layer,
    so the work follows the references and not the number of chains.
    """
    edges = checkpointed(references.select("child", "parent").distinct())
    most = edges.select("child").union(edges.select("parent")).distinct().count()
    layer = edges.select(F.col("child").alias("table_name")).distinct()
    steps = layer.withColumn("step", F.lit(1))
    for step in range(2, most + 2):
        layer = checkpointed(layer.join(edges, F.col("table_name") == F.col("child")).select(F.col("parent").alias("table_name")).distinct())
        if layer.isEmpty():
            return steps.groupBy("table_name").agg(F.max("step").alias("step"))
        steps = steps.union(layer.withColumn("step", F.lit(step)))
    if most == 0:
        return steps
    raise ValueError("the references form a cycle")
