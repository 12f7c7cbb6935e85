"""Cached dimensions and plain table copies."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def parse_config(text: str) -> list[tuple[str, str]]:
    """``table|view`` lines; blank lines and ``#`` comments are skipped."""
    lines = [line.strip() for line in text.splitlines()]
    pairs = [line.split("|", 1) for line in lines if line and not line.startswith("#")]
    return [(pair[0].strip(), pair[-1].strip()) for pair in pairs]


def cache_dimensions(spark: SparkSession, config: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """Persist each table, materialise it and register it as a view.

    A table that cannot be read is skipped with a warning; the others still load.
    """
    held: dict[str, DataFrame] = {}
    for table, view in config:
        try:
            frame = spark.table(table).persist(StorageLevel.MEMORY_AND_DISK)
            rows = frame.count()
        except AnalysisException as fault:
            log.warning("dimension %s skipped: %s", table, fault)
            continue
        frame.createOrReplaceTempView(view)
        held[view] = frame
        log.info("dimension %s: %s rows", view, rows)
    return held


def release_dimensions(spark: SparkSession, held: dict[str, DataFrame]) -> None:
    """Unpersist the dimensions and drop their views."""
    for view, frame in held.items():
        frame.unpersist()
        spark.catalog.dropTempView(view)


def copy_columns(source: DataFrame, columns: dict[str, str], condition: str | None = None) -> DataFrame:
    """Source rows under target column names, optionally filtered by a SQL condition."""
    rows = source.filter(condition) if condition else source
    return rows.select(*[F.col(old).alias(new) for old, new in columns.items()])


def read_jdbc(spark: SparkSession, url: str, table: str, split_column: str, bounds: tuple[int, int], parts: int,
              fetch_size: int = 10_000, **options: str) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", table)
        .option("partitionColumn", split_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1])
        .option("numPartitions", parts).option("fetchsize", fetch_size).options(**options).load()
    )
