"""Helpers that several operators of this package use."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    This cuts the lineage, so that a lost executor never re-runs what is behind it, and fixes
    values that depend on the physical layout.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Most rows of a frame that is sent whole to every executor (some tens of MB of words and ids).
BROADCAST_ROWS = 200_000


def sent_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is: the join then shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is derived from texts stays small in memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
