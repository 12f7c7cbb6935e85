"""Period replace on targets that are partitioned by their period: only the touched folders change."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession

from farelane.operators.load import MART_PARTITIONS, normalize_partitions, period_condition


class Folder:
    """A folder of any file system that Spark reaches: names, moves and removals, never the data itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._at = self._make(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def child(self, name: str) -> Folder:
        """A folder below."""
        return Folder(self.spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def names(self, hidden: bool = False) -> list[str]:
        """Names of what stands directly below, in order; without hidden ones."""
        if not self.exists():
            return []
        every = (s.getPath().getName() for s in self._fs.listStatus(self._at))
        return sorted(n for n in every if hidden or n[0] not in "._")

    def files(self) -> dict[str, tuple[int, int]]:
        """Size and time of change of each visible file, by its path below the folder, at any depth."""
        found: dict[str, tuple[int, int]] = {}
        if not self.exists():
            return found
        below, root = self._fs.listFiles(self._at, True), self._fs.makeQualified(self._at).toUri().getPath()
        while below.hasNext():
            status = below.next()
            name = status.getPath().toUri().getPath()[len(root) + 1 :]
            if not any(part[0] in "._" for part in name.split("/")):
                found[name] = (status.getLen(), status.getModificationTime())
        return found

    def remove(self) -> None:
        self._fs.delete(self._at, True)

    def move_to(self, target: Folder) -> bool:
        """Rename to a path that does not exist; makes the folders above it."""
        self._fs.mkdirs(target._at.getParent())
        return self._fs.rename(self._at, target._at)

    def replace(self, target: Folder) -> None:
        """Take the place of the target. If that fails, the target is put back."""
        parent, _, name = target.path.rpartition("/")
        aside = Folder(self.spark, f"{parent}/.{name}__old-{uuid4().hex}")  # readers pass over names with a dot
        held = target.exists()
        if held and not target.move_to(aside):
            raise OSError(f"{target.path} could not be set aside; it is unchanged")
        if not self.move_to(target):
            if held:
                aside.move_to(target)
            raise OSError(f"the new rows could not be moved to {target.path}; the old ones were put back")
        if held:
            aside.remove()

    def pour_into(self, target: Folder) -> None:
        """Move the files into an existing folder, beside those there (writers give each file a name of its own)."""
        for name in self.names():
            if not self.child(name).move_to(target.child(name)):
                raise OSError(f"{name} could not be moved to {target.path}")
        self.remove()


@dataclass(frozen=True)
class Replaced:
    """Partition values whose old rows went, and those that got rows."""

    removed: tuple[str, ...]
    written: tuple[str, ...]


def _partition_values(folder: Folder, column: str) -> dict[str, str]:
    """Partition value to folder name, of a folder partitioned by one column."""
    prefix = f"{column}="
    return {unquote(n[len(prefix) :]): n for n in folder.names() if n.startswith(prefix)}


def replace_period_partitions(new: DataFrame, path: str, column: str, condition: str | Column | None, day: str | date) -> Replaced:
    """Replace one period of a Parquet target partitioned by its period column, and touch nothing else.

    The period's partitions go, whether the new rows have any for them or not, so an empty re-run leaves no stale rows.
    ``condition`` is a period kind, or a predicate on the partition column
    (as text). New rows of other periods are added beside what stands there. Without a condition new rows are only added. The new rows
    are complete beside the target before any folder is moved. Only folder names reach the driver.
    """
    spark = new.sparkSession
    target, staged = Folder(spark, path), Folder(spark, f"{path}__new-{uuid4().hex}")
    new.hint("rebalance", column).write.partitionBy(column).parquet(staged.path)
    there, fresh = _partition_values(target, column), _partition_values(staged, column)
    doomed: set[str] = set()
    by_rule = isinstance(condition, Column)
    if (by_rule or condition not in (None, "", "none")) and there:
        names = spark.createDataFrame([(v,) for v in there], f"`{column}` string")
        doomed = {r[0] for r in names.filter(condition if by_rule else period_condition(column, condition, day)).collect()}
    for value, name in fresh.items():
        if value in there and value not in doomed:
            staged.child(name).pour_into(target.child(there[value]))
        else:
            staged.child(name).replace(target.child(there.get(value, name)))
    for value in doomed - fresh.keys():
        target.child(there[value]).remove()
    staged.remove()
    return Replaced(tuple(sorted(doomed)), tuple(sorted(fresh)))


def replace_days(new: DataFrame, path: str, first: date, last: date) -> Replaced:
    """Replace the days from ``first`` to ``last`` of a Parquet mart (``year, month, day`` folders).

    Days of the range that the new rows do not have are removed; other days of the mart are not touched, and new rows
    outside the range replace their day as ``write_mart`` does. The rows are complete beside the mart before a day is moved.
    """
    spark = new.sparkSession
    target, staged = Folder(spark, path), Folder(spark, f"{path}__new-{uuid4().hex}")
    normalize_partitions(new).hint("rebalance", *MART_PARTITIONS).write.partitionBy(*MART_PARTITIONS).parquet(staged.path)
    fresh, there = _days(staged), _days(target)
    for name in fresh.values():
        staged.child(name).replace(target.child(name))
    removed = [day for day in there if f"{first:%Y-%m-%d}" <= day <= f"{last:%Y-%m-%d}" and day not in fresh]
    for day in removed:
        target.child(there[day]).remove()
    staged.remove()
    return Replaced(tuple(removed), tuple(sorted(fresh)))


def _days(folder: Folder) -> dict[str, str]:
    """``yyyy-mm-dd`` to ``year=/month=/day=`` of the partitions below, in order."""
    found = {}
    for year in folder.names():
        for month in folder.child(year).names() if year.startswith("year=") else []:
            for day in folder.child(f"{year}/{month}").names():
                values = [part.partition("=")[2] for part in (year, month, day)]
                found["-".join(values)] = f"{year}/{month}/{day}"
    return found


def partition_listing(spark: SparkSession, path: str) -> DataFrame:
    """``partition, files, bytes`` of every folder that holds files."""
    sums: dict[str, list[int]] = {}
    for name, (size, _) in Folder(spark, path).files().items():
        entry = sums.setdefault(name.rpartition("/")[0], [0, 0])
        entry[0] += 1
        entry[1] += size
    rows = [(name, *entry) for name, entry in sorted(sums.items())]
    return spark.createDataFrame(rows, "partition string, files bigint, bytes bigint")


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A target with its partition columns kept as text."""
    kept = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", kept)
