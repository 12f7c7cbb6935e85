"""Emptying several tables in order, all of them or none.

Each table is a Parquet folder. Clearing sets the folder aside and puts an empty one with the same columns in its place, which
is a rename however large the table is. A journal beside the shared folder names every step before it is taken; after a
failure, or a driver that died, ``undo`` puts everything back from it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators.load import clear_order
from farelane.operators.partitions import Folder
from farelane.session import scratch_path

CLEARED = "table_name string, step int, rows_deleted bigint, rows_left bigint"


class Journal:
    """What a clearing run set aside: one small file per step, so that no write ever changes an earlier entry."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def note(self, number: int, table: str, path: str, aside: str) -> None:
        """Write an entry; it is complete when its folder has the writer's success mark."""
        entry = json.dumps({"number": number, "table": table, "path": path, "aside": aside})
        self.spark.createDataFrame([(entry,)], "value string").coalesce(1).write.text(f"{self.path}/{number:06d}")

    def entries(self) -> list[dict]:
        """All complete entries, newest first."""
        folder, found = Folder(self.spark, self.path), []
        for name in folder.names():
            if "_SUCCESS" in folder.child(name).names(hidden=True):
                found += [json.loads(r.value) for r in self.spark.read.text(f"{self.path}/{name}").collect()]
        return sorted(found, key=lambda e: -e["number"])

    def close(self) -> None:
        Folder(self.spark, self.path).remove()


def undo(spark: SparkSession, journal: str) -> list[str]:
    """Put back every table that the journal names, the last first; returns their names. Safe to repeat."""
    notes, back = Journal(spark, journal), []
    for entry in notes.entries():
        aside, place = Folder(spark, entry["aside"]), Folder(spark, entry["path"])
        if aside.exists():  # else the step was noted but not taken, or is undone already
            place.remove()
            if not aside.move_to(place):
                raise OSError(f"{entry['path']} could not be put back; its rows are in {entry['aside']}")
            back.append(entry["table"])
    notes.close()
    return back


def clear_tables(
    spark: SparkSession, tables: dict[str, str], references: DataFrame, journal: str | None = None,
    after_step: Callable[[str], None] | None = None,
) -> DataFrame:
    """Empty the tables (name to Parquet path), children before the tables they reference: all of them or none.

    ``references`` has a row for each (child, parent) pair of table names; pairs with tables that are not to be cleared may
    be among them, and then a table must not be left referenced: a child that stays is an error before anything is touched. Returns
    ``table_name, step, rows_deleted, rows_left`` in the order of clearing. ``after_step`` is called with each cleared table's
    name; if it, or any step, fails, all tables are put back and the error is raised again.
    """
    pairs = references.select("child", "parent").distinct()
    bound = [r for r in pairs.filter(F.col("parent").isin(list(tables)) & ~F.col("child").isin(list(tables))).collect()]
    if bound:
        raise ValueError("still referenced: " + ", ".join(sorted(f"{r.parent} by {r.child}" for r in bound)))
    among = pairs.filter(F.col("child").isin(list(tables)) & F.col("parent").isin(list(tables)))
    steps = {r.table_name: r.step for r in clear_order(spark, among).collect()}
    order = sorted(tables, key=lambda name: (steps.get(name, 1), name))
    before = {name: spark.read.parquet(tables[name]).count() for name in order}  # from the files' footers
    notes = Journal(spark, journal or scratch_path(spark, "clearing"))
    asides = {}
    try:
        for number, name in enumerate(order):
            place, aside = Folder(spark, tables[name]), Folder(spark, f"{tables[name]}__cleared-{uuid4().hex}")
            empty = Folder(spark, f"{tables[name]}__empty-{uuid4().hex}")
            spark.createDataFrame([], spark.read.parquet(place.path).schema).write.parquet(empty.path)
            notes.note(number, name, place.path, aside.path)
            if not place.move_to(aside):
                raise OSError(f"{place.path} could not be set aside")
            asides[name] = aside
            if not empty.move_to(place):
                raise OSError(f"{place.path} could not be emptied")
            if after_step:
                after_step(name)
    except BaseException:
        undo(spark, notes.path)
        raise
    rows = [(name, steps.get(name, 1), before[name], spark.read.parquet(tables[name]).count()) for name in order]
    notes.close()  # from here on the clearing stands
    for aside in asides.values():
        aside.remove()
    return spark.createDataFrame(rows, CLEARED)
