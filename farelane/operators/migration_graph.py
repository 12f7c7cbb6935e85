"""Whole-table migrations: declared steps, ordered by the tables and id maps that they need and make.

A step names its source, the maps it goes through, the dictionaries and code lists it resolves, the columns it makes and the
rows it links to. The graph sorts the steps, runs each once, and writes every target and id map to a folder, so that a later step
reads what an earlier one made and a lost executor never re-runs it. A name that nobody makes, or a circle, is an error
before any step runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from graphlib import CycleError, TopologicalSorter
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators.lookups import Lookup, key_map, resolve, resolve_code_list
from farelane.operators.migrate import audit_columns, link_to_headers
from farelane.operators.numbering import numbered
from farelane.operators.partitions import Folder


@dataclass(frozen=True)
class KeyMap:
    """Old id to new id through a business key that the legacy table and the new one carry.

    ``legacy`` and ``new`` name tables of the graph; rows meet with their keys as trimmed texts if ``as_text``. Several new rows
    with one key give the smallest new id.
    """

    legacy: str
    new: str
    legacy_id: str
    new_id: str
    legacy_key: str
    new_key: str
    as_text: bool = False

    def frame(self, tables: dict[str, DataFrame]) -> DataFrame:
        """``old_id, new_id``; each old id once."""
        old, new = tables[self.legacy], tables[self.new]
        if self.as_text:
            old = old.withColumn(self.legacy_key, F.trim(F.col(self.legacy_key).cast("string")))
            new = new.withColumn(self.new_key, F.trim(F.col(self.new_key).cast("string")))
        pairs = key_map(old, new, self.legacy_id, self.new_id, self.legacy_key, self.new_key)
        return pairs.groupBy("old_id").agg(F.min("new_id").alias("new_id"))


@dataclass(frozen=True)
class Through:
    """An old id column replaced by the new id of a map; rows without a match go (``inner``) or stay with NULL (``left``)."""

    map: str
    column: str
    out: str
    how: str = "inner"


@dataclass(frozen=True)
class Code:
    """A code column resolved against a dictionary table of the graph."""

    column: str
    dictionary: str
    out: str
    key: str = "code"
    value: str = "id"
    live_only: bool = False
    as_text: bool = False


@dataclass(frozen=True)
class CodeList:
    """A delimited list of codes resolved to a list of ids."""

    column: str
    dictionary: str
    out: str
    separators: str = ",;"
    by_position: bool = True
    key: str = "code"
    value: str = "id"


@dataclass(frozen=True)
class Link:
    """The header row that a source row belongs to, found by its attributes (source column to header column)."""

    headers: str
    strict: dict[str, str]
    null_safe: dict[str, str]
    out: str


@dataclass(frozen=True)
class Step:
    """One target table.

    In order: the source rows, ``prepared`` if given, ids through maps, codes, code lists, links, then ``columns`` (target column to
    SQL expression or column). ``distinct`` keeps one of equal rows before ids are given; ``id_column`` numbers the rows from 1 in the
    order of all columns. ``makes`` names an id map that the finished target gives.
    """

    target: str
    source: str
    columns: dict[str, Column | str]
    prepared: Callable[[DataFrame], DataFrame] | None = None
    through: list[Through] = field(default_factory=list)
    codes: list[Code] = field(default_factory=list)
    lists: list[CodeList] = field(default_factory=list)
    links: list[Link] = field(default_factory=list)
    distinct: bool = False
    id_column: str | None = None
    makes: dict[str, KeyMap] = field(default_factory=dict)
    audit: bool = True

    def needs(self) -> set[str]:
        """Names of tables and maps that must be there first."""
        own = {self.target, *self.makes}
        named = {self.source, *[t.map for t in self.through], *[c.dictionary for c in [*self.codes, *self.lists]], *[k.headers for k in self.links]}
        return (named | {t for m in self.makes.values() for t in (m.legacy, m.new)}) - own

    def rows(self, tables: dict[str, DataFrame], run_at: datetime) -> DataFrame:
        """The target's rows."""
        rows = tables[self.source]
        if self.prepared:
            rows = self.prepared(rows)
        for t in self.through:
            rows = rows.join(tables[t.map].toDF(t.column, t.out), t.column, t.how)
        rows = resolve(rows, [
            Lookup(c.column, tables[c.dictionary], c.out, c.key, c.value, c.live_only, c.as_text) for c in self.codes
        ])
        for c in self.lists:
            rows = resolve_code_list(rows, c.column, tables[c.dictionary], c.out, c.separators, c.by_position, c.key, c.value)
        for k in self.links:
            names = {**k.strict, **k.null_safe}
            headers = tables[k.headers].select("id", *[F.col(theirs).alias(ours) for ours, theirs in names.items()])
            rows = link_to_headers(rows, headers, list(k.strict), list(k.null_safe), k.out)
        rows = rows.select(*[(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in self.columns.items()])
        if self.distinct:
            rows = rows.distinct()
        if self.id_column:
            rows = numbered(rows, [F.col(f"`{c}`") for c in rows.columns], self.id_column)
        return rows.withColumns(audit_columns(run_at, 1)) if self.audit else rows


@dataclass(frozen=True)
class Graph:
    """Steps and the tables that are there before them."""

    steps: tuple[Step, ...]

    def order(self, given: set[str]) -> list[Step]:
        """Steps in an order in which each finds what it needs."""
        makers = {name: step for step in self.steps for name in (step.target, *step.makes)}
        twice = [n for n in makers if sum(n in (s.target, *s.makes) for s in self.steps) > 1]
        missing = sorted({n for s in self.steps for n in s.needs() if n not in makers and n not in given})
        if twice or missing:
            raise ValueError(f"made twice: {sorted(twice)}" if twice else f"nobody makes: {missing}")
        by_target = {s.target: s for s in self.steps}
        edges = {s.target: {makers[n].target for n in s.needs() if n in makers} for s in self.steps}
        try:
            return [by_target[t] for t in TopologicalSorter(edges).static_order()]
        except CycleError as fault:
            raise ValueError("the steps need each other in a circle: " + " -> ".join(fault.args[1])) from None

    def run(self, spark: SparkSession, given: dict[str, DataFrame], base: str, run_at: datetime) -> dict[str, DataFrame]:
        """Run all steps; every target and id map is written to ``<base>/<name>``, whole or not at all, and read back.

        Returns all tables by name. A second run into the same folder replaces the tables, so frames of an earlier one end.
        """
        tables = dict(given)

        def kept(name: str, df: DataFrame) -> None:
            staged = Folder(spark, f"{base}/.{name}-{uuid4().hex}")
            df.write.parquet(staged.path)
            staged.replace(Folder(spark, f"{base}/{name}"))
            tables[name] = spark.read.schema(df.schema).parquet(f"{base}/{name}")

        for step in self.order(set(given)):
            kept(step.target, step.rows(tables, run_at))
            for name, made in step.makes.items():
                kept(name, made.frame(tables))
        return tables
