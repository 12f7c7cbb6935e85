"""A table migration as one declarative step, and its header/detail patterns."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.operators.lookups import Lookup, remap, resolve
from farelane.operators.numbering import best_per_key


def audit_columns(run_at: datetime, creator: int | None = None) -> dict[str, Column]:
    """Audit columns of a migrated row; the run time is an argument so a re-run repeats."""
    return {
        "creation_time": F.lit(run_at).cast("timestamp_ntz"),
        "creator_user_id": F.lit(creator).cast("bigint"),
        "last_modification_time": F.lit(None).cast("timestamp_ntz"),
        "last_modifier_user_id": F.lit(None).cast("bigint"),
        "is_deleted": F.lit(0),
        "deleter_user_id": F.lit(None).cast("bigint"),
        "deletion_time": F.lit(None).cast("timestamp_ntz"),
    }


@dataclass
class Migration:
    """Key map, lookups, scalar rules and audit columns of one target table.

    ``columns`` maps each target column to an expression over the remapped and looked
    up source row.
    """

    columns: dict[str, Column | str]
    key_column: str | None = None
    key_out: str = "person_id"
    key_join: str = "inner"
    lookups: list[Lookup] = field(default_factory=list)
    run_at: datetime | None = None
    creator: int | None = None

    def apply(self, source: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """The target rows; ``keys`` is the old-to-new id map."""
        rows = source
        if self.key_column is not None:
            rows = remap(rows, keys, self.key_column, self.key_out, self.key_join)
        rows = resolve(rows, self.lookups)
        chosen = [(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in self.columns.items()]
        audit = audit_columns(self.run_at, self.creator) if self.run_at else {}
        return rows.select(*chosen, *[c.alias(name) for name, c in audit.items()])


def header_detail_count(headers: DataFrame, details: DataFrame, key: str, out: str) -> DataFrame:
    """Headers with the number of their details, zero without any."""
    counts = details.groupBy(key).agg(F.count("*").alias(out))
    return headers.join(counts, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))


def link_to_headers(details: DataFrame, headers: DataFrame, strict: list[str], null_safe: list[str], out: str) -> DataFrame:
    """Id of the header each detail belongs to, matched on its attributes.

    ``strict`` attributes need equal non-NULL values; two NULLs match on the others.
    """
    h = headers.select(F.col("id").alias(out), *[F.col(c).alias(f"_h_{c}") for c in [*strict, *null_safe]])
    on = [details[c] == F.col(f"_h_{c}") for c in strict] + [details[c].eqNullSafe(F.col(f"_h_{c}")) for c in null_safe]
    return details.join(h, on).drop(*[f"_h_{c}" for c in [*strict, *null_safe]])


def id_map(legacy: DataFrame, new: DataFrame, on: list[str], old_id: str, new_id: str) -> DataFrame:
    """One new id per old id: the smallest new id among the matches on the attributes."""
    smallest = best_per_key(new.select(*on, new_id), on, [F.col(new_id)], newest=False)
    return legacy.select(*on, old_id).join(smallest, on).select(F.col(old_id).alias("old_id"), F.col(new_id).alias("new_id"))
