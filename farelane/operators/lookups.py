"""Key remapping, dictionary lookups and delimited code lists for table migration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.text import list_codes, list_text

# Most rows of a dictionary that is sent whole to every executor (some tens of MB of codes and ids).
BROADCAST_ROWS = 200_000


def key_map(legacy: DataFrame, new: DataFrame, legacy_id: str, new_id: str, legacy_key: str, new_key: str,
            how: str = "inner") -> DataFrame:
    """``old_id -> new_id`` through the business key both tables carry."""
    old = legacy.select(F.col(legacy_id).alias("old_id"), F.col(legacy_key).alias("business_key"))
    target = new.select(F.col(new_id).alias("new_id"), F.col(new_key).alias("business_key"))
    return old.join(target, "business_key", how).select("old_id", "new_id")


def remap(rows: DataFrame, keys: DataFrame, column: str, out: str, how: str = "inner") -> DataFrame:
    """Replace an old id column by the new id of the key map."""
    return rows.join(keys.toDF(column, out), column, how).drop(column)


@dataclass(frozen=True)
class Lookup:
    """One code column resolved against a dictionary.

    ``column`` of the rows equals ``key`` of the dictionary (both as trimmed text when
    ``as_text``); ``value`` of the dictionary becomes ``out``. ``live_only`` drops
    deleted dictionary rows before the join, so a code of a deleted row gives NULL.
    """

    column: str
    dictionary: DataFrame
    out: str
    key: str = "code"
    value: str = "id"
    live_only: bool = False
    as_text: bool = False


def resolve(rows: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Left-join every lookup in turn; an unknown or NULL code gives NULL.

    Small dictionaries are counted and sent to the rows: a few codes would else deal all rows to a few tasks,
    as Spark can't size a dictionary that is derived from a large table. Larger ones are shuffled.
    """
    for n, lookup in enumerate(lookups):
        entries = lookup.dictionary
        if lookup.live_only:
            entries = entries.filter(F.col("is_deleted") == 0)
        entries = entries.select(_key(F.col(lookup.key), lookup).alias(f"_k{n}"), F.col(lookup.value).alias(lookup.out))
        rows = rows.join(_sent_if_small(entries), _key(rows[lookup.column], lookup) == F.col(f"_k{n}"), "left").drop(f"_k{n}")
    return rows


def _sent_if_small(entries: DataFrame) -> DataFrame:
    return F.broadcast(entries) if entries.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else entries


def _key(column: Column, lookup: Lookup) -> Column:
    return F.trim(column.cast("string")) if lookup.as_text else column


def explode_codes(rows: DataFrame, column: str, out: str, separators: str = ";") -> DataFrame:
    """One row per code of the list; a row without any code stays, with a NULL code."""
    return rows.withColumn(out, F.explode_outer(list_codes(F.col(column), separators))).drop(column)


def resolve_code_list(rows: DataFrame, column: str, dictionary: DataFrame, out: str, separators: str,
                      by_position: bool, live_key: str = "code", value: str = "id") -> DataFrame:
    """Turn a delimited code list into an id list text.

    ``by_position`` keeps one id per code in list order and gives ``[]`` when nothing
    matches; otherwise the ids are distinct, ordered by id, and NULL when nothing
    matches. Each distinct list text is resolved once and joined back on the text, so
    a text shared by very many rows costs one resolution.
    """
    texts = rows.select(F.col(column).alias("_text")).filter(F.col(column).isNotNull()).distinct()
    tokens = texts.select("_text", F.posexplode(list_codes(F.col("_text"), separators)).alias("_pos", "_code"))
    entries = dictionary.select(F.trim(F.col(live_key).cast("string")).alias("_code"), F.col(value).alias("_id"))
    matched = tokens.withColumn("_code", F.trim("_code")).join(entries, "_code")
    if by_position:
        ordered = F.array_sort(F.collect_list(F.struct("_pos", "_id")))
        ids = F.transform(ordered, lambda hit: hit["_id"])
    else:
        ids = F.array_sort(F.collect_set("_id"))
    lists = matched.groupBy("_text").agg(list_text(ids).alias(out))
    joined = rows.join(lists, rows[column] == lists["_text"], "left").drop("_text")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit("[]"))) if by_position else joined
