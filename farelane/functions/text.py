"""Text, date-text and number clean-up used by the migration transforms and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# The two accepted date texts.
DAY_FIRST = r"^\d{2}/\d{2}/\d{4}$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def money(column: Column) -> Column:
    """An amount as ``decimal(18,2)``; always applied before a sum."""
    return column.cast(MONEY)


def typed_null(kind: str = MONEY) -> Column:
    """A NULL placeholder with a real type, so files and schemas stay readable."""
    return F.lit(None).cast(kind)


def route_of(plaza_name: Column) -> Column:
    """Second dash-separated part of a plaza name; NULL without a dash."""
    return F.get(F.split(plaza_name, r"\s*-\s*"), F.lit(1))


def normalize_date_text(text: Column) -> Column:
    """``dd/MM/yyyy`` rewritten as ISO, ISO kept as it is, anything else NULL.

    A day-first text that is no real date gives NULL.
    """
    parsed = F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))
    return F.when(text.rlike(DAY_FIRST), F.date_format(parsed, "yyyy-MM-dd")).when(text.rlike(ISO_DAY), text)


def day_first_timestamp(text: Column) -> Column:
    """``dd/MM/yyyy`` as a timestamp, anything else NULL."""
    parsed = F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))
    return F.when(text.rlike(DAY_FIRST), parsed.cast("timestamp_ntz"))


def has_letters(text: Column) -> Column:
    """Whether the text holds any letter, accented ones included."""
    return text.rlike(r"\p{L}")


def split_by_content(first: Column, second: Column) -> tuple[Column, Column]:
    """Route the first non-NULL text to (no letters, letters)."""
    value = F.coalesce(first, second)
    return F.when(~has_letters(value), value), F.when(has_letters(value), value)


def compose_text(separator: str, *parts: Column) -> Column:
    """Join texts, a NULL counting as empty and keeping its separators; NULL if all empty.

    Empty text is NULL in the source system, so a result can only be NULL when no
    separator is left over either.
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part, F.lit("")))
    return F.nullif(F.concat(*pieces), F.lit(""))


def lenient_number(text: Column, kind: str = "decimal(18,4)") -> Column:
    """A number, or NULL where the text is none."""
    return F.trim(text).try_cast(kind)


def or_zero(amount: Column) -> Column:
    """NULL as zero, for arithmetic."""
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def truncate_text(text: Column, width: int) -> Column:
    """The first ``width`` characters, to fit the target column."""
    return F.substring(text, 1, width)


def wrap_id(identifier: Column) -> Column:
    """One id as a list text ``[id]``; ``[]`` without an id."""
    return F.concat(F.lit("["), F.coalesce(identifier.cast("string"), F.lit("")), F.lit("]"))


def list_codes(text: Column, separators: str = ";") -> Column:
    """The non-empty codes of a delimited list, in order."""
    return F.filter(F.split(text, f"[{separators}]"), lambda code: code != "")


def list_text(ids: Column) -> Column:
    """Ids as one list text, ``[1,2]``."""
    return F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ","), F.lit("]"))
