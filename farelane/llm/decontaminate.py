"""Operator 9: benchmark decontamination by a prefix-filtered set join, with built-in functions only.

A window is ``width`` consecutive words of an item, or the whole item if it is shorter. Words are
ordered by their counts over all documents. The rarest word of each window is its necessary prefix token
(an anchor): a document without it cannot hold the window. Documents' words join the anchors; the
position of an anchor in document and item gives a diagonal, on which item and
document would have to lie. Diagonals with too little room for a window are dropped (length and
position bounds), the others are verified word by word.

Defined cases: null texts have no words; items without words or without an id are left out; items
with the same words share their windows; repeated document rows each get a row. Other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, stored

# Fixed value: what separates words, as code point ranges (A-Z are word characters before lower-casing).
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text as written; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def item_table(benchmark: DataFrame, width: int) -> DataFrame:
    """``item`` (smallest id), ``ids``, ``item_words`` and ``m`` (window size) per distinct item text."""
    return (
        benchmark.filter(F.col("item_id").isNotNull())
        .select("item_id", words(ascii_lower(F.col("text"))).alias("item_words")).filter(F.size("item_words") > 0)
        .groupBy("item_words").agg(F.min("item_id").alias("item"), F.collect_set("item_id").alias("ids"))
        .withColumn("m", F.least(F.size("item_words"), F.lit(width)))
    )


def anchors(items: DataFrame, documents: DataFrame) -> DataFrame:
    """``token, item, at, length, m``: the rarest word of every window, once per place in the item."""
    places = items.select("item", "m", F.posexplode("item_words").alias("at", "word")).withColumn("token", F.lower("word"))
    tokens = sent_if_small(places.select("token").distinct())
    # Lower-casing beyond A-Z only merges tokens, so no window is missed; the check below is exact.
    seen = documents.select(F.explode(words(F.lower("text"))).alias("token")).join(tokens, "token").groupBy("token").agg(F.count("*").alias("n"))
    ranked = places.join(seen, "token", "left").groupBy("item", "m").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "token"))),
            lambda p: F.struct(p["n"].alias("n"), p["token"].alias("token"), p["at"].alias("at")),
        ).alias("ranked")
    )
    starts = F.sequence(F.lit(0), F.size("ranked") - F.col("m"))
    rarest = F.array_distinct(F.transform(starts, lambda s: F.array_min(F.slice("ranked", s + 1, F.col("m")))))
    return (
        ranked.select("item", "m", F.size("ranked").alias("length"), F.explode(rarest).alias("a"))
        .filter(F.col("a.n") > 0)  # a window with a word that no document has occurs nowhere
        .select(F.col("a.token").alias("token"), "item", F.col("a.at").alias("at"), "length", "m")
    )


def candidates(anchored: DataFrame, documents: DataFrame) -> DataFrame:
    """Distinct ``doc_id, item, diagonal`` (place in the document minus place in the item)."""
    spread = documents.select("doc_id", words(F.lower("text")).alias("w")).select(
        "doc_id", F.size("w").alias("n"), F.posexplode("w").alias("pos", "token")
    )
    diagonal = F.col("pos") - F.col("at")
    room = F.least(F.col("length"), F.col("n") - diagonal) - F.greatest(F.lit(0), -diagonal)
    return (
        spread.join(sent_if_small(anchored), "token")
        .filter(room >= F.col("m"))
        .select("doc_id", "item", diagonal.alias("diagonal")).distinct()
    )


def _runs(words_column: str) -> Column:
    """Ranges (start, length) of the document that windows of ``c`` cover on its diagonal."""

    def of(c: Column) -> Column:
        low = F.greatest(F.lit(0), -c["diagonal"])
        room = F.greatest(F.least(F.size(c["item_words"]), F.size(words_column) - c["diagonal"]) - low, F.lit(0))
        same = F.zip_with(
            F.slice(c["item_words"], low + 1, room), F.slice(words_column, low + c["diagonal"] + 1, room),
            lambda a, b: F.when(a == b, "1").otherwise("0"),
        )
        return F.aggregate(
            F.split(F.array_join(same, ""), "0", -1),
            F.struct((low + c["diagonal"]).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("found")),
            lambda a, run: F.struct(
                (a["at"] + F.length(run) + 1).alias("at"),
                F.when(F.length(run) >= c["m"], F.concat(a["found"], F.array(F.struct(a["at"].alias("start"), F.length(run).alias("length")))))
                .otherwise(a["found"]).alias("found"),
            ),
            lambda a: a["found"],
        )

    return F.transform("c", lambda c: F.struct(c["ids"].alias("ids"), of(c).alias("found")))


def hits(documents: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """All rows of ``documents`` with ``n_words``, ``ranges`` (start, length of hit words) and ``item_ids``."""
    items = stored(item_table(benchmark, width), "items")
    anchored = stored(anchors(items, documents), "anchors")
    found = candidates(anchored, documents).join(sent_if_small(items), "item").groupBy("doc_id").agg(
        F.collect_list(F.struct("diagonal", "item_words", "m", "ids")).alias("c")
    )
    checked = (
        documents.join(found.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
        .withColumn("w", F.when(F.col("c").isNull(), words(F.col("text"))).otherwise(words(ascii_lower(F.col("text")))))
        .withColumn("hit", F.filter(_runs("w"), lambda h: F.size(h["found"]) > 0))
    )
    none = F.array().cast("array<struct<start:int,length:int>>")
    ids = F.array_distinct(F.flatten(F.transform("hit", lambda h: h["ids"])))
    return checked.select(
        *documents.columns, F.size("w").cast("long").alias("n_words"),
        F.coalesce(F.array_distinct(F.flatten(F.transform("hit", lambda h: h["found"]))), none).alias("ranges"),
        F.coalesce(ids, F.array().cast("array<bigint>")).alias("item_ids"),
    )


def report(documents: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per document: ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    marked = hits(documents.select("doc_id", "text"), benchmark.select("item_id", "text"), width)
    covered = F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1))))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return marked.withColumn("n_hit", F.size(covered).cast("long")).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Rows of ``documents`` in which no window occurs, with the same columns."""
    plain = documents.select("doc_id", "text", F.struct(*documents.columns).alias("row"))
    marked = hits(plain, benchmark.select("item_id", "text"), width)
    return marked.filter(F.size("ranges") == 0).select(*[F.col("row")[c].alias(c) for c in documents.columns])
