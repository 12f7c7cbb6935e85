"""Operator 12: how far the sources of a language diverge, from exact sparse count vectors.

Each language has a count-vector model of its own: its vocabulary are the terms in at least ``min_df`` of its documents, as
many as a whole number can index. A document's vector holds its terms with their counts. Tasks build those vectors and add
them up per (lang, source) like a vector summarizer; Spark adds the partial sums. Spark's own CountVectorizer gathers each
vocabulary in the driver and sends it to all tasks; as the vocabulary grows with the corpus, it is a table here instead.

Terms are smoothed to ``p = 1 + floor(SCALE * (count + 2) / (N + 2 * V))`` and two sides compared by
``f = floor((p - q)^2 / (p + q))``, all in whole numbers. Pairs of sources are evaluated sparsely. With ``z`` for the p of
a term that a group lacks, the sum over all V terms is
``V * f(z, z) + sum over a's terms (f(p, z) - f(z, z)) + the same for b + sum over shared terms (f(p, q) - f(p, z) - f(z, q) + f(z, z))``,
and since p depends on the count alone, equal counts (or pairs of counts) are evaluated once with their number.

Defined cases: null text, lang and source count as empty strings; every row is a document, also repeated ones and those
without an id; a group without terms has p = z for each term; a language without kept terms has value 0 for its pairs and no
term rows; a source alone in its language has no pairs; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, sliced, stored

SCALE = 1_000_000_000
# Letters are A-Z, a-z and all that is not ASCII; A-Z become a-z, the rest divides terms.
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
HELD_TERMS = 250_000  # sums that a task holds before it passes them on
LONG_SAFE = 9_000_000_000  # counts below this, times SCALE, fit a long
Batches = Iterator[pa.RecordBatch]


def terms(text: str | None) -> list[bytes]:
    """Terms of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def _summed(batches: Batches) -> Batches:
    """Group sums of the documents' count vectors, and of their 0/1 vectors."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    documents: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def passed_on() -> Batches:
        for (lang, source), total in counts.items():
            own = documents[lang, source]
            n = len(total)
            yield pa.record_batch({
                "lang": pa.repeat(lang, n), "source": pa.repeat(source, n), "term": pa.array(list(total), pa.binary()).cast(pa.string()),
                "df": pa.array([own[t] for t in total], pa.int64()), "tf": pa.array(list(total.values()), pa.int64()),
            })
        counts.clear()
        documents.clear()

    held = 0
    for batch in sliced(batches, 200):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            found = terms(text)
            vector = set(found)
            if not vector:
                continue
            total = counts[lang, source]
            held -= len(total)
            total.update(found)
            documents[lang, source].update(vector)
            held += len(total)
        if held > HELD_TERMS:
            yield from passed_on()
            held = 0
    yield from passed_on()


def group_sums(documents: DataFrame) -> DataFrame:
    """``lang, source, term, df, tf``: in how many documents of the group a term is, and how often."""
    rows = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = rows.filter("text <> ''").mapInArrow(_summed, "lang string, source string, term string, df long, tf long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def vocabulary(sums: DataFrame, min_df: int) -> DataFrame:
    """``lang, term, total`` and ``sources`` (those that have the term, in order, with its count ``c``) of the kept terms."""
    return (
        sums.groupBy("lang", "term")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("total"), F.collect_list(F.struct("source", F.col("tf").alias("c"))).alias("sources"))
        .filter(F.col("df") >= min_df)
        .select("lang", "term", "total", F.array_sort("sources").alias("sources"))
    )


def smoothed(count: Column, n: Column, v: Column) -> Column:
    """p of a count; whole-number arithmetic that can't overflow."""
    below = n + 2 * v
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    exact = F.call_function("div", wide, F.nullif(below, F.lit(0)).cast("decimal(20,0)"))
    return 1 + F.when(count < LONG_SAFE, F.call_function("div", (count + 2) * F.lit(SCALE).cast("long"), F.nullif(below, F.lit(0)))).otherwise(exact)


def apart(p: Column, q: Column) -> Column:
    """f of two smoothed counts."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _groups(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, n, v`` of every group that occurs, and ``zero``, its p of a term that it lacks."""
    every = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.c").alias("n"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    found = every.join(sizes, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["n", "v", "lang_n"])
    return found.withColumn("zero", smoothed(F.lit(0).cast("long"), F.col("n"), F.col("v")))


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language, both ways round."""
    own = groups.select("lang", "source", "n", "v", "zero")
    other = groups.select("lang", F.col("source").alias("item"), F.col("n").alias("m"), F.col("zero").alias("none"))
    own, other = sent_if_small(own), sent_if_small(other)
    none = apart(F.col("zero"), F.col("none"))
    base = own.join(other, "lang").filter("source <> item").select("lang", "source", "item", F.coalesce(F.col("v") * none, F.lit(0)).alias("value"))

    alone = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", "s.source", "s.c").agg(F.count("*").alias("times"))
    alone = alone.join(own, ["lang", "source"]).withColumn("p", smoothed(F.col("c"), F.col("n"), F.col("v")))
    alone = alone.join(other, "lang").filter("source <> item")
    one_way = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * (apart(F.col("p"), F.col("none")) - none)).alias("value"))

    # Each two sources that share a term, the first in order first.
    later = F.transform("sources", lambda x, i: F.transform(
        F.slice("sources", i + 2, F.size("sources")), lambda y: F.struct(x["source"].alias("source"), x["c"].alias("c"), y["source"].alias("item"), y["c"].alias("d"))
    ))
    shared = kept.filter(F.size("sources") > 1).select("lang", F.explode(F.flatten(later)).alias("s"))
    shared = shared.groupBy("lang", "s.source", "s.item", "s.c", "s.d").agg(F.count("*").alias("times"))
    shared = shared.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    shared = shared.withColumns({"p": smoothed(F.col("c"), F.col("n"), F.col("v")), "q": smoothed(F.col("d"), F.col("m"), F.col("v"))})
    gain = apart(F.col("p"), F.col("q")) - apart(F.col("p"), F.col("none")) - apart(F.col("zero"), F.col("q")) + none
    both = shared.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * gain).alias("value"))

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    parts = base.unionByName(one_way).unionByName(turned(one_way)).unionByName(both).unionByName(turned(both))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _leading(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that a group has more of than its language."""
    sizes = sent_if_small(groups.select("lang", "source", "n", "v", "lang_n"))
    each = kept.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "total", F.col("term").alias("item"), "s.source", "s.c")
    each = each.join(sizes, ["lang", "source"]).select(
        "lang", "source", "item", smoothed(F.col("c"), F.col("n"), F.col("v")).alias("p"), smoothed(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")
    )
    return each.filter("p > q").select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))


def divergence(documents: DataFrame, min_df: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of sources, and each group's ``top`` terms against its language."""
    kept = stored(vocabulary(stored(group_sums(documents), "group_sums"), min_df), "kept_terms")
    groups = stored(_groups(documents, kept), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(groups, kept).withColumn("rank", F.row_number().over(order))
    leading = _leading(groups, kept).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("part", F.lit("pair")).unionByName(leading.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank"
    )
