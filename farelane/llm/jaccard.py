"""Operator 5: exact Jaccard join of documents in their metric space.

1. Documents with equal shingle sets are one point, its smallest id stands for it.
2. Pivots: the points that share a MinHash value elect the smallest of them. Each point's exact distance to the
   pivots it meets gives its Voronoi cell (the nearest pivot within the radius) and links; linked cells form classes.
3. Windows: a document is copied to the region of each of its rarest shingles that a document within the radius
   cannot all lack (the prefix). Unrelated documents are all at distance 1 from each other, so a window
   on distances to document pivots alone would copy every document to every region; the
   shingle decides which regions can meet, and the triangle inequality then drops pairs by
   their cells: d(x, y) >= d(p, q) - d(x, p) - d(y, q).
   The rarity order comes from a count sketch whose size follows the corpus, up to ``MOST_BITS``.
4. Only pairs of different classes matter for components. In each region the smallest document
   of every class meets that of the first class; links merge classes, and this is repeated while it finds links.
5. Regions that still hold many classes are joined recursively: their documents alone get an exact rarity order and new
   regions; a document of which too few shingles occur in any other leaves. What is left are pairs of different classes that meet in as
   many regions as their sizes ask of linked documents (the prefixes are longer by ``SHARED``); all of them are verified.

Nothing is capped: a region that stays large is verified pair by pair in step 5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, sliced, stored
from farelane.llm.components import components
from farelane.llm.shingles import least_hashes, shingle_sets

SEEDS = [0x1B873593A5A5A5A5, 0x85EBCA6B5C5C5C5C, 0xC2B2AE3569696969, 0x27D4EB2F3C3C3C3C]
SHARED = 4  # shingles that the prefixes of two linked documents share at least, if they have that many to share
BROADCAST_TOKENS = 3_000_000  # longs that are sent whole to every executor
CELL_WORDS, LEAST_BITS, MOST_BITS = 64, 16, 22  # words of the corpus for each cell of the frequency sketch, which orders shingles by rarity
CHUNK_BITS = 14  # cells of the sketch that are summed together
REGION_POINTS = 64  # in a region with more points classes are merged by their first points before all pairs are made
REGION_CLASSES = 32  # a region with more classes is split again
Batches = Iterator[pa.RecordBatch]


def _signatures(width: int, bits: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in sliced(batches):
            sets = list(shingle_sets(batch.column("text"), width))
            if any(len(s) for s in sets):
                np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
            yield _signed(
                batch.column("doc_id").to_pylist(), [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                [least_hashes(s, SEEDS) if len(s) else None for s in sets], [None] * len(sets),
            )
        chunks = counts.reshape(-1, 1 << CHUNK_BITS)
        for i in np.flatnonzero(chunks.any(axis=1)):
            yield _signed([int(i)], [-1], [None], [None], [_narrow(chunks[i]).tobytes()])

    return run


def _signed(ids: list, sizes: list, digests: list, least: list, counts: list) -> pa.RecordBatch:
    return pa.record_batch({
        "doc_id": pa.array(ids, pa.int64()), "n_shingles": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()),
        "least": pa.array(least, pa.list_(pa.int64())), "counts": pa.array(counts, pa.binary()),
    })


def _narrow(counts: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest count needs; ``_wide`` tells the type from the length."""
    return counts.astype(np.min_scalar_type(int(counts.max())))


def _wide(counts: bytes) -> np.ndarray:
    return np.frombuffer(counts, f"u{len(counts) >> CHUNK_BITS}").astype(np.int64)


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(1 << CHUNK_BITS, np.int64)
    for counts in group["counts"]:
        total += _wide(counts.as_py())
    return pa.table({"chunk": group["chunk"][:1], "counts": pa.array([_narrow(total).tobytes()], pa.binary())})


def _sets(width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "shingles": pa.array(sets, pa.large_binary()).cast(pa.binary())})

    return run


def _prefixes(width: int, percent: int, bits: int, sketch: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            tokens = []
            for s in shingle_sets(batch.column("text"), width):
                order = np.lexsort((s, sketch[(s >> np.uint64(64 - bits)).astype(np.int64)]))
                tokens.append(s[order[: len(s) - (percent * len(s) + 99) // 100 + SHARED]].view(np.int64))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "tokens": pa.array(tokens, pa.list_(pa.int64()))})

    return run


def _measure(batches: Batches) -> Batches:
    for batch in sliced(batches):
        shared, size = [], []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            n = len(np.intersect1d(left, right, assume_unique=True))
            shared.append(n)
            size.append(len(left) + len(right) - n)
        yield pa.record_batch({
            "a": batch.column("a"), "b": batch.column("b"), "shared": pa.array(shared, pa.int64()), "united": pa.array(size, pa.int64()),
        })


class JaccardJoin:
    """One join; ``points`` are ``doc_id, text`` with distinct ids."""

    def __init__(self, documents: DataFrame, percent: int, width: int):
        self.texts, self.percent, self.width = documents.select("doc_id", "text"), percent, width

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """``doc_id, shingles`` of the documents ``doc_id``."""
        texts = self.texts.join(sent_if_small(stored(ids.distinct(), "ids")), "doc_id", "left_semi")
        return stored(texts.mapInArrow(_sets(self.width), "doc_id long, shingles binary"), "sets")

    def distances(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """``a, b, shared, united`` of the pairs ``a, b``."""
        left = sets.toDF("a", "x").join(sent_if_small(stored(pairs, "pairs")), "a")
        both = left.join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
        return stored(both.mapInArrow(_measure, "a long, b long, shared long, united long"), "distances")

    def near(self, measured: DataFrame) -> DataFrame:
        return measured.filter(F.col("shared") * 100 >= F.col("united") * self.percent)

    def run(self) -> tuple[DataFrame, DataFrame]:
        """(``doc_id, n_shingles, point``; ``point, class``)."""
        # Twice as many documents get twice as many cells, up to a sketch of some MB; a word takes six characters or so.
        characters = self.texts.agg(F.sum(F.length("text"))).first()[0] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, (characters // (6 * CELL_WORDS)).bit_length()))
        signed = stored(self.texts.mapInArrow(
            _signatures(self.width, bits), "doc_id long, n_shingles long, digest binary, least array<long>, counts binary"
        ), "signatures")
        parts = signed.filter("n_shingles < 0").select(F.col("doc_id").alias("chunk"), "counts").groupBy("chunk")
        sketch = np.zeros((1 << bits - CHUNK_BITS, 1 << CHUNK_BITS), np.uint32)
        for chunk, counts in parts.applyInArrow(_summed, "chunk long, counts binary").collect():
            sketch[chunk] = np.minimum(_wide(counts), 2**32 - 1)
        signed = signed.filter("n_shingles >= 0").drop("counts")
        same = signed.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("point"), F.first("n_shingles").alias("n"), F.first("least").alias("least"))
        points = stored(same, "points")
        members = signed.join(points.select("digest", "point"), "digest", "left").select("doc_id", "n_shingles", "point")

        links, cells = self._elect(points)
        classes = _merged(points.select("point").distinct().select("point", F.col("point").alias("class")), links)
        regions = self._regions(points, classes, _prefixes(self.width, self.percent, bits, sketch.ravel()))
        sets = None
        while True:  # in regions with many points, the first of each class
            mixed = self._mixed(regions, classes)
            busy = stored(mixed.groupBy("token").agg(F.count("*").alias("k")).filter(F.col("k") > REGION_POINTS).select("token"), "busy")
            if busy.isEmpty():
                break
            crowd = mixed.join(sent_if_small(busy), "token")
            sets = sets or self.sets_of(crowd.select(F.col("point").alias("doc_id")))
            heads = crowd.groupBy("token", "class").agg(F.min(F.struct("point", "n")).alias("head"))
            lead = heads.groupBy("token").agg(F.min(F.struct("class", "head")).alias("lead"))
            pairs = heads.join(lead, "token").filter(F.col("class") != F.col("lead.class")).select(
                F.col("lead.head.point").alias("a"), F.col("lead.head.n").alias("na"), F.col("head.point").alias("b"), F.col("head.n").alias("nb")
            )
            found = self.near(self.distances(self._ordered(pairs).select("a", "b").distinct(), sets)).select("a", "b")
            if found.isEmpty():
                break
            classes = _merged(classes, found)
        large = stored(mixed.groupBy("token").agg(F.countDistinct("class").alias("k")).filter(F.col("k") > REGION_CLASSES), "large")
        kept = mixed.join(sent_if_small(large.select("token")), "token", "left_anti")
        pairs = self._sharing(kept.withColumn("most", F.col("n")))
        if not large.isEmpty():
            pairs = pairs.union(self._sharing(self._split(mixed.join(sent_if_small(large.select("token")), "token"), classes))).distinct()
        return members, _merged(classes, self._verified_by_cells(pairs, cells))

    def _ordered(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the smaller id first, whose sizes allow the similarity; ``most`` is the larger size."""
        fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent
        return pairs.filter(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.greatest("na", "nb").alias("most"))

    def _sharing(self, regions: DataFrame) -> DataFrame:
        """Pairs of different classes that meet in as many regions as linked documents must.

        ``regions`` are ``token, place, point, n, class, most``: a set of ``n`` shingles shares ``most`` with others at the outside.
        Of the shingles that linked sets share, the k-th in the common order has all but k of them behind it, in both sets. So the
        first ``SHARED`` stand early enough in both, and points meet at those places only: common shingles, which stand late, make no pairs.
        """
        counted = regions.groupBy("point", "n").agg(F.count("*").alias("k"))
        counted = counted.filter(F.col("k") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * self.percent / 100)))
        regions = stored(regions.join(sent_if_small(stored(counted, "met")), ["point", "n"]), "met_regions")
        shared, needed = self._needed(F.col("l.n"), F.col("r.n"))
        left, right = regions.alias("l"), regions.alias("r")
        first = F.least(F.lit(SHARED), shared)
        # Where both have much of their own, as documents around one passage have, they can't link and do not meet.
        met = left.join(right, (F.col("l.token") == F.col("r.token")) & (F.col("l.point") < F.col("r.point")) & (F.col("l.class") != F.col("r.class")) & (
            F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * self.percent
        ) & (F.least("l.most", "r.most") >= shared) & (F.least("l.k", "r.k") >= needed)
            & (F.greatest(F.col("l.place") - F.col("l.n"), F.col("r.place") - F.col("r.n")) < first - shared))
        pairs = met.groupBy(F.col("l.point").alias("a"), F.col("l.n").alias("na"), F.col("r.point").alias("b"), F.col("r.n").alias("nb")).agg(F.count("*").alias("k"))
        shared, needed = self._needed(F.col("na"), F.col("nb"))
        some = stored(pairs.filter(F.col("k") >= F.least(F.lit(SHARED), shared)).select("a", "na", "b", "nb", needed.alias("needed")), "meeting")
        tokens = regions.groupBy("point", "n").agg(F.collect_set("token").alias("t"))
        both = some.join(tokens.toDF("a", "na", "x"), ["a", "na"]).join(tokens.toDF("b", "nb", "y"), ["b", "nb"])
        return both.filter(F.size(F.array_intersect("x", "y")) >= F.col("needed")).select("a", "b").distinct()

    def _needed(self, a: Column, b: Column) -> tuple[Column, Column]:
        """How many shingles linked sets of ``a`` and ``b`` shingles share, and how many their prefixes share.

        The prefix that ends first in the common order lacks at most what its set does not share, and all that it shares lies in the other.
        """
        shared = F.ceil((a + b) * self.percent / (100 + self.percent) - 1e-9)
        own = F.ceil(F.greatest(a, b) * self.percent / 100)
        return shared, F.least(shared, shared - own + SHARED)

    def _elect(self, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links of points to pivots, and each linked point's cell: ``point, pivot, away`` (nearest pivot and distance)."""
        spread = points.select("point", "n", F.posexplode("least").alias("i", "value"))
        elected = spread.groupBy("i", "value").agg(F.min(F.struct("point", "n")).alias("p"), F.count("*").alias("k")).filter("k > 1")
        pairs = spread.join(elected, ["i", "value"]).filter(F.col("point") != F.col("p.point")).select(
            F.col("point").alias("b"), F.col("n").alias("nb"), F.col("p.point").alias("a"), F.col("p.n").alias("na")
        )
        pairs = stored(self._ordered(pairs).select("a", "b").distinct(), "elected")
        sets = self.sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
        measured = self.distances(pairs, sets)
        near = self.near(measured)
        away = 1 - F.col("shared") / F.col("united")
        cells = near.groupBy(F.col("b").alias("point")).agg(F.min(F.struct(away.alias("away"), F.col("a").alias("pivot"))).alias("c"))
        return near.select("a", "b"), cells.select("point", "c.pivot", "c.away")

    def _regions(self, points: DataFrame, classes: DataFrame, prefixes: Callable[[Batches], Batches]) -> DataFrame:
        """``token, place, point, n`` of all tokens (and their places in the point's order) that points of several classes have in their prefixes."""
        tokens = stored(self.texts.mapInArrow(prefixes, "doc_id long, tokens array<long>"), "prefixes")
        told = tokens.join(sent_if_small(points.select("point", "n").join(classes, "point").withColumnRenamed("point", "doc_id"), 1_000_000), "doc_id")
        own = told.select(F.col("doc_id").alias("point"), "n", "class", F.posexplode("tokens").alias("place", "token"))
        several = own.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("token")
        return stored(own.join(sent_if_small(stored(several, "shared"), BROADCAST_TOKENS), "token").select("token", "place", "point", "n"), "regions")

    def _mixed(self, regions: DataFrame, classes: DataFrame) -> DataFrame:
        """Regions with points of several classes: ``token, place, point, n, class``."""
        told = regions.join(classes, "point")
        several = told.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("token")
        return stored(told.join(several, "token").select("token", "place", "point", "n", "class"), "mixed")

    def _split(self, crowded: DataFrame, classes: DataFrame) -> DataFrame:
        """Regions for the points of large regions, with exact rarity among those points."""
        points = stored(crowded.select("point").distinct(), "split_points")
        texts = self.texts.join(sent_if_small(points.select(F.col("point").alias("doc_id"))), "doc_id", "left_semi")
        sets = stored(texts.mapInArrow(_all_tokens(self.width), "doc_id long, tokens array<long>"), "split_sets")
        # An id that comes with several texts has several sets here.
        spread = sets.select(F.col("doc_id").alias("point"), F.size("tokens").alias("n"), F.xxhash64("tokens").alias("own"), F.explode("tokens").alias("token"))
        count = spread.groupBy("token").agg(F.count("*").alias("k"))
        ordered = spread.join(count, "token").groupBy("point", "n", "own").agg(F.array_sort(F.collect_set(F.struct("k", "token"))).alias("t"))
        shared = F.size(F.filter("t", lambda t: t["k"] > 1))
        window = F.col("n") - F.ceil(F.col("n") * F.lit(self.percent) / 100).cast("int") + SHARED
        able = ordered.filter(shared * 100 >= F.col("n") * self.percent)  # the others can't link with any point of the crowd
        own = able.select("point", "n", shared.alias("most"), F.posexplode(F.slice("t", F.lit(1), window)).alias("place", "t")).filter("t.k > 1")
        return stored(own.select("*", "t.token").join(classes, "point").select("token", "place", "point", "n", "class", "most"), "split")

    def _verified_by_cells(self, pairs: DataFrame, cells: DataFrame) -> DataFrame:
        """Links among the pairs: their cells' pivots are measured first, the triangle inequality drops the rest."""
        home = lambda end, name: cells.select(
            F.col("point").alias(end), F.col("pivot").alias(f"{name}_pivot"), F.col("away").alias(f"{name}_away")
        )
        placed = pairs.join(sent_if_small(home("a", "a")), "a", "left").join(sent_if_small(home("b", "b")), "b", "left").select(
            "a", "b", F.coalesce("a_pivot", "a").alias("p"), F.coalesce("b_pivot", "b").alias("q"),
            (F.coalesce("a_away", F.lit(0.0)) + F.coalesce("b_away", F.lit(0.0))).alias("away"),
        ).withColumns({"p": F.least("p", "q"), "q": F.greatest("p", "q")})
        placed = stored(placed, "placed")
        sets = self.sets_of(placed.select(F.explode(F.array("a", "b", "p", "q")).alias("doc_id")))
        ends = placed.filter("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
        measured = self.distances(ends, sets)
        apart = measured.select(F.col("a").alias("p"), F.col("b").alias("q"), (1 - F.col("shared") / F.col("united")).alias("d"))
        radius = 1 - self.percent / 100
        open_pairs = placed.join(apart, ["p", "q"], "left").filter(
            (F.col("away") > 0) & (F.col("d").isNull() | (F.col("d") - F.col("away") <= radius + 1e-9))
        )
        close = self.near(measured).select("a", "b")
        return close.union(self.near(self.distances(open_pairs.select("a", "b").distinct(), sets)).select("a", "b"))


def _all_tokens(width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"), width)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "tokens": pa.array(sets, pa.list_(pa.int64()))})

    return run


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``point, class`` after links ``a, b`` of points; a class is named after its smallest point."""
    left = links.join(classes.toDF("a", "x"), "a").join(classes.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = components(left).toDF("class", "whole")
    return stored(classes.join(sent_if_small(found), "class", "left").select("point", F.coalesce("whole", "class").alias("class")), "classes")


def jaccard_components(documents: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_shingles, component_id``.

    Two documents link when 100 * intersection >= ``percent`` * union of their shingle sets. Null and empty
    texts have no shingles and link with nothing. Rows that repeat an id are one document that
    has the links of all its texts; each row is returned. Rows without an id are left out.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    members, classes = JaccardJoin(rows, percent, width).run()
    members = members.withColumn("point", F.coalesce("point", "doc_id"))
    named = members.join(sent_if_small(classes, 1_000_000), "point", "left").withColumn("class", F.coalesce("class", "point"))
    repeated = named.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("k")).filter("k > 1 AND a <> b")
    repeated = stored(repeated.select("a", "b").union(repeated.select("doc_id", "a")), "repeated_ids")
    if not repeated.isEmpty():
        found = components(repeated).toDF("class", "whole")
        named = named.join(sent_if_small(found), "class", "left").withColumn("class", F.coalesce("whole", "class"))
    return named.select("doc_id", "n_shingles", F.col("class").alias("component_id"))
