"""Operator 6: exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets. A query meets the buckets from the longest
vectors down. Its k-th best score so far, divided by the lengths of query and bucket, is the
cosine that a vector of the bucket must reach: above 1 the bucket and all after it are
skipped; a low value prunes by length alone; a high value prunes by the feasible interval of
the query's largest coordinates. What is left is verified with integer products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import stored

QUERY_ROWS = 1024  # queries in a cell of the grid
COLUMN_ROWS = 65536  # vectors in a cell
BUCKET_ROWS = 2048  # vectors in a bucket of a cell
COORDINATES = 3  # largest coordinates of a query that prune
COORDINATE_COSINE = 0.6  # from this local threshold on coordinates prune better than length
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id``, ``v`` (floor(scale * x) of each component) and ``norm``.

    A null id, a null vector, and vectors with a null or non-finite component are left out.
    Values beyond a long saturate. An empty vector is kept: all of its products are 0.
    """
    finite = ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        .filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & finite)
        .select("vec_id", F.transform("e", lambda x: F.floor(x * float(scale)).cast("long")).alias("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    )


def top_k(vectors: DataFrame, wanted: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """The ``k`` best of all other rows for every row for which ``wanted`` (over ``vec_id``) holds.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``. Vectors of
    different lengths are compared as if padded with zeros. ``vec_id`` identifies a row: of rows
    that share one, the first in the order of their vectors counts. Fewer than ``k`` other rows
    give fewer results; an empty table gives none.

    Queries and vectors meet in a grid of cells of bounded size; no cell ever holds a whole side.
    """
    clean = integer_vectors(vectors, scale).groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("x"))
    clean = clean.select("vec_id", "x.v", "x.norm")
    size = clean.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.max("norm").alias("m")).first()
    n, width = size["n"], size["d"] or 0
    columns = max(1, math.ceil(n / COLUMN_ROWS))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    placed = clean.withColumn("v", F.concat("v", zeros)).repartitionByRange(columns, F.desc("norm"), "vec_id")
    placed = stored(placed.withColumn("c", F.spark_partition_id()), "norm_order")
    ids = sorted(r["c"] for r in placed.select("c").distinct().collect())  # as many as partitions
    rows = max(1, math.ceil(n / QUERY_ROWS / 16))
    queries = placed.filter(wanted).select(
        "vec_id", "v", "norm", F.pmod(F.xxhash64("vec_id"), F.lit(rows)).cast("int").alias("r")
    )
    first, rest = ids[:1], ids[1:]
    found = _cells(placed, queries.withColumn("least", F.lit(None).cast("long")), first, rows, k)
    if rest:
        found = stored(found, "first_column")
        best = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s"))
        least = best.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("s")).alias("least"))
        found = found.union(_cells(placed, queries.join(least, "vec_id", "left"), rest, rows, k))
    merged = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best")
    )
    return merged.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )


def _cells(placed: DataFrame, queries: DataFrame, ids: list[int], rows: int, k: int) -> DataFrame:
    """Up to ``k`` best of every query in each cell of the given columns."""
    columns = F.array(*[F.lit(i) for i in ids]) if ids else F.array().cast("array<int>")
    every_row = F.sequence(F.lit(0), F.lit(rows - 1))
    vectors = placed.filter(F.col("c").isin(ids) if ids else F.lit(False)).select(
        "c", F.explode(every_row).alias("r"), F.lit(False).alias("query"), "vec_id", "v", "norm", F.lit(None).cast("long").alias("least")
    )
    asked = queries.select(F.explode(columns).alias("c"), "r", F.lit(True).alias("query"), "vec_id", "v", "norm", "least")
    return vectors.unionByName(asked).groupBy("c", "r").applyInArrow(lambda cell: _cell(cell, k), FOUND)


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table["v"].combine_chunks()
    flat = lists.flatten() if isinstance(lists, pa.ListArray) else pa.concat_arrays([x.flatten() for x in lists.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _cell(cell: pa.Table, k: int) -> pa.Table:
    is_query = cell["query"].to_numpy(zero_copy_only=False).astype(bool)
    asked, given = cell.filter(pa.array(is_query)), cell.filter(pa.array(~is_query))
    out: list[tuple] = []
    if asked.num_rows and given.num_rows:
        lengths = given["norm"].to_numpy()
        order = np.lexsort((given["vec_id"].to_numpy(), -lengths))
        found = search(
            _matrix(asked), asked["norm"].to_numpy(), asked["vec_id"].to_numpy(),
            [None if x is None else int(x) for x in asked["least"].to_pylist()],
            _matrix(given)[order], lengths[order], given["vec_id"].to_numpy()[order], k,
        )
        out = list(found)
    query, vec, score = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.int64())})


def _exact(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type in which all products are exact: doubles, or Python's integers."""
    top = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    kind = np.float64 if top < 2**53 else object
    return vectors.astype(kind), queries.astype(kind)


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer products; beyond a long they saturate."""
    whole = vectors @ query
    if whole.dtype == object:
        return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in whole], dtype=np.int64)
    return whole.astype(np.int64)


def search(
    queries: np.ndarray, query_norms: np.ndarray, query_ids: np.ndarray, least: list[int | None],
    vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """The best ``k`` (query, vector, score) of each query; ``vectors`` come longest first."""
    buckets = [slice(i, min(i + BUCKET_ROWS, len(ids))) for i in range(0, len(ids), BUCKET_ROWS)]
    safe = np.where(norms > 0, norms, 1.0)[:, None]
    unit = (vectors / safe).astype(np.float32)
    wide = unit.T.copy()  # a coordinate of all vectors lies together
    slack = 1e-4  # the pruning works on rounded cosines
    vectors, queries = _exact(vectors, queries)
    for query, norm, own, bound in zip(queries, query_norms, query_ids, least, strict=True):
        best_id, best = np.empty(0, np.int64), np.empty(0, np.int64)
        threshold = bound
        top = np.argsort(-np.abs(query), kind="stable")[:COORDINATES]
        for at in buckets:
            keep = None
            if threshold is not None and norm > 0:
                longest = float(norms[at.start])
                cosine = threshold / (norm * longest) if longest > 0 else (0.0 if threshold <= 0 else 2.0)
                if threshold > 0 and cosine > 1 + slack:
                    break  # later buckets are shorter still
                if threshold > 0 and cosine < COORDINATE_COSINE:
                    keep = np.flatnonzero(norms[at] * norm * (1 + slack) >= threshold)
                elif threshold > 0:
                    keep = np.arange(at.stop - at.start)
                    reach = min(1.0, cosine) - slack
                    for f in top:
                        q = float(query[f]) / norm
                        spread = math.sqrt(max(0.0, (1 - q * q) * (1 - reach * reach)))
                        low, high = q * reach - spread - slack, q * reach + spread + slack
                        if q >= reach:  # a vector that lies on the coordinate reaches the threshold
                            high = 1.0 + slack
                        if -q >= reach:
                            low = -1.0 - slack
                        x = wide[f, at][keep]
                        keep = keep[(x >= low) & (x <= high)]
            near, score = ids[at], _products(vectors[at] if keep is None else vectors[keep + at.start], query)
            near = near if keep is None else near[keep]
            good = near != own if threshold is None else (near != own) & (score >= threshold)
            best_id, best = np.concatenate([best_id, near[good]]), np.concatenate([best, score[good]])
            if len(best) > k:
                cut = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[cut], best[cut]
            if len(best) == k:
                threshold = int(best.min()) if threshold is None else max(threshold, int(best.min()))
        for vec, score in zip(best_id, best, strict=True):
            yield int(own), int(vec), int(score)
