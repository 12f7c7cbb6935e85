"""Operator 13: whitened embeddings from exact cross-products of bit planes.

Each component becomes the whole number ``x = floor(scale * c) + offset``. A first pass takes count, sums and ranges. A second
shifts each dimension by its least value, which leaves few bits, and packs each bit of each dimension over the rows into
64-bit words (a plane). Two planes, ANDed and their ones counted, give how many rows have both bits; weighted with the
bits' powers of two, these counts are the exact cross-products. Tasks send such sums, Spark adds them, and what reaches the
driver has the size of the covariance matrix whatever the number of rows. The driver centres them as whole numbers of any
length (``n * sum(xy) - sum(x) * sum(y)``), turns them into doubles once and takes the eigenvectors.

Defined cases: vectors that are null or hold null or non-finite entries take no part, nor do those with an entry beyond 2^61 in
units of 1/scale; if vectors differ in length, those of the most frequent length (of equally frequent ones the longer) take part;
components whose eigenvalue is 0 up to rounding have no whitened values and are left out (so one row, or equal rows, give no
result); a deviation that no long can hold is null and stands in ``wide_deviation``; repeated and null ids keep their rows; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import sliced

LIMB = 24  # cross-products travel in parts of so many bits
BLOCK_ROWS = 8192
FLUSH_ROWS = 1 << 30  # far below what a part can count
WIDEST = float(1 << 61)
Batches = Iterator[pa.RecordBatch]


def whole_numbers(vectors: pa.ListArray, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their ``x`` as a matrix, for each length among the vectors that take part."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    parents = pc.list_parent_indices(vectors).to_numpy()
    values = pc.fill_null(pc.list_flatten(vectors).cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(scale * values)
    odd = ~(np.abs(x) < WIDEST)
    fit = lengths > 0
    fit[parents[odd]] = False
    for length in np.unique(lengths[fit]).tolist():
        rows = np.flatnonzero(fit & (lengths == length))
        chosen = np.zeros(len(lengths), bool)
        chosen[rows] = True
        yield rows, x[chosen[parents]].reshape(len(rows), length).astype(np.int64) + offset


@dataclass
class Profile:
    """Of the fit list: rows, and for each dimension sum, least and greatest value."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]


def profile(vectors: DataFrame, scale: int, offset: int) -> Profile:
    """First pass."""

    def run(batches: Batches) -> Batches:
        for batch in sliced(batches, BLOCK_ROWS):
            for _, x in whole_numbers(batch.column("v"), scale, offset):
                low = x.min(axis=0)
                at = np.arange(x.shape[1], dtype=np.int32)
                # Sums of shifted values, so that a batch's sum fits a long whatever the size of the values.
                over = (x - low).astype(object).sum(axis=0) if int((x.max(axis=0) - low).max()).bit_length() > 48 else (x - low).sum(axis=0)
                total = [Decimal(int(o) + int(m) * len(x)) for o, m in zip(over, low, strict=True)]
                yield pa.record_batch({
                    "length": pa.array(np.full(len(at), x.shape[1], np.int32)), "at": pa.array(at), "n": pa.array(np.full(len(at), len(x), np.int64)),
                    "s": pa.array(total, pa.decimal128(38, 0)), "least": pa.array(low), "most": pa.array(x.max(axis=0)),
                })

    parts = vectors.mapInArrow(run, "length int, at int, n long, s decimal(38,0), least long, most long")
    sums = parts.groupBy("length", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("least").alias("least"), F.max("most").alias("most"))
    # As many rows as lengths: the most frequent length is chosen before its dimensions come to the driver.
    chosen = sums.filter("at = 0").orderBy(F.desc("n"), F.desc("length")).select("length").limit(1)
    rows = sums.join(F.broadcast(chosen), "length").orderBy("at").collect()
    return Profile(rows[0].n if rows else 0, [int(r.s) for r in rows], [r.least for r in rows], [r.most for r in rows])


def planes(x: np.ndarray, dims: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A row of 64-bit words for each (dimension, bit): the bits of 64 rows in each word."""
    rows = -(-len(x) // 64) * 64
    out = np.empty((len(dims), rows // 64), np.uint64)
    padded = np.zeros((rows, x.shape[1]), np.int64)
    padded[: len(x)] = x
    flat = np.ascontiguousarray(padded.T)
    for p, (d, b) in enumerate(zip(dims.tolist(), bits.tolist(), strict=True)):
        out[p] = np.packbits(((flat[d] >> b) & 1).astype(np.uint8)).view(np.uint64)
    return out


def joint_counts(words: np.ndarray) -> np.ndarray:
    """In how many rows both planes have a one, for every two planes (upper triangle)."""
    out = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        out[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
    return out


def weighted(counts: np.ndarray, dims: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of the cross-products of shifted values: ``sum of part << (LIMB * limb)`` is the whole."""
    full = np.triu(counts) + np.triu(counts, 1).T
    weight = bits[:, None] + bits[None, :]
    starts = np.flatnonzero(np.r_[True, dims[1:] != dims[:-1]])
    for limb in range(int(weight.max()) // LIMB + 1):
        part = np.where(weight // LIMB == limb, full << (weight % LIMB), 0)
        yield limb, np.add.reduceat(np.add.reduceat(part, starts, axis=0), starts, axis=1)


def cross_products(vectors: DataFrame, found: Profile, scale: int, offset: int) -> list[list[int]]:
    """Second pass: exact ``sum(xy)`` of shifted values for every two dimensions."""
    size = len(found.sums)
    widths = [(b - a).bit_length() for a, b in zip(found.least, found.most, strict=True)]
    dims = np.array([d for d in range(size) for _ in range(widths[d])], np.int64)
    bits = np.array([b for d in range(size) for b in range(widths[d])], np.int64)
    whole = [[0] * size for _ in range(size)]
    if not len(dims):
        return whole
    least, used = np.array(found.least, np.int64), np.unique(dims)

    def run(batches: Batches) -> Batches:
        counts, rows = np.zeros((len(dims), len(dims)), np.int64), 0

        def passed_on() -> Batches:
            for limb, part in weighted(counts, dims, bits):
                i, j = np.nonzero(np.triu(part))
                yield pa.record_batch({
                    "i": pa.array(used[i].astype(np.int32)), "j": pa.array(used[j].astype(np.int32)),
                    "limb": pa.array(np.full(len(i), limb, np.int32)), "part": pa.array(part[i, j]),
                })

        for batch in sliced(batches, BLOCK_ROWS):
            for _, x in whole_numbers(batch.column("v"), scale, offset):
                if x.shape[1] == size:
                    counts += joint_counts(planes(x - least, dims, bits))
                    rows += len(x)
            if rows > FLUSH_ROWS:
                yield from passed_on()
                counts, rows = np.zeros_like(counts), 0
        yield from passed_on()

    parts = vectors.mapInArrow(run, "i int, j int, limb int, part long")
    for r in parts.groupBy("i", "j", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        whole[r.i][r.j] += int(r.part) << (LIMB * r.limb)
        if r.i != r.j:
            whole[r.j][r.i] += int(r.part) << (LIMB * r.limb)
    return whole


@dataclass
class Model:
    """The fit list's profile, and the components kept: vectors (a column each), eigenvalues and their share of the trace."""

    fit: Profile
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fitted(vectors: DataFrame, scale: int, offset: int, components: int) -> Model:
    """Covariance from whole numbers, then its eigenvectors by falling eigenvalue."""
    found = profile(vectors, scale, offset)
    n, size = found.n, len(found.sums)
    if not n:
        return Model(found, np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    products = cross_products(vectors, found, scale, offset)
    shifted = [s - n * m for s, m in zip(found.sums, found.least, strict=True)]  # a covariance does not change by a shift
    v = np.array([[(n * products[i][j] - shifted[i] * shifted[j]) / (n * n) for j in range(size)] for i in range(size)])
    trace = sum(n * products[i][i] - shifted[i] ** 2 for i in range(size)) / (n * n)
    values, sides = np.linalg.eigh(v)
    values, sides = values[::-1], sides[:, ::-1]
    kept = min(components, int((values > max(values[0], 0) * size * np.finfo(float).eps).sum()))
    return Model(found, sides[:, :kept], values[:kept], values[:kept] / trace if trace else values[:kept])


def _centred(x: np.ndarray, fit: Profile) -> tuple[np.ndarray, bool]:
    """``n * x - S``, and whether it is held in longs (else in numbers of any length)."""
    n, size = fit.n, len(fit.sums)
    shifted = [s - n * m for s, m in zip(fit.sums, fit.least, strict=True)]
    most = max(n * (b - a) for a, b in zip(fit.least, fit.most, strict=True))
    y = x - np.array(fit.least, np.int64)
    if most < 1 << 62:
        return n * y - np.array(shifted, np.int64), most * most * size < 1 << 63
    return n * y.astype(object) - np.array(shifted, object), False


def _whitener(model: Model, scale: int, offset: int) -> Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    turn = model.vectors / np.sqrt(model.values)

    def run(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row numbers, deviations and whitened values."""
        for rows, x in whole_numbers(batch.column("v"), scale, offset):
            if x.shape[1] == len(model.fit.sums):
                centred, short = _centred(x, model.fit)
                squares = centred if short else centred.astype(object)
                yield rows, (squares * squares).sum(axis=1), (centred / model.fit.n).astype(np.float64) @ turn

    return run


def identity_error(vectors: DataFrame, model: Model, scale: int, offset: int) -> float:
    """Largest entry of the whitened vectors' own covariance minus the identity, measured over the fit list."""
    white, k = _whitener(model, scale, offset), len(model.values)

    def run(batches: Batches) -> Batches:
        total, products, rows = np.zeros(k), np.zeros((k, k)), 0
        for batch in sliced(batches, BLOCK_ROWS):
            for _, _, w in white(batch):
                total, products, rows = total + w.sum(axis=0), products + w.T @ w, rows + len(w)
        if rows:
            flat = np.r_[total, products.ravel()]
            yield pa.record_batch({"at": pa.array(np.arange(len(flat), dtype=np.int32)), "s": pa.array(flat)})

    parts = vectors.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s"))
    flat = np.zeros(k + k * k)
    for r in parts.collect():
        flat[r["at"]] = r.s
    mean = flat[:k] / model.fit.n
    return float(np.abs(flat[k:].reshape(k, k) / model.fit.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(embeddings: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, wide_deviation`` for each row and component."""
    spark: SparkSession = embeddings.sparkSession
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    model = fitted(vectors, scale, offset, components)
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double, wide_deviation decimal(38,0)"
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(model.values):
        return spark.createDataFrame([], schema.format(kind))
    error, white, k = identity_error(vectors, model, scale, offset), _whitener(model, scale, offset), len(model.values)

    def run(batches: Batches) -> Batches:
        for batch in sliced(batches, BLOCK_ROWS):
            for rows, deviation, w in white(batch):
                short = deviation.dtype != object
                each = [int(d) for d in deviation] if not short else []
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id").take(pa.array(rows)),
                    "deviation": pa.array(deviation) if short else pa.array([d if d < 1 << 63 else None for d in each], pa.int64()),
                    "wide_deviation": pa.nulls(len(rows), pa.decimal128(38, 0)) if short else pa.array([Decimal(d) if (1 << 63) <= d < 10**38 else None for d in each], pa.decimal128(38, 0)),
                    "w": pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64())),
                })

    rows = vectors.mapInArrow(run, f"vec_id {kind}, deviation long, wide_deviation decimal(38,0), w array<double>")
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    return rows.select("vec_id", "deviation", "wide_deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"), "wide_deviation",
    )
