"""Whitening of vectors from exact, bit-sliced cross-products.

Entries become whole numbers, shifted by the least of their dimension. For a block of rows, each bit plane of each dimension is packed into 64-bit
words; the bits two planes have in common, counted and weighted by their places, add up to the exact sum of
products. Sums of all blocks are added as whole numbers, centred as whole numbers, and only then divided, so the
covariance is right to the last bit of a double before its eigenvectors are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskspark.llm.common import table

#: Rows that are packed together; a multiple of 64.
BLOCK_ROWS = 1 << 15
#: Entries of this size and more have no whole number in a long and count as not finite.
LARGEST = float(1 << 55)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact sums of the whole numbers, and the components by falling eigenvalue."""

    #: Rows, entries of a vector, and per dimension the least whole number and the sum of what lies above it.
    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    sums: list[int]
    #: One column per component, divided by the root of its eigenvalue.
    weights: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """Entries as whole numbers: scaled, rounded down, and moved."""
    return np.floor(values.astype(np.float64) * scale).astype(np.int64) + offset


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null nor empty and has finite entries only."""
    entries = F.col(vector)
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return vectors.where(entries.isNotNull() & (F.size(entries) > 0) & F.coalesce(finite, F.lit(False)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The vectors of a task in blocks of ``BLOCK_ROWS`` rows, the last one shorter."""
    held, rows = [], 0
    for batch in batches:
        held.append(_matrix(batch.column(0), width))
        rows += len(held[-1])
        if rows >= BLOCK_ROWS:
            joined = np.concatenate(held)
            cut = rows - rows % BLOCK_ROWS
            for at in range(0, cut, BLOCK_ROWS):
                yield joined[at : at + BLOCK_ROWS]
            held, rows = [joined[cut:]], rows - cut
    if rows:
        yield np.concatenate(held)


def bit_planes(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of non-negative whole numbers, lowest first, one row of 64-bit words each."""
    rows, width = values.shape
    planes = np.zeros((int(bits.sum()), -(-rows // 64) * 8), np.uint8)
    at = 0
    for d in range(width):
        column = values[:, d]
        for b in range(int(bits[d])):
            packed = np.packbits(((column >> b) & 1).astype(np.uint8), bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


def cross_products(planes: np.ndarray, bits: np.ndarray, total: np.ndarray) -> None:
    """Add the sums of products of all pairs of columns to ``total``, whose upper half is used.

    ``total`` holds 64-bit integers where these are wide enough, Python's own otherwise.
    """
    begins = np.cumsum(bits) - bits
    places = np.arange(int(bits.sum())) - np.repeat(begins, bits)
    weights = (np.array([1 << int(p) for p in places], total.dtype)) if len(places) else np.zeros(0, total.dtype)
    columns = np.flatnonzero(bits)
    for k, a in enumerate(columns):
        rest = columns[k:]
        first = int(begins[a])
        common = np.zeros(len(planes) - first, total.dtype)
        for b in range(int(bits[a])):
            both = np.bitwise_count(planes[first + b] & planes[first:]).sum(axis=1, dtype=np.int64)
            common += both.astype(total.dtype) * (1 << b)
        total[a, rest] += np.add.reduceat(common * weights[first:], begins[rest] - first)


def ranges(vectors: DataFrame, vector: str, scale: int, offset: int) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Width of the vectors and the least and greatest whole number of each dimension; None for no rows.

    The width is that of most vectors, the greater of equally frequent ones.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(sizes).tolist():
                part = column if (sizes == width).all() else column.filter(pa.array(sizes == width))
                x = whole(_matrix(part, width), scale, offset)
                low, high = x.min(axis=0), x.max(axis=0)
                n, l, h = seen.get(width, (0, low, high))
                seen[width] = n + len(x), np.minimum(l, low), np.maximum(h, high)
        for width, (n, low, high) in seen.items():
            made = [np.full(width, width, np.int32), np.arange(width, dtype=np.int32), np.full(width, n), low, high]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in made], ["width", "d", "n", "low", "high"])

    found = vectors.select(vector).mapInArrow(spread, "width int, d int, n long, low long, high long")
    found = found.groupBy("width", "d").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    # As many rows as dimensions.
    rows = found.collect()
    if not rows:
        return None
    width = max(rows, key=lambda r: (r["n"], r["width"]))["width"]
    own = sorted((r for r in rows if r["width"] == width), key=lambda r: r["d"])
    return width, np.array([r["low"] for r in own]), np.array([r["high"] for r in own])


def fit(vectors: DataFrame, vector: str, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> Whitening | None:
    """The whitening of usable vectors; None for no rows. Components without variance are left out."""
    known = ranges(vectors, vector, scale, offset)
    if known is None:
        return None
    width, low, high = known
    spans = [int(h) - int(l) for l, h in zip(low, high)]
    # One more column of ones, so that sums and the number of rows come as products too.
    bits = np.array([s.bit_length() for s in spans] + [1])
    # A task has fewer than 2 ** 32 rows.
    kind = np.int64 if 2 * int(bits.max()) + 32 < 63 else object

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), kind)
        for block in _blocks(batches, width):
            x = (whole(block, scale, offset) - low).view(np.uint64)
            cross_products(bit_planes(np.hstack([x, np.ones((len(x), 1), np.uint64)]), bits), bits, total)
        a, b = np.nonzero(np.triu(total != 0))
        sums = pa.array([str(total[i, j]) for i, j in zip(a, b)], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), sums], ["a", "b", "s"])

    rows = vectors.where(F.size(vector) == width).select(vector)
    parts = rows.mapInArrow(summed, "a int, b int, s string").groupBy("a", "b")
    # One row per pair of dimensions, however many vectors there are.
    sums = {(r["a"], r["b"]): int(r["s"]) for r in parts.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n = sums[width, width]
    firsts = [sums.get((d, width), 0) for d in range(width)]
    covariance = np.zeros((width, width))
    for a in range(width):
        for b in range(a, width):
            # Centred as whole numbers; the quotient of two of them is the nearest double.
            covariance[a, b] = covariance[b, a] = (n * sums.get((a, b), 0) - firsts[a] * firsts[b]) / (n * n)
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > width * np.finfo(float).eps * max(values.max(), 0)]
    values, directions = values[order], directions[:, order]
    trace = np.trace(covariance)
    return Whitening(n, width, low, high, firsts, directions / np.sqrt(values), values, values / trace if trace else values)


def apply(vectors: DataFrame, vector: str, fitted: Whitening, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vectors`` of the fitted width with ``deviation`` decimal(38,0) and ``whitened`` array<double>, one entry per component."""
    added = StructType.fromDDL("deviation decimal(38,0), whitened array<double>").fields
    others = [c for c in vectors.columns if c not in ("deviation", "whitened")]
    rows = vectors.where(F.size(vector) == fitted.width).select(*[c for c in others if c != vector], vector)
    columns, n = rows.columns, fitted.n
    # Squares of n * x - S, as 64-bit integers where their sum cannot overflow.
    widest = n * int((fitted.high - fitted.low).max())
    narrow = widest * widest * fitted.width < 1 << 62
    sums = np.array(fitted.sums, np.int64 if narrow else object)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(_matrix(batch.column(batch.num_columns - 1), fitted.width), scale, offset) - fitted.low
            centred = (x if narrow else x.astype(object)) * n - sums
            squares = (centred * centred).sum(axis=1).tolist()
            scores = (centred / n).astype(np.float64) @ fitted.weights
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * scores.shape[1], pa.int32())
            made = [
                pa.array(squares, pa.int64()).cast(pa.decimal128(38, 0)) if narrow else pa.array(squares, pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, pa.array(scores.ravel())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*columns, "deviation", "whitened"])

    return rows.mapInArrow(whitened, StructType([*rows.schema.fields, *added])).select(*others, "deviation", "whitened")


def identity_error(scores: DataFrame, components: int, whitened: str = "whitened") -> float:
    """Greatest entry of the covariance of whitened vectors minus the identity; 0 for no components or rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components + 1))
        for batch in batches:
            z = _matrix(batch.column(0), components)
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        a, b = np.nonzero(np.triu(np.ones_like(total)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[a, b])], ["a", "b", "s"])

    if not components:
        return 0.0
    parts = scores.select(whitened).mapInArrow(summed, "a int, b int, s double").groupBy("a", "b")
    total = np.zeros((components + 1, components + 1))
    for r in parts.agg(F.sum("s").alias("s")).collect():
        total[r["a"], r["b"]] = total[r["b"], r["a"]] = r["s"]
    n = total[-1, -1]
    if not n:
        return 0.0
    mean = total[:-1, -1] / n
    return float(np.abs(total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(components)).max())


def whiten(vectors: DataFrame, vector: str, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """Rows with a usable vector, and ``n``, ``deviation``, ``whitened``, ``eigenvalues``, ``explained`` and ``identity_error``.

    Whole numbers are ``floor(scale * entry) + offset``. Left out are vectors that are null or empty, that hold a null, a NaN or
    an entry of ``LARGEST`` and more, or that have another length than most (the greater of equally frequent lengths). The lists
    have one entry per component, by falling eigenvalue; there are fewer than ``components`` where the vectors have fewer dimensions or
    do not vary in so many directions, none for a single row or equal rows. Repeated rows and null ids count and stay; columns
    named as what is added are replaced; an empty table gives an empty one.
    """
    kind = vectors.schema[vector].dataType.elementType.typeName()
    own = vectors if kind in ("float", "double") else vectors.withColumn(vector, F.col(vector).cast("array<double>"))
    rows = usable(own, vector)
    names = ("n", "deviation", "whitened", "eigenvalues", "explained", "identity_error")
    rows = rows.select(*[c for c in rows.columns if c not in names])
    fitted = fit(rows, vector, components, scale, offset)
    if fitted is None:
        none = [F.lit(None).cast(t) for t in ("long", "decimal(38,0)", *["array<double>"] * 3, "double")]
        return rows.limit(0).select("*", *[c.alias(name) for c, name in zip(none, names)])
    scores = apply(rows, vector, fitted, scale, offset)
    lists = [F.array(*map(F.lit, values.tolist())).cast("array<double>") for values in (fitted.eigenvalues, fitted.explained)]
    error = identity_error(scores, len(fitted.eigenvalues))
    return scores.select(
        *[c for c in scores.columns if c not in ("deviation", "whitened")],
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        lists[0].alias("eigenvalues"),
        lists[1].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_bit_sliced_whitening(spark, sf_dir):
    """Every usable vector on the first 32 whitened components, one row each."""
    rows = whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "embedding")
    place = F.posexplode("whitened").alias("place", "whitened")
    rows = rows.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error", place)
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("explained", F.col("place")).alias("explained"),
        "identity_error",
    )


QUERIES = {"op12_bit_sliced_whitening": op12_bit_sliced_whitening}
ORACLES: dict[str, str] = {}
