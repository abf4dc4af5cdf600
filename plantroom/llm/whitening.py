"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

X has a row for each vector, its mean taken away; it is never stored, nor is a column of its length. Right vectors V
(as long as an embedding) and left vectors U (as long as the table) are found in turns, a block of a few at a time:
X V_j, freed of all earlier left vectors, gives U_j; Xᵀ U_j, freed of all earlier right vectors, gives V_j+1. A left
vector is kept as the short vector p with u = X p, so each product is one pass over the rows, in which tasks add up
small matrices. Uᵀ X V is block bidiagonal; its singular values and vectors, computed on the driver, are the deviations
and components. Blocks as wide as the number of components find equal deviations, too, which single vectors miss.

Rounds end when the wanted components are exact to double precision, with the last dimension at the latest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries become whole numbers: floor(SCALE * c) + SHIFT, within LIMIT.
SCALE, SHIFT, LIMIT = 1024.0, 100_000, 1 << 62
#: Rows that a task turns into one matrix hold at most so many numbers.
CHUNK = 1 << 20
SEED = 17
#: A direction whose rows deviate less than this share of the largest deviation does not deviate; a component whose
#: error is below this share of it is exact.
NO_DEVIATION, EXACT = 1e-12, 1e-14

WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Centre:
    """Number of rows, exact sums by dimension, and the sum of all squared deviations from the mean."""

    n: int
    sums: tuple[int, ...]

    def split(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and a remainder over n, so that whole numbers are centred before they are rounded."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, dtype=np.int64), np.array([s - w * self.n for s, w in zip(self.sums, whole, strict=True)], dtype=np.int64)


def whole_numbers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix of the vectors of one length without null or non-finite entries, as whole numbers."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(places)).flatten()
    values = np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(places), dims)
    fine = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values[fine])
    inside = np.clip(scaled, -float(LIMIT), float(LIMIT)).astype(np.int64)
    return places[fine], np.clip(inside, -LIMIT, LIMIT - SHIFT) + SHIFT


def _chunks(column: pa.Array, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, CHUNK // max(1, dims))
    for start in range(0, len(column), step):
        places, numbers = whole_numbers(column.slice(start, step), dims)
        if len(places):
            yield places + start, numbers


def centred(numbers: np.ndarray, centre: Centre) -> np.ndarray:
    whole, rest = centre.split()
    return (numbers - whole).astype(np.float64) - rest / centre.n


def squared_deviation(numbers: np.ndarray, centre: Centre) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 for each row, exactly; None where it does not fit 64 bits."""
    whole, rest = centre.split()
    moved = numbers - whole
    largest = centre.n * (int(np.abs(moved).max(initial=0)) + 1)
    if numbers.shape[1] * largest * largest < 1 << 63:
        return ((centre.n * moved - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((centre.n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True)) for row in moved.tolist()]
    return [value if value < 1 << 63 else None for value in exact]


def _summed(vectors: DataFrame, entries: int, of: Callable[[np.ndarray], np.ndarray], dims: int, exact: bool = False) -> list:
    """Adds up an array of numbers over all rows: each task sums its own, Spark sums the tasks', the driver gets one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * entries if exact else np.zeros(entries)
        for batch in batches:
            for _, numbers in _chunks(batch.column(0), dims):
                part = of(numbers)
                total = [a + b for a, b in zip(total, part, strict=True)] if exact else total + part
        values = pa.array([[Decimal(x) for x in total]], pa.list_(pa.decimal128(38, 0))) if exact else pa.array([total])
        yield pa.RecordBatch.from_arrays([values], names=["total"])

    kind = "decimal(38,0)" if exact else "double"
    parts = vectors.mapInArrow(add, f"total array<{kind}>").select(F.posexplode("total").alias("place", "value"))
    sums = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return [r["value"] for r in sorted(sums, key=lambda r: r["place"])]


def _sums(numbers: np.ndarray) -> list[int]:
    # halves of 31 bits: their sums over a chunk fit 64 bits whatever the entries
    low, high = numbers & 0x7FFFFFFF, numbers >> 31
    return [len(numbers), *(int(a) + (int(b) << 31) for a, b in zip(low.sum(axis=0), high.sum(axis=0), strict=True))]


def _orthonormal(block: np.ndarray, against: np.ndarray, scale: float) -> np.ndarray:
    """Orthonormal basis of what a block adds to orthonormal columns; directions below `scale` are rounding."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
    left, sizes, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, sizes > scale]
    for _ in range(2):
        left = left - against @ (against.T @ left)
        left, _ = np.linalg.qr(left)
    return left[:, : against.shape[0] - against.shape[1]]


class Products:
    """Products with the centred rows, one pass each."""

    def __init__(self, vectors: DataFrame, dims: int, centre: Centre):
        self.vectors, self.dims, self.centre, self.passes = vectors, dims, centre, 0

    def of(self, left: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With Y = X block: (X left)ᵀ Y, Yᵀ Y and Xᵀ Y."""
        centre, (dims, width), earlier = self.centre, block.shape, left.shape[1]
        both = np.column_stack([left, block])

        def part(numbers: np.ndarray) -> np.ndarray:
            rows = centred(numbers, centre)
            images = rows @ both
            new = images[:, earlier:]
            return np.concatenate([(images.T @ new).ravel(), (rows.T @ new).ravel()])

        self.passes += 1
        summed = np.array(_summed(self.vectors, (earlier + width + dims) * width, part, self.dims))
        inner = summed[: (earlier + width) * width].reshape(-1, width)
        return inner[:earlier], inner[earlier:], summed[(earlier + width) * width :].reshape(dims, width)


def bidiagonalised(products: Products, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest singular values of the centred rows and their right singular vectors (as columns)."""
    dims = products.dims
    none = np.zeros((dims, 0))
    right, left, back = none, none, none  # V; P with U = X P; Xᵀ U
    block = _orthonormal(np.random.default_rng(SEED).standard_normal((dims, wanted)), none, 0.0)
    values, vectors = np.zeros(0), none
    scale = 0.0
    while block.shape[1]:
        right = np.column_stack([right, block])
        inner, gram, _ = products.of(left, block)
        scale = max(scale, float(np.sqrt(max(0.0, gram.diagonal().max()))))
        block = block - left @ inner
        sizes, turn = np.linalg.eigh(gram - inner.T @ inner)
        # small directions are enlarged, so that the second pass sees them as they are
        block = (block @ turn) / np.sqrt(np.maximum(sizes, 1e-16 * scale * scale)) if scale else block[:, :0]
        if block.shape[1]:
            inner, gram, image = products.of(left, block)
            block, image = block - left @ inner, image - back @ inner
            sizes, turn = np.linalg.eigh(gram - inner.T @ inner)
            block, image = block @ turn, image @ turn
            norms = np.sqrt(np.maximum(sizes, 0.0))
            kept = norms > NO_DEVIATION * scale * np.linalg.norm(block, axis=0)
            block, image = block[:, kept] / norms[kept], image[:, kept] / norms[kept]
        left, back = np.column_stack([left, block]), np.column_stack([back, image if block.shape[1] else block])
        if not left.shape[1]:
            break
        # Uᵀ X V, block bidiagonal but for rounding
        outer, values, inner = np.linalg.svd(back.T @ right, full_matrices=False)
        vectors = right @ inner.T
        if right.shape[1] == dims or not block.shape[1]:
            break
        ahead = back @ outer[:, :wanted] - vectors[:, :wanted] * values[:wanted]
        if len(values) >= wanted and np.linalg.norm(ahead, axis=0).max() <= EXACT * values[0]:
            break
        block = _orthonormal(block=image, against=right, scale=EXACT * values[0])
    deviating = values[:wanted] > NO_DEVIATION * (values[0] if len(values) else 0.0)
    return values[:wanted][deviating], vectors[:, :wanted][:, deviating]


def _of_one_length(vectors: DataFrame, embedding: str, dims: int, wanted: int, others: list[str]) -> DataFrame:
    only = vectors.select(embedding)
    count, *sums = (int(x) for x in _summed(only, dims + 1, _sums, dims, exact=True))
    if not count:
        return vectors.limit(0).select(*others).selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in WHITENED.split(", ")])
    centre = Centre(count, tuple(sums))
    products = Products(only, dims, centre)
    values, components = bidiagonalised(products, min(wanted, dims))
    found, shown = len(values), min(wanted, dims)
    spread = components * (np.sqrt(centre.n) / values) if found else components

    def check(numbers: np.ndarray) -> np.ndarray:
        rows = centred(numbers, centre)
        white = rows @ spread
        return np.concatenate([(white.T @ white).ravel(), white.sum(axis=0), [(rows * rows).sum()]])

    summed = np.array(_summed(only, found * found + found + 1, check, dims))
    mean = summed[found * found : -1] / centre.n
    covariance = summed[: found * found].reshape(found, found) / centre.n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(found)).max()) if found else None
    shares = [float(v * v / summed[-1]) for v in values] + [0.0] * (shown - found)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, numbers in _chunks(batch.column(embedding), dims):
                white = np.full((len(places), shown), np.nan)
                white[:, :found] = centred(numbers, centre) @ spread
                flat, size = white.ravel(), len(places) * shown
                columns = [batch.column(name).take(pa.array(np.repeat(places, shown))) for name in others] + [
                    pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(size, centre.n)),
                    pa.array([d for d in squared_deviation(numbers, centre) for _ in range(shown)], pa.int64()),
                    pa.array(flat, mask=np.isnan(flat)),
                    pa.array(np.tile(shares, len(places))),
                    pa.array([error] * size, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, *[c.split()[0] for c in WHITENED.split(", ")]])

    kept = ", ".join(f"`{name}` {vectors.schema[name].dataType.simpleString()}" for name in others)
    return vectors.mapInArrow(whiten, f"{kept}, {WHITENED}")


def whitened(vectors: DataFrame, components: int = 8, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Each vector projected on the leading components of all vectors, each component scaled to unit variance.

    Entries c count as whole numbers floor(1024 c) + 100000. Returns, for each vector without null, infinite or NaN
    entries and each component (at most the number of dimensions): vec_id, component (from 1, largest variance first),
    n (vectors), deviation (exact sum over dimensions of (n x - S)^2, S the sums of the dimension; null where it does
    not fit a long), whitened, explained (share of the total variance) and identity_error (largest absolute entry of
    the covariance of all whitened vectors minus the identity).

    A component beyond the dimensions that the rows spread over (single rows, equal rows) has null `whitened` and
    `explained` 0; identity_error covers the others and is null where there are none. Vectors of several lengths are
    several tables, one for each length. Entries too large for a long count as the largest. Null and repeated ids are
    rows like any other; vectors without entries have no components and no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    if rows.schema["embedding"].dataType.simpleString() not in ("array<float>", "array<double>"):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    lengths = rows.where("embedding is not null").select(F.size("embedding").alias("dims")).distinct().orderBy("dims")
    parts = [_of_one_length(rows, "embedding", r["dims"], components, ["vec_id"]) for r in lengths.collect() if r["dims"]]
    if not parts:
        return vectors.sparkSession.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {WHITENED}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
