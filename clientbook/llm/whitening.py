"""Whitening of embeddings from an exact, bit-sliced scatter.

Each component becomes the integer floor(1024 * c) + 100000. A task takes its rows in blocks: every
dimension is shifted by its least value in the block, and each bit of what is left becomes a plane, the
block's rows packed into 64-bit words. The number of ones two planes share, weighted by both bits' values,
adds up to the exact sum of products of two dimensions; the shift is undone in integers. A task gives one
number per pair of dimensions, Spark adds them up as decimals, and only these D * (D + 1) / 2 totals, whose
number does not depend on the rows, come to the driver. They are centred as integers (n * sum of products
minus product of sums) before they become the covariance that ``eigh`` decomposes.

Vectors of different lengths lie in different spaces: each length is fitted on its own. Awkward rows: null
vectors, and those with a null, non-finite or too large entry (beyond 2 ** 40), are left out.
Repeated rows count as often as they are there; null ids are kept. Components without variance (all of
them for a single vector) are 0 whitened and explain 0, and the identity is not asked of them. Where
the exact deviation exceeds a long it is null; ``deviation_exact`` is a decimal that goes on to 38 digits.
Empty tables and vectors without entries give no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clientbook.llm.common import table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows of a block: its planes stay in a core's cache.
BLOCK = 8192
#: Entries beyond this have integers whose squares a decimal of 38 digits could not add up.
LARGEST = float(2**50) / SCALE
_SAFE = 2**62
_EXACT_DOUBLE = 2**53


def usable(embedding: str) -> Column:
    """Not null and without null, non-finite or too large entries."""
    fine = F.forall(
        F.col(embedding),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST),
    )
    return F.col(embedding).isNotNull() & fine


def integers(entries: np.ndarray) -> np.ndarray:
    """floor(1024 * c), exactly: the factor is a power of two. SHIFT is left to the caller."""
    return np.floor(np.asarray(entries, dtype=np.float64) * SCALE).astype(np.int64)


def _blocks(batch: pa.RecordBatch, place: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the batch, integers) of at most BLOCK rows of one length at a time."""
    column = batch.column(place)
    sizes = pc.list_value_length(column).to_numpy()
    for dims in np.unique(sizes):
        if dims == 0:
            continue
        mine = np.flatnonzero(sizes == dims)
        for start in range(0, len(mine), BLOCK):
            part = mine[start : start + BLOCK]
            entries = column.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
            yield part, integers(entries).reshape(len(part), dims)


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of every bit plane of non-negative columns; zero planes are left out."""
    n, _ = shifted.shape
    words, dimension, bit = [], [], []
    widths = [int(top).bit_length() for top in shifted.max(axis=0)]
    pad = -n % 64
    for b in range(max(widths, default=0)):
        chosen = [d for d, width in enumerate(widths) if width > b]
        ones = ((shifted[:, chosen] >> b) & 1).astype(np.uint8)
        packed = np.packbits(np.pad(ones, ((0, pad), (0, 0))).T, axis=1)
        words.append(np.ascontiguousarray(packed).view(np.uint64))
        dimension += chosen
        bit += [b] * len(chosen)
    stacked = np.concatenate(words) if words else np.zeros((0, (n + pad) // 64), np.uint64)
    return stacked, np.array(dimension, np.int64), np.array(bit, np.int64)


def cross_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of non-negative integer columns, by AND and popcount."""
    n, dims = shifted.shape
    words, dimension, bit = planes(shifted)
    shared = np.zeros((len(words), len(words)), np.int64)
    for i in range(len(words)):
        shared[i, i:] = np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64)
    shared += np.triu(shared, 1).T
    bound = n << (2 * int(bit.max(initial=0)) + 2)
    kind = np.float64 if bound < _EXACT_DOUBLE else object
    weights = np.zeros((len(words), dims), kind)
    for i, (d, b) in enumerate(zip(dimension.tolist(), bit.tolist(), strict=True)):
        weights[i, d] = 1 << b
    found = weights.T @ shared.astype(kind) @ weights
    return found.astype(np.int64) if kind is np.float64 else found


class Scatter:
    """Count, sums and sums of products of integer vectors of one length, exact at any size."""

    def __init__(self, dims: int):
        self.n, self.sums, self.products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, block: np.ndarray) -> None:
        n = len(block)
        least = block.min(axis=0)
        # The span of int64 columns may need 64 bits: such blocks are shifted as Python integers.
        wide = int(block.max()) - int(least.min()) >= _SAFE
        shifted = block.astype(object) - least if wide else block - least
        if wide:
            products, sums = shifted.T @ shifted, shifted.sum(axis=0)
        else:
            products = cross_products(shifted)
            kind = object if int(shifted.max()) * n >= _SAFE else np.int64
            sums = shifted.sum(axis=0, dtype=kind)
        reach = max(int(np.abs(least).max()), 1) * max(int(np.abs(block).max()), 1) * n * 4
        kind = object if wide or reach >= _SAFE else np.int64
        least, sums, products = (x.astype(kind) for x in (least, sums, products))
        back = np.multiply.outer(least, sums)
        self.products += (products + back + back.T + n * np.multiply.outer(least, least)).astype(object)
        self.sums += (sums + n * least).astype(object)
        self.n += n


def scatter(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(dims, i, j, total): for i <= j the sum of products, j = -1 the sums and i = -1 the count.

    The integers are those of the embeddings without SHIFT, which no covariance depends on.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Scatter] = {}
        for batch in batches:
            for _, block in _blocks(batch, 0):
                found.setdefault(block.shape[1], Scatter(block.shape[1])).add(block)
        for dims, one in found.items():
            i, j = np.triu_indices(dims)
            i = np.concatenate(([-1], np.arange(dims), i)).astype(np.int32)
            j = np.concatenate(([-1], np.full(dims, -1), j)).astype(np.int32)
            totals = [one.n, *one.sums.tolist(), *one.products[np.triu_indices(dims)].tolist()]
            for start in range(0, len(totals), 1 << 16):
                cut = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(i[cut]), dims, np.int32)), pa.array(i[cut]), pa.array(j[cut]),
                        pa.array(totals[cut], pa.decimal128(38, 0)),
                    ],
                    names=["dims", "i", "j", "total"],
                )

    parts = vectors.filter(usable(embedding)).select(embedding).mapInArrow(each, "dims int, i int, j int, total decimal(38,0)")
    return parts.groupBy("dims", "i", "j").agg(F.sum("total").alias("total"))


@dataclass(frozen=True)
class Whitening:
    """What vectors of one length are whitened with. ``sums`` are those of the integers without SHIFT."""

    n: int
    sums: tuple[int, ...]
    projection: np.ndarray
    explained: tuple[float, ...]
    identity_error: float


def whitening(n: int, sums: list[int], products: dict[tuple[int, int], int], components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance, from exact totals."""
    dims = len(sums)
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # Quotients of Python integers are rounded once.
            covariance[i, j] = covariance[j, i] = (n * products[i, j] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    trace = float(np.trace(covariance))
    real = values > dims * np.finfo(float).eps * max(trace, 0.0)
    safe = np.where(real, values, 1.0)
    projection = np.where(real, vectors / np.sqrt(safe), 0.0)
    whitened = (projection.T @ covariance @ projection)[np.ix_(real, real)]
    error = float(np.abs(whitened - np.eye(len(whitened))).max(initial=0.0))
    explained = tuple(np.where(real, values, 0.0) / trace) if trace > 0 else (0.0,) * len(values)
    return Whitening(n, tuple(sums), projection, tuple(map(float, explained)), error)


def fit(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for every length of vector; the driver sees totals of pairs of dimensions only."""
    totals: dict[int, dict[tuple[int, int], int]] = {}
    for row in scatter(vectors, embedding).toLocalIterator():
        totals.setdefault(row.dims, {})[row.i, row.j] = int(row.total)
    return {
        dims: whitening(found.pop((-1, -1)), [found.pop((i, -1)) for i in range(dims)], found, components)
        for dims, found in totals.items()
    }


def _deviations(block: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, list[int]]:
    """n * x - S as doubles, and the exact sum of its squares for each row."""
    reach = n * int(np.abs(block).max()) + max(map(abs, sums))
    if reach < _SAFE:
        apart = block * n - np.array(sums, np.int64)
        if reach * reach * len(sums) < _SAFE:
            return apart.astype(float), (apart * apart).sum(axis=1).tolist()
        exact = apart.astype(object)
    else:
        exact = block.astype(object) * n - np.array(sums, object)
    return exact.astype(float), (exact * exact).sum(axis=1).tolist()


_RESULT = (
    ("component", T.IntegerType()),
    ("n", T.LongType()),
    ("deviation", T.LongType()),
    ("whitened", T.DoubleType()),
    ("explained", T.DoubleType()),
    ("identity_error", T.DoubleType()),
    ("deviation_exact", T.DecimalType(38, 0)),
)


def whitened(vectors: DataFrame, models: dict[int, Whitening], key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: key, component from 1, n, deviation, whitened, explained, identity_error."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)
    used = vectors.filter(usable(embedding)).select(key, embedding)
    schema = T.StructType([*used.select(key).schema.fields, *(T.StructField(*field) for field in _RESULT)])
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for part, block in _blocks(batch, 1):
                model = models[block.shape[1]]
                apart, exact = _deviations(block, model.n, model.sums)
                scores = (apart / model.n) @ model.projection
                rows, count = scores.shape
                long = pa.array([value if value < 2**63 else None for value in exact], pa.int64())
                wide = pa.array([value if value < 10**38 else None for value in exact], pa.decimal128(38, 0))
                back = pa.array(np.repeat(np.arange(rows), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(part)).take(back),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, model.n, np.int64)),
                        long.take(back),
                        pa.array(scores.ravel()),
                        pa.array(np.tile(np.array(model.explained), rows)),
                        pa.array(np.full(rows * count, model.identity_error)),
                        wide.take(back),
                    ],
                    schema=arrow,
                )

    return used.mapInArrow(each, schema)


def query(spark, folder: str) -> DataFrame:
    """All vectors of the table, whitened by a fit on all of them."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitened(vectors, fit(vectors))
