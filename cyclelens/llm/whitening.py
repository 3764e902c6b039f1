"""Embedding whitening with an exact, bit-sliced scatter matrix.

Entries become whole numbers x = floor(64 * c) + 1,000,000; the constant cancels when x is
centred, so it is never added. In a block of rows each
dimension is shifted to start at zero and cut into bit planes, and the bits of one plane
are packed across the rows into 64-bit words. The bits two planes have in common are
counted by AND and popcount; weighted by their powers of two these counts are the exact
cross-products of the block. Every task adds its blocks up and sends one row for each pair
of dimensions, in 32-bit limbs, so the sums stay exact whatever the number of rows.

The driver gets sums and cross-products only (their number depends on the dimensions, not
on the rows), centres them as integers, n * Q - S * S', and takes the eigenvectors of that
matrix. Rows are then projected where they are. The covariance of the whitened values is
measured on all rows as well and returned as the largest departure from the identity.

A vector that is null or holds a null, a NaN or an infinity is dropped, and so is one
whose length is not that of most vectors (the longer length of a tie). Entries whose x
would leave +-2^53 are held there. A component without variance, which cannot be scaled
to one, has a null `whitened` and takes no part in the identity error. `deviation` is null
where it does not fit a long. Null and repeated ids are carried along, each row by itself.
An empty table, or one without a whole vector, gives no row. Only the named columns are
read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.batches import output_schema

SCALE = 64
COMPONENTS = 32
BLOCK = 8192  # rows whose bits are packed together
LARGEST = 1 << 53
_LIMBS, _LIMB_BITS = 5, 32
_FLAT = 1e-12  # share of the largest eigenvalue under which a component has no variance


def whole_vectors(column: pa.Array, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors in an Arrow list column, and these as a matrix."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64())
    nulls = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(nulls | ~np.isfinite(values))))
    fine = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if dims is not None:
        fine &= lengths == dims
    at = np.flatnonzero(fine)
    if dims is None or not len(at):
        return at, np.zeros((0, dims or 0))
    return at, values[(ends[at] - dims)[:, None] + np.arange(dims)]


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * c) as longs."""
    return np.floor(np.clip(scale * vectors, -LARGEST, LARGEST)).astype(np.int64)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bits of a block without negative numbers: packed words (a row for each plane),
    the dimension of each plane and its power of two."""
    rows, dims = shifted.shape
    depth = [int(m).bit_length() for m in shifted.max(axis=0)]
    dim = np.repeat(np.arange(dims), depth)
    bit = np.concatenate([np.arange(d) for d in depth]) if dims else np.zeros(0, np.int64)
    words = np.zeros((len(dim), -(-rows // 64) * 8), np.uint8)
    for k, (d, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        packed = np.packbits((shifted[:, d] >> b & 1).astype(bool))
        words[k, : len(packed)] = packed
    return words.view(np.uint64), dim, bit


def cross_products(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns and of their products, as Python integers, from AND-popcounts."""
    words, dim, bit = bit_planes(shifted)
    dims, planes = shifted.shape[1], len(dim)
    common = np.zeros((planes, planes), np.int64)
    for k in range(planes):
        common[k, k:] = np.bitwise_count(words[k] & words[k:]).sum(axis=1, dtype=np.int64)
    common = common + np.triu(common, 1).T
    # Sums stay below rows * 2^(both depths), which may pass 64 bits.
    small = 2 * (int(bit.max(initial=0)) + 1) + len(shifted).bit_length() < 62
    weight = np.zeros((planes, dims), np.int64 if small else object)
    for k, (d, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        weight[k, d] = 1 << b
    counts = common if small else common.astype(object)
    return (np.diag(counts) @ weight).astype(object), (weight.T @ counts @ weight).astype(object)


def _block_sums(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and products of a block of longs of any sign."""
    least = block.min(axis=0)
    sums, products = cross_products(block - least)
    shift, rows = least.astype(object), len(block)
    return sums + rows * shift, products + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)


def _limbs(value: int) -> list[int]:
    """Little-endian limbs; all but the last are unsigned."""
    mask = (1 << _LIMB_BITS) - 1
    low = [value >> _LIMB_BITS * k & mask for k in range(_LIMBS - 1)]
    return [*low, value >> _LIMB_BITS * (_LIMBS - 1)]


_SUMS = "i int, j int, " + ", ".join(f"limb{k} long" for k in range(_LIMBS))


def _summer(dims: int, scale: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        waiting: list[np.ndarray] = []

        def settle() -> None:
            nonlocal n, sums, products
            block = np.concatenate(waiting)
            waiting.clear()
            for part in (block[i : i + BLOCK] for i in range(0, len(block), BLOCK)):
                more, crossed = _block_sums(part)
                n, sums, products = n + len(part), sums + more, products + crossed

        for batch in batches:
            vectors = whole_vectors(batch.column("vector"), dims)[1]
            if len(vectors):
                waiting.append(whole_numbers(vectors, scale))
            if sum(map(len, waiting)) >= BLOCK:
                settle()
        if waiting:
            settle()
        if n:
            cells = [(-1, -1, n), *((-1, j, int(sums[j])) for j in range(dims))]
            cells += [(i, j, int(products[i, j])) for i in range(dims) for j in range(i, dims)]
            limbs = np.array([_limbs(v) for _, _, v in cells], dtype=np.int64)
            columns = {"i": pa.array([c[0] for c in cells], pa.int32()), "j": pa.array([c[1] for c in cells], pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | {f"limb{k}": pa.array(np.ascontiguousarray(limbs[:, k])) for k in range(_LIMBS)})

    return add


@dataclass
class Whitening:
    """What was learned from all rows."""

    n: int
    sums: np.ndarray  # Python integers
    axes: np.ndarray  # unit eigenvectors as columns
    variances: np.ndarray  # of the components, of x
    total: float  # trace of the covariance
    scale: int

    @property
    def usable(self) -> np.ndarray:
        return self.variances > _FLAT * max(self.variances.max(initial=0.0), 0.0)

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        """n * x - S as integers: longs where they are sure to fit."""
        bound = self.n * max(1, int(np.abs(numbers).max(initial=0))) + max((abs(int(s)) for s in self.sums), default=0)
        if bound < 1 << 62:
            return numbers * np.int64(self.n) - self.sums.astype(np.int64)
        return numbers.astype(object) * self.n - self.sums

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        largest = max((abs(int(v)) for v in (centred.min(initial=0), centred.max(initial=0))), default=0)
        if largest * largest * max(1, centred.shape[1]) < 1 << 62:
            return (centred * centred).sum(axis=1).tolist()
        totals = [sum(int(v) ** 2 for v in row) for row in centred]
        return [t if t < 1 << 63 else None for t in totals]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Projections with unit variance; NaN where a component has none."""
        scaled = np.where(self.usable, self.variances, np.nan) ** -0.5
        return (centred.astype(np.float64) / self.n) @ self.axes * scaled


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("vector")
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        found, n = np.unique(lengths[whole_vectors(column, None)[0]], return_counts=True)
        yield pa.RecordBatch.from_pydict({"length": pa.array(found.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of all usable vectors, or None if there is none."""
    vectors = df.select(F.col(vector_col).alias("vector"))
    counted = vectors.mapInArrow(_lengths, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    most = counted.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return None
    dims = most["length"]
    cells = vectors.mapInArrow(_summer(dims, scale), _SUMS).groupBy("i", "j").agg(
        *[F.sum(f"limb{k}").alias(f"limb{k}") for k in range(_LIMBS)]
    )
    n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for row in cells.collect():
        value = sum(row[f"limb{k}"] << _LIMB_BITS * k for k in range(_LIMBS))
        if row["j"] < 0:
            n = value
        elif row["i"] < 0:
            sums[row["j"]] = value
        else:
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = value
    exact = n * products - np.outer(sums, sums)  # n^2 times the covariance
    covariance = np.array([[v / (n * n) for v in row] for row in exact.tolist()], dtype=np.float64)
    values, axes = np.linalg.eigh(covariance)
    chosen = np.argsort(-values, kind="stable")[: min(components, dims)]
    axes = axes[:, chosen]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Whitening(n, sums, axes, np.maximum(values[chosen], 0.0), float(np.trace(covariance)), scale)


def _measurer(model: Whitening):
    """Sums of the whitened values and of their products, one row for each cell."""
    k = len(model.variances)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            vectors = whole_vectors(batch.column("vector"), len(model.sums))[1]
            values = np.nan_to_num(model.whitened(model.centred(whole_numbers(vectors, model.scale))))
            first += values.sum(axis=0)
            second += values.T @ values
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.concatenate((np.full(k, -1), i)), pa.int32()),
            "j": pa.array(np.concatenate((np.arange(k), j)), pa.int32()),
            "total": pa.array(np.concatenate((first, second[i, j]))),
        })

    return measure


def identity_error(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity."""
    vectors = df.select(F.col(vector_col).alias("vector"))
    cells = vectors.mapInArrow(_measurer(model), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    found = {(r["i"], r["j"]): r["total"] / model.n for r in cells.collect()}
    use = np.flatnonzero(model.usable).tolist()
    return max(
        (abs(found[i, j] - found[-1, i] * found[-1, j] - (i == j)) for i in use for j in use if i <= j),
        default=0.0,
    )


def _projector(model: Whitening, error: float):
    share = model.variances / model.total if model.total else np.zeros(len(model.variances))
    entry = pa.struct([("component", pa.int32()), ("whitened", pa.float64()), ("explained", pa.float64())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vectors = whole_vectors(batch.column("vector"), len(model.sums))
            centred = model.centred(whole_numbers(vectors, model.scale))
            values, k = model.whitened(centred), len(share)
            flat = pa.StructArray.from_arrays([
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(values.ravel(), pa.float64(), mask=np.isnan(values.ravel())),
                pa.array(np.tile(share, len(at))),
            ], fields=list(entry))
            ends = pa.array(np.arange(0, len(at) * k + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_pydict({
                "row_id": batch.column("row_id").take(pa.array(at)),
                "n": pa.array(np.full(len(at), model.n)),
                "deviation": pa.array(model.deviations(centred), pa.int64()),
                "components": pa.ListArray.from_arrays(ends, flat),
                "identity_error": pa.array(np.full(len(at), error)),
            })

    return project


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each usable vector: `row_id`, `n`, `deviation`, `components` (an array of
    component, whitened and explained, by falling variance) and `identity_error`."""
    more = ("n long, deviation long, components array<struct<component:int,whitened:double,explained:double>>, "
            "identity_error double")
    schema = output_schema(df, id_col, more)
    model = fit(df, vector_col, components, scale)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(df, model, vector_col)
    rows = df.select(F.col(id_col).alias("row_id"), F.col(vector_col).alias("vector"))
    return rows.mapInArrow(_projector(model, error), schema)
