"""Embedding whitening by a bit-sliced scatter matrix.

Entries become integers. In blocks of rows, each dimension's shifted integers are cut into bit planes, packed across the
rows into 64-bit words: bit r of a word is one row. The number of ones in the AND of plane a of one dimension and plane b
of another, weighted by 2**(a + b), adds up to the exact sum of products. Tasks send counts by weight, which Spark sums as
longs; the driver gets one row for each pair of dimensions and weight, whatever the number of rows. Products are centred
as integers, n * sum(xy) - sum(x) sum(y), before they become doubles and go to eigh.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches, take

SCALE, SHIFT = 64, 1_000_000
#: Rows of a block, 64 to a word.
BLOCK = 1 << 13
#: Scaled entries beyond this have no long of their own.
MOST = 9.2e18
LONG = (1 << 63) - 1


def planes(y: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the planes with a one of non-negative integers y (rows by dimensions)."""
    rows, dims = y.shape
    full = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    full[:rows] = y
    words, dim, bit = [], [], []
    for b in range(bits):
        ones = ((full >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed = np.ascontiguousarray(np.packbits(ones, axis=0, bitorder="little").T).view(np.uint64)
        some = np.flatnonzero(packed.any(1))
        words.append(packed[some]), dim.append(some), bit.append(np.full(len(some), b))
    return np.concatenate(words), np.concatenate(dim), np.concatenate(bit)


def add_products(counts: np.ndarray, y: np.ndarray, bits: int) -> None:
    """Add to counts[i, j, w], for i <= j, the ones of all pairs of planes of dimensions i and j whose bits sum to w; and
    to counts[i, dims, w] those of plane w of i alone."""
    words, dim, bit = planes(y, bits)
    dims = y.shape[1]
    np.add.at(counts, (dim, dims, bit), np.bitwise_count(words).sum(1, dtype=np.int64))
    for k in range(len(words)):
        to = np.flatnonzero(dim >= dim[k])
        np.add.at(counts, (dim[k], dim[to], bit[k] + bit[to]), np.bitwise_count(words[to] & words[k]).sum(1, dtype=np.int64))


def _matrix(column) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


COUNTS = "i int, j int, w int, n long"


def _scatter(dims: int, bits: int, low: int):
    def run(batches):
        counts = np.zeros((dims, dims + 1, 2 * bits - 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), BLOCK):
                # the differences of longs fit into an unsigned word even where they pass the largest long
                add_products(counts, x[at : at + BLOCK].astype(np.uint64) - np.uint64(low % (1 << 64)), bits)
        i, j, w = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "w": pa.array(w, pa.int32()), "n": pa.array(counts[i, j, w])})

    return run


def exact_moments(x: DataFrame, col: str = "x") -> tuple[int, list[int], list[list[int]]]:
    """(n, sums S, centred products n * sum(x_i x_j) - S_i S_j) of a column of long arrays of one length, as exact integers.

    What reaches the driver is dims * (dims + 1) * bits rows at most.
    """
    n, low, high, dims = x.agg(F.count("*"), F.min(F.array_min(col)), F.max(F.array_max(col)), F.max(F.size(col))).first()
    bits = max(1, (high - low).bit_length())
    found = x.select(col).mapInArrow(_scatter(dims, bits, low), COUNTS).groupBy("i", "j", "w").agg(F.sum("n").alias("n"))
    products, sums = [[0] * dims for _ in range(dims)], [0] * dims
    for r in found.collect():
        if r["j"] == dims:
            sums[r["i"]] += r["n"] << r["w"]
        else:
            products[r["i"]][r["j"]] += r["n"] << r["w"]
    # moving all entries by `low` leaves the centred products as they are
    centred = [[n * products[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return n, [s + n * low for s in sums], centred


def whitener(n: int, centred: list[list[int]], components: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(projections, shares): for each component, by falling eigenvalue, its unit eigenvector over the root of its
    eigenvalue, and the eigenvalue's part of the trace. A component without variance has nulls (NaN) and the share 0.

    The products are scaled to the largest before they become doubles, so that neither large nor small ones overflow.
    """
    top = max((max(map(abs, row)) for row in centred), default=0) or 1
    values, vectors = np.linalg.eigh(np.array([[c / top for c in row] for row in centred], np.float64))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components].T
    trace = sum(centred[i][i] for i in range(len(centred))) / top
    real = values > max(trace, 0) * len(centred) * np.finfo(np.float64).eps
    root = np.sqrt(np.where(real, values, np.nan)) * (np.sqrt(float(top)) / n)
    return vectors / root[:, None], np.where(real, values / (trace or 1), 0.0)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(x - S/n as doubles, sum of (n x - S)^2 as exact integers or None beyond a long) for each row.

    n x - S is an integer; the mean is taken off before anything is rounded.
    """
    far = max((abs(n * int(v) - s) for s, col in zip(sums, x.T, strict=True) for v in (col.min(), col.max())), default=0) if len(x) else 0
    big = n * int(np.abs(x).max()) if x.size else 0
    if len(sums) * far * far <= LONG and max(big, *map(abs, sums)) <= LONG:
        d = x * np.int64(n) - np.array(sums, np.int64)
        return d / n, (d * d).sum(1).tolist()
    d = x.astype(object) * n - np.array(sums, object)
    square = (d * d).sum(1)
    return (d / n).astype(np.float64), [s if s <= LONG else None for s in square]


def _second_moments(n: int, sums: list[int], w: np.ndarray):
    def run(batches):
        total = np.zeros((len(w), len(w)))
        for batch in batches:
            z = deviations(_matrix(batch.column(0)), n, sums)[0] @ w.T
            total += z.T @ z
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "s": pa.array(total.ravel())})

    return run


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(n: int, sums: list[int], w: np.ndarray, shares: np.ndarray, error: float | None):
    k = len(w)

    def run(batches):
        for batch in batches:
            rows = len(batch)
            if not rows:
                continue
            d, square = deviations(_matrix(batch.column(1)), n, sums)
            z = d @ w.T
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)), pa.array(square, pa.int64()).take(pa.array(each)),
                pa.array(z.ravel(), from_pandas=True), pa.array(np.tile(shares, rows)), pa.array([error] * (rows * k), pa.float64()),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): rows whose vector is neither null nor holds null or non-finite entries; x = floor(64 c) + 1000000."""
    rows = take(vectors, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < MOST)), F.lit(False))
    return rows.filter(sound & (F.size("v") > 0)).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """A row for each sound vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Means, covariance and eigenvectors come from the n distinct integer vectors, so that copies weigh once; all rows are
    projected. There are as many components as dimensions if those are fewer. A component without variance has a null
    `whitened`, the share 0, and no part in identity_error. Dropped are rows whose vector is null or empty, holds a null,
    NaN or infinite entry, one whose scaled value is no long, or has another length than most vectors (on a tie, than the
    shorter). A `deviation` beyond a long is null. Rows that repeat an id each give their rows, a null id stays null.
    An empty table gives an empty result. Columns other than the two named are not read. The driver holds
    dimensions * dimensions exact integers.
    """
    lean_batches(vectors.sparkSession)
    rows = cut(whole_numbers(vectors, id_col, vector_col), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return rows.select("vec_id").mapInArrow(_nothing, WHITENED)
    rows = rows.filter(F.size("x") == lengths["d"])
    fit = cut(rows.select("x").distinct(), "fit")
    n, sums, centred = exact_moments(fit)
    w, shares = whitener(n, centred, components)
    real = ~np.isnan(w[:, 0])
    error = None
    if real.any():
        found = fit.mapInArrow(_second_moments(n, sums, w[real]), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
        error = float(max(abs(r["s"] / n - (r["i"] == r["j"])) for r in found.collect()))
    return rows.mapInArrow(_whitened(n, sums, w, shares, error), WHITENED)


def _nothing(batches):
    for _ in batches:
        pass
    yield from ()


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
