"""Embedding whitening by mixed-precision refinement (operator 12).

Sums and products over all vectors are distributed; only matrices of the vectors' width reach the
driver. There the covariance's eigenvectors are found in single precision and corrected by matrix
products in a higher one (the iteration of Ogita and Aishima): each step takes the errors of
orthogonality and of diagonality to second order. Where eigenvalues lie too close for that, the step
leaves the vectors of the cluster mixed, and a small eigenvalue problem inside the cluster, shifted by
its mean, separates them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
STEPS = 12
CELLS = 1 << 20  # numbers of one matrix inside a task, about
LARGEST = 2.0**53  # integers up to here are exact as doubles
LONG_MAX = 2**63 - 1
HIGH = np.longdouble

WHITE = "vec_id {id}, component int, n long, deviation long, whitened double, explained double"


# ------------------------------------------------------------------ eigenvectors of a small matrix


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Positions of eigenvalues no further than ``gap`` from their next one, at least two together."""
    order = np.argsort(values)[::-1]
    parts = np.split(order, np.flatnonzero(-np.diff(values[order]) > gap) + 1)
    return [p for p in parts if len(p) > 1]


def _errors(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How far ``x`` is from orthonormal, its products with ``a``, its Rayleigh quotients, and what of the
    products does not lie on the diagonal."""
    skew, product = np.eye(x.shape[1], dtype=HIGH) - x.T @ x, x.T @ (a @ x)
    # rounding must not differ across the diagonal: it is divided by the distance of eigenvalues
    skew, product = (skew + skew.T) / 2, (product + product.T) / 2
    values = np.diag(product) / (1 - np.diag(skew))
    return skew, product, values, product - np.diag(values)


def refine(a: np.ndarray, x: np.ndarray, scale: HIGH) -> tuple[np.ndarray, np.ndarray, HIGH]:
    """One correction of ``x``; also the Rayleigh quotients and the distance below which two of them
    cannot be told apart. ``scale`` is a norm of ``a``."""
    skew, product, values, off = _errors(a, x)
    near = 2 * (np.linalg.norm(off.astype(float)) + scale * np.linalg.norm(skew.astype(float)))
    distance = values[None, :] - values[:, None]
    apart = np.abs(distance) > near
    turned = (product + values[None, :] * skew) / np.where(apart, distance, 1)
    return x + x @ np.where(apart, turned, skew / 2), values, HIGH(near)


def solve_cluster(a: np.ndarray, x: np.ndarray, centre: HIGH) -> np.ndarray:
    """``x`` turned inside its own span to the eigenvectors of ``a`` there. The shift by ``centre`` leaves
    only the small differences inside the cluster, so double precision resolves them."""
    inner = x.T @ (a @ x - centre * x)
    size = np.abs(inner).max()
    if not size:
        return x
    _, turn = np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(float))
    return x @ turn.astype(HIGH)


def eigenvectors(covariance: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix given in high
    precision; the result is accurate to double precision. Equal eigenvalues have any basis of their
    space."""
    a = covariance.astype(HIGH)
    scale = np.abs(a).sum(1).max(initial=HIGH(0))  # bounds the spectral norm
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    done = HIGH(len(a)) * np.finfo(HIGH).eps * 8
    for _ in range(steps):
        x, values, near = refine(a, x, HIGH(1))
        for at in _clusters(values, max(near, HIGH(len(a)) * np.finfo(float).eps)):
            x[:, at] = solve_cluster(a, x[:, at], values[at].mean())
        skew, _, values, off = _errors(a, x)
        if max(np.abs(skew).max(), np.abs(off - np.diag(np.diag(off))).max()) <= done:
            break
    x = x / np.sqrt((x * x).sum(0))
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(float), x[:, order].astype(float)


# ------------------------------------------------------------------ passes over the vectors


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """Integer vectors of one width; components that are missing count as 0 before the shift."""
    rows = len(column)
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64) + SHIFT
    if rows and (sizes == width).all():
        return flat.reshape(rows, width)
    out = np.full((rows, width), SHIFT, np.int64)
    out[np.repeat(np.arange(rows), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _sum_dimensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: list[int] = []
    rows: list[int] = []
    for batch in batches:
        column = batch.column("vec")
        sizes = np.diff(column.offsets.to_numpy())
        width = int(sizes.max(initial=0))
        total += [0] * (width - len(total))
        rows += [0] * (width - len(rows))
        for part in _slices(iter([batch]), width):
            x = _integers(part.column("vec"), width)
            peak = int(np.abs(x).max(initial=0))
            sums = x.sum(0).tolist() if peak * len(x) < LONG_MAX else x.astype(object).sum(0).tolist()
            total[:width] = [a + b for a, b in zip(total, sums)]
        rows[:width] = [a + batch.num_rows for a in rows[:width]]
    # positions beyond a batch's width hold the shift alone
    seen = max(rows, default=0)
    total = [t + (seen - r) * SHIFT for t, r in zip(total, rows)]
    yield pa.RecordBatch.from_pydict(
        {"dim": pa.array(range(len(total)), pa.int32()), "seen": pa.array([seen] * len(total), pa.int64()), "total": pa.array(map(str, total), pa.string())}
    )


def _multiply(width: int, centre: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Products of the vectors less ``centre``, as exact integers wherever they fit a double."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((width, width), HIGH), False
        for part in _slices(batches, width):
            y = (_integers(part.column("vec"), width) - centre).astype(float)
            total += y.T @ y
            any_row = any_row or bool(len(y))
        if any_row:
            # two doubles hold the extended sum
            high = total.astype(float)
            low = (total - high).astype(float)
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(width), pa.int32()), "high": list(high), "low": list(low)})

    return run


def _add_products(key: tuple, rows: pa.Table) -> pa.Table:
    high, low = (np.array(rows[c].to_pylist(), HIGH).sum(0) for c in ("high", "low"))
    total = high + low
    head = total.astype(float)
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "high": [head], "low": [(total - head).astype(float)]})


def _project(width: int, n: int, centre: np.ndarray, rest: list[int], frame: np.ndarray, share: list[float], id_type: pa.DataType):
    """Rows of every vector and component. ``centre * n + rest`` are the sums per dimension, ``frame`` the
    eigenvectors over the roots of their eigenvalues."""
    part_of_one = np.array([r / n for r in rest])
    components = frame.shape[1]

    def deviations(y: np.ndarray) -> list[int | None]:
        peak = float(np.abs(y).max(initial=0)) * n + max(abs(r) for r in rest)
        if peak * peak * width < 2.0**62:
            return ((y * n - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = ((y.astype(object) * n - np.array(rest, object)) ** 2).sum(1).tolist()
        return [d if d <= LONG_MAX else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, max(width, components)):
            y = _integers(part.column("vec"), width) - centre
            rows = len(y)
            white = (y - part_of_one) @ frame
            each = pa.array(np.repeat(np.arange(rows), components))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(each).cast(id_type),
                    pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * components, n)),
                    pa.array(deviations(y), pa.int64()).take(each),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(np.array(share), rows)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    return run


def _merged(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _add_moments(rows: pa.Table) -> pa.Table:
    n, mean, products = _sum_moments(rows.to_pylist())
    return pa.table({"n": [n], "mean": [mean], "products": [products.reshape(-1)]})


def _sum_moments(rows: list) -> tuple[int, np.ndarray, np.ndarray]:
    n, mean, products = 0, np.zeros(1), np.zeros((1, 1))
    for r in rows:
        of_row = (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(len(r["mean"]), -1))
        n, mean, products = _merged((n, mean, products), of_row) if n else of_row
    return n, mean, products


# ------------------------------------------------------------------ the operator


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: every vector on the first
    ``components`` unit eigenvectors of the covariance of all, each over the root of its eigenvalue.

    Components of the input become the integers ``floor(64 * c) + 1000000``. Sums are exact. For the
    covariance the integer nearest each mean is taken off before multiplying and the rest, below one
    half, exactly after. ``deviation`` is the sum of ``(n * x - S)^2`` over the dimensions.

    Vectors that are null, or hold a null or non-finite component, or one whose integer does not fit 62
    bits, take no part. Shorter vectors count as if zeros followed; null ids and repeated rows are rows
    like any other. Components without variance (a share of the largest eigenvalue below double
    precision, as with constant or dependent dimensions, or fewer rows than dimensions) are left out,
    as they cannot be scaled. No rows, or rows that are all alike, give an empty result. ``deviation``
    is null where it does not fit 64 bits. Other columns are not read.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2**56)))
    held = stage(vectors.filter(x.isNotNull() & sound).select(F.col(id_col).alias("id"), x.alias("vec")), "vectors")
    id_type = held.schema["id"].dataType.simpleString()
    answer = WHITE.format(id=id_type)

    n = held.count()
    sums = held.select("vec").mapInArrow(_sum_dimensions, "dim int, seen long, total string")
    by_dim = sums.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("seen").alias("seen")).collect()
    if not by_dim or not n:
        return spark.createDataFrame([], answer + ", identity_error double")
    width = len(by_dim)
    total = [int(r["total"]) + (n - r["seen"]) * SHIFT for r in sorted(by_dim, key=lambda r: r["dim"])]
    nearest = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * q for s, q in zip(total, nearest)]
    centre = np.array(nearest, np.int64)

    parts = held.select("vec").mapInArrow(_multiply(width, centre), "dim int, high array<double>, low array<double>")
    added = parts.groupBy("dim").applyInArrow(_add_products, "dim int, high array<double>, low array<double>")
    rows = sorted(added.collect(), key=lambda r: r["dim"])
    products = np.array([r["high"] for r in rows], HIGH) + np.array([r["low"] for r in rows], HIGH)
    offset = np.array(rest, HIGH) / n
    values, frame = eigenvectors(products / n - np.outer(offset, offset))

    usable = int((values > max(values[0], 0) * width * np.finfo(float).eps).sum())
    first = min(components, usable)
    if not first:
        return spark.createDataFrame([], answer + ", identity_error double")
    share = (values[:first] / values.sum()).tolist()
    scaled = frame[:, :first] / np.sqrt(values[:first])
    done = held.mapInArrow(_project(width, n, centre, rest, scaled, share, _arrow_type(held)), answer)
    error = _identity_error(held, width, centre, offset.astype(float), scaled)
    return done.withColumn("identity_error", F.lit(error))


def _arrow_type(held: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(held.schema["id"].dataType)


def _identity_error(held: DataFrame, width: int, centre: np.ndarray, offset: np.ndarray, frame: np.ndarray) -> float:
    """Largest entry of the whitened vectors' own covariance, measured over all rows, less the identity.
    Products are centred in each slice and merged with the distance of the means."""
    components = frame.shape[1]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(components), np.zeros((components, components))
        for part in _slices(batches, max(width, components)):
            white = ((_integers(part.column("vec"), width) - centre) - offset) @ frame
            if len(white):
                around = white - white.mean(0)
                n, mean, products = _merged((n, mean, products), (len(white), white.mean(0), around.T @ around))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean], "products": [products.reshape(-1)]})

    columns = "n long, mean array<double>, products array<double>"
    by_task = held.select("vec").mapInArrow(moments, columns)
    few = by_task.groupBy((F.spark_partition_id() % 64).alias("part")).applyInArrow(_add_moments, columns)
    n, _, products = _sum_moments(few.collect())
    return float(np.abs(products / n - np.eye(components)).max())


def op12_whiten(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read_table(spark, folder, "embeddings"))
