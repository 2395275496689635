"""Embedding whitening: a distributed covariance, eigenvectors in float32, refined to double precision.

Vectors are put on a grid, x = floor(256 * c), so that equality, sums and deviations are exact integers. The fit
list is each distinct x vector once (distinct in Spark, combined before the shuffle, so a vector that a third of the
rows carry is one row a task). Its sums S and then its covariance, centred before multiplying, are added up in Arrow
batches; a square of the dimension is all that reaches the driver.

Eigenvectors come from a float32 solver. Ogita and Aishima's iteration then corrects all of them at once by matrix
products in extended precision (`np.longdouble`), converging quadratically: with R = I - X'X and S = X'AX the
correction X E has E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Pairs of eigenvalues nearer than the error bound would
divide by noise; they take E_ij = R_ij / 2, which makes them orthonormal only, and each such cluster is then solved
by itself: the small matrix X_c' (A - m I) X_c with the cluster's mean m taken out, so that its inner gaps show.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries or entries of 2^44 and more,
are dropped; vectors of each length are whitened among themselves; rows that repeat an id or a vector and null ids
are rows each; a component without variance (eigenvalue 0 up to rounding) has a null whitened value, `explained`
is null where no dimension varies, `identity_error` where no component does; `deviation` is null where the exact
sum does not fit into a long. Components have the sign that makes their largest entry positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import map_arrow, written

GRID = 256
COMPONENTS = 4
LARGEST = 2.0 ** 44            # entries from here on leave no room for exact sums
ROUNDS = 30


def grid_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", grid: int = GRID) -> DataFrame:
    """(_id, dim, x): the usable vectors as int64 grid points in bytes."""
    def run(batches):
        for b in batches:
            column = b.column("_vector")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            usable = np.abs(flat) < LARGEST                                    # false for NaN and infinities too
            wrong = np.concatenate([[0], np.cumsum(~usable)])
            keep = (sizes > 0) & (wrong[ends] == wrong[ends - sizes])
            x = np.floor(grid * flat[np.repeat(keep, sizes)]).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes[keep] * 8)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").filter(pa.array(keep)), pa.array(sizes[keep].astype(np.int32)),
                 pa.Array.from_buffers(pa.binary(), int(keep.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(x)])],
                names=["_id", "dim", "x"])

    id_type = rows.schema[id_col].dataType.simpleString()
    picked = rows.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"))
    return map_arrow(picked, run, f"_id {id_type}, dim int, x binary")


def _grids(batch: pa.RecordBatch):
    """(dim, rows of the batch, int64 matrix) for each vector length of a batch."""
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        data = b"".join(batch.column("x").take(pa.array(at)).to_pylist())
        yield d, at, np.frombuffer(data, np.int64).reshape(len(at), d)


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if len(x) * float(np.abs(x).max(initial=0)) < 2.0 ** 62:
        return [int(v) for v in x.sum(0)]
    return [int(v) for v in x.astype(object).sum(0)]


def fit_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length (n, S): the number of vectors and the exact sum of each dimension."""
    def run(batches):
        for b in batches:
            for d, _, x in _grids(b):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([len(x)] * d, pa.int64()),
                     pa.array(_exact_sums(x), pa.decimal128(38, 0))], names=["dim", "place", "n", "s"])

    sums = (map_arrow(fit, run, "dim int, place int, n long, s decimal(38,0)")
            .groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("dim", "place").collect():                           # one row a dimension
        out.setdefault(r["dim"], (int(r["n"]), []))[1].append(int(r["s"]))
    return out


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of (dim, sums array<double>) per dim: added in 16 tasks first, then on the driver."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, s in zip(b.column("dim").to_pylist(), b.column("sums")):
                total[d] = total.get(d, 0) + s.values.to_numpy().astype(np.longdouble)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([v.astype(np.float64) for v in total.values()], pa.list_(pa.float64()))], names=["dim", "sums"])

    out: dict[int, np.ndarray] = {}
    for r in map_arrow(parts.repartition(16, F.spark_partition_id() % 16), add, "dim int, sums array<double>").collect():
        out[r["dim"]] = out.get(r["dim"], 0) + np.array(r["sums"], np.longdouble)
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, rounded once where n * x fits into 64 bits."""
    if n * (float(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums), default=0) < 2.0 ** 62:
        return (n * x - np.array(sums, np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(np.float64)


def _scatter(fit: DataFrame, made) -> dict[int, np.ndarray]:
    """Per vector length the sum of m'm over the fit list, m = made(dim, x)."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _grids(b):
                m = made(d, x)
                total[d] = total.get(d, 0) + (m.T @ m).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array(list(total.values()), pa.list_(pa.float64()))], names=["dim", "sums"])

    sums = _added(map_arrow(fit, run, "dim int, sums array<double>"))
    return {d: s.reshape([int(round(len(s) ** 0.5))] * 2) for d, s in sums.items()}


def _clusters(values: np.ndarray, bound) -> list[slice]:
    """Runs of at least two falling values whose neighbours differ by `bound` at most."""
    near = np.concatenate([[False], values[:-1] - values[1:] <= bound, [False]])
    starts = np.flatnonzero(~near[:-1] & near[1:])
    ends = np.flatnonzero(near[:-1] & ~near[1:])
    return [slice(a, b + 1) for a, b in zip(starts, ends)]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns made orthonormal by Newton's iteration; x is nearly so."""
    for _ in range(4):
        x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, vectors in columns) of a symmetric matrix in double precision (see the module doc)."""
    a = np.asarray(matrix, np.longdouble)
    a = (a + a.T) / 2
    dim, top = len(a), np.abs(a).max(initial=0)
    if not dim or top == 0:
        return np.zeros(dim), np.eye(dim)
    scale = np.longdouble(2.0) ** np.ceil(np.log2(top))
    a = a / scale
    identity = np.eye(dim, dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm = np.sqrt((a * a).sum())
    for _ in range(ROUNDS):
        r, s = identity - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        bound = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        for c in _clusters(values, bound):
            y = _orthonormal(x[:, c])
            small = y.T @ a @ y
            small = (small + small.T) / 2 - np.mean(values[c]) * np.eye(small.shape[0], dtype=x.dtype)
            size = np.abs(small).max()
            if size > 0:
                y = y @ np.linalg.eigh((small / size).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
            x[:, c] = y
        if np.abs(step).max() < 1e-17 * dim:
            break
    x = _orthonormal(x)
    values = np.einsum("ij,ik,kj->j", x, a, x)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order] * scale
    return values.astype(np.float64), x.astype(np.float64)


def fit_model(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """Per vector length: n, S, axes, scales, shares of the variance and the measured error of the identity."""
    fit = written(vectors.sparkSession, vectors.select("dim", "x").distinct(), "whitening-fit")
    sums = fit_sums(fit)
    scatter = _scatter(fit, lambda d, x: centred(x, *sums[d]))
    model: dict[int, dict] = {}
    for d, (n, s) in sums.items():
        covariance = scatter[d] / n
        values, axes = eigenvectors(covariance)
        values, axes = values[:components], axes[:, :components]
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        trace = float(np.trace(covariance))
        varies = values > trace * d * 1e-15
        scales = np.where(varies, np.sqrt(np.where(varies, values, 1.0)), np.nan)
        model[d] = {"n": n, "sums": s, "axes": axes, "scales": scales,
                    "explained": [float(v) / trace if trace > 0 else None for v in np.maximum(values, 0)]}

    def varying(d, x):
        m = model[d]
        used = np.isfinite(m["scales"])
        return centred(x, m["n"], m["sums"]) @ (m["axes"][:, used] / m["scales"][used])

    for d, second in (_scatter(fit, varying) if model else {}).items():
        error = np.abs(second / model[d]["n"] - np.eye(len(second)))
        model[d]["error"] = float(error.max()) if error.size else None
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over the dimensions of (n * x - S)^2; None where it does not fit into a long."""
    most = n * (float(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums), default=0)
    if x.shape[1] * most * most < 2.0 ** 62:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    y = n * x.astype(object) - np.array(sums, object)
    return [v if v < 1 << 63 else None for v in (y * y).sum(1).tolist()]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           grid: int = GRID) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component."""
    spark = rows.sparkSession
    vectors = written(spark, grid_vectors(rows, id_col, vector_col, grid), "whitening-grid")
    model = fit_model(vectors, components)

    def run(batches):
        for b in batches:
            for d, at, x in _grids(b):
                m = model[d]
                k = m["axes"].shape[1]
                made = centred(x, m["n"], m["sums"]) @ m["axes"] / m["scales"]
                ids = b.column("_id").take(pa.array(np.repeat(at, k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, m["n"], np.int64)),
                     pa.array([v for v in deviations(x, m["n"], m["sums"]) for _ in range(k)], pa.int64()),
                     pa.array(made.ravel(), pa.float64(), from_pandas=True),
                     pa.array(m["explained"] * len(x), pa.float64()),
                     pa.array([m.get("error")] * (len(x) * k), pa.float64())],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = rows.schema[id_col].dataType.simpleString()
    return map_arrow(vectors, run, f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")
