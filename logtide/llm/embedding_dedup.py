"""Embedding near-duplicates: blocks of vectors that links can join, then tiled cosine comparison inside them.

Equal vectors are collapsed first (a vector that a third of the rows carry is one
row with a weight). Vectors lie in the shared folder once, in the precision of the input.

Blocks. A trial deals every vector out once, by the signs of its products with a few random directions, to a
bucket; inside it, vectors that share one of TABLES sketches of signs are compared, and those that link are one
from then on. So many trials are made that a pair that just links misses all of them with odds of MISS at most
(nearer pairs far less), whatever the vectors are: the odds are over the directions. Two trials are on disk at a
time, and their number grows with the logarithm of the rows. The components of all trials' links are the blocks,
so a link that every trial missed matters only where no chain of others joins its ends.

Links. Linked vectors lie in one block, so only blocks are compared pairwise: small ones together in a cell, and
a cell of many vectors cut into parts that meet pairwise, in rounds of bounded size. Vectors near the middle of a
tile pair all link with each other, by the triangle inequality. The others, unit length in double precision, are
turned into the basis of the principal components, largest variance first; the covariance is summed over all
vectors by partial sums, so only a square of the dimension reaches the driver. The products of the leading
dimensions are accumulated block by block; Cauchy-Schwarz bounds what the rest can add by the product of the
suffix norms, and a pair stops when its bound cannot reach the threshold. Pairs left within rounding of it are
decided on the original vectors. A tile pair returns, per vector, how many vectors it links with and a member of
its component there, never the pairs themselves, so a large group of near copies costs rows in proportion to its
members and parts.

Defined results: null vectors, zero vectors and vectors with a null or
non-finite component link with nothing (n_links 0, a component of their own);
vectors of different length never link; rows without an id count as links but
have a null component; rows that repeat an id are vectors each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from logtide.llm.common import attach, freed, map_arrow, row_salt, written
from logtide.llm.graph import components

THRESHOLD = 0.95
TILE = 8192                # vectors of WIDE dimensions, or fewer, in a part
PRODUCTS = 1 << 22         # of a matrix at a time
STEP = 8                   # dimensions accumulated at a time
SLACK = 1e-9               # pairs this near to the threshold are decided on the original vectors

MISS = 1e-12               # odds that no trial brings a pair at the threshold together
GRID = 32767               # unit vectors in 16 bits a number; those are for candidates only
SPLIT = 1 << 18            # vectors of WIDE dimensions that a bucket is to hold
WIDE = 64
TABLES, BITS = 8, 16       # sketches of a trial inside its bucket, bits of each at most
CLOSE = 32                 # neighbours in a table's order that are compared one by one; longer runs by matrix products
STRAY = 1e-3               # odds, beside those, that a pair's other signs differ too much to be looked at
DEALT_BYTES = 1 << 28      # dealt out by one job; of larger tables two trials
GATHERED = 8 << 20         # bytes of vectors dealt out at a time
SLAB = 1 << 11            # rows multiplied at a time
PACKED = 1 << 19           # bytes of vectors in a row
SEED = 7


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, row after row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], wide)[column.offset:column.offset + len(column) + 1] if len(column) else [0]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, np.uint8)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors of `dim` numbers, in the precision they were written in."""
    data = _bytes(column)
    return data.view(np.float32 if len(data) == 4 * dim * len(column) else np.float64).reshape(len(column), dim)


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, dim, vector): vectors as bytes, floats as floats and all else in double precision; null where the row
    links with nothing."""
    single = isinstance(rows.select(vector_col).schema[0].dataType.elementType, FloatType)
    kind = np.float32 if single else np.float64

    def run(batches):
        for b in batches:
            lists = b.column("_vector")
            flat = pc.fill_null(lists.flatten(), np.nan).to_numpy(zero_copy_only=False) + kind(0)   # -0.0 and 0.0 are one
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            start = np.cumsum(sizes) - sizes
            out = [None] * len(sizes)
            for d in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == d)
                x = flat[start[at][:, None] + np.arange(d)]
                good = np.isfinite(x).all(1) & x.any(1)
                at, x = at[good], x[good]
                with np.errstate(over="ignore"):
                    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
                odd = ~np.isfinite(norm) | (norm <= 1e-150)      # of doubles only
                x[odd] /= np.abs(x[odd]).max(1, keepdims=True)
                data, width = x.tobytes(), d * x.itemsize
                for k, i in enumerate(at.tolist()):
                    out[i] = data[k * width:(k + 1) * width]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array([None if x is None else len(x) // flat.itemsize for x in out], pa.int32()),
                 pa.array(out, pa.binary())], names=["_id", "dim", "vector"])

    picked = rows.select(F.col(id_col).cast("long").alias("_id"),
                         F.col(vector_col).cast("array<float>" if single else "array<double>").alias("_vector"))
    return map_arrow(picked, run, "_id long, dim int, vector binary")


def unit(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    return m / np.sqrt((m * m).sum(1))[:, None]


def _gathered(pieces: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, groups, vectors) put together to GATHERED bytes, as far as there are so many of a dimension."""
    held: dict[int, list] = {}
    for d, group, x in pieces:
        held.setdefault(d, []).append((group, x))
        if sum(m.nbytes for _, m in held[d]) >= GATHERED:
            yield d, *(np.concatenate(p) for p in zip(*held.pop(d)))
    for d, h in held.items():
        yield d, *(np.concatenate(p) for p in zip(*h))


def unit_rows(groups: DataFrame) -> DataFrame:
    """(dim, groups, units): unit vectors in steps of 1 / GRID, many to a row."""
    def pieces(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                at = pa.array(dims == d)
                x = unit(_matrix(b.column("vector").filter(at), d))
                yield d, b.column("group").filter(at).to_numpy(), np.rint(x * GRID).astype(np.int16)

    def run(batches):
        for d, group, x in _gathered(pieces(batches)):
            step = max(1, PACKED // (2 * d))
            for lo in range(0, len(x), step):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d], pa.int32()), pa.array([group[lo:lo + step].tobytes()], pa.binary()),
                     pa.array([x[lo:lo + step].tobytes()], pa.binary())], names=["dim", "groups", "units"])

    return map_arrow(groups.select("group", "dim", "vector"), run, "dim int, groups binary, units binary")


def _unpacked(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for b in batches:
        for d, g, u in zip(b.column("dim").to_pylist(), b.column("groups"), b.column("units")):
            yield d, np.frombuffer(g.as_buffer(), np.int64), np.frombuffer(u.as_buffer(), np.int16).reshape(-1, d)


def principal_axes(units: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension the axes (columns, largest variance first) over all unit vectors.

    One row of sums per partition and dimension reaches the driver's final addition by a second aggregation."""
    def run(batches):
        sums: dict[int, list] = {}
        for d, _, x in _unpacked(batches):
            m = x / GRID
            s = sums.setdefault(d, [0, np.zeros(d), np.zeros((d, d))])
            s[0] += len(m)
            s[1] += m.sum(0)
            s[2] += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.concatenate([[s[0]], s[1], s[2].ravel()]) for s in sums.values()], pa.list_(pa.float64()))],
            names=["dim", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, s in zip(b.column("dim").to_pylist(), b.column("sums")):
                sums[d] = sums.get(d, 0) + s.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["dim", "sums"])

    schema = "dim int, sums array<double>"
    partial = map_arrow(units, run, schema)
    total = map_arrow(partial.repartition(16, F.spark_partition_id() % 16), add, schema)
    sums: dict[int, np.ndarray] = {}
    for r in total.collect():                   # 16 rows of dim * (dim + 1) numbers per dimension at most
        sums[r["dim"]] = sums.get(r["dim"], 0) + np.array(r["sums"])
    out = {}
    for d, s in sums.items():
        mean, second = s[1:d + 1] / s[0], s[d + 1:].reshape(d, d) / s[0]
        _, axes = np.linalg.eigh(second - np.outer(mean, mean))
        out[d] = (np.ascontiguousarray(axes[:, ::-1]), mean)
    return out


def close_pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with cosine >= threshold; a and b are unit rows in the order of the principal components."""
    dim = a.shape[1]
    tail_a = np.sqrt(np.maximum(np.cumsum((a * a)[:, ::-1], 1)[:, ::-1], 0))
    tail_b = np.sqrt(np.maximum(np.cumsum((b * b)[:, ::-1], 1)[:, ::-1], 0))
    found_i, found_j = [], []
    rows = max(1, PRODUCTS // max(1, len(b)))
    for top in range(0, len(a), rows):
        sums = a[top:top + rows, :STEP] @ b[:, :STEP].T
        bound = sums if dim <= STEP else sums + np.outer(tail_a[top:top + rows, STEP], tail_b[:, STEP])
        i, j = np.nonzero(bound >= threshold - SLACK)
        whole = dim > STEP and 20 * len(i) > sums.size           # so many are left that one product of all is less
        if whole:
            sums = a[top:top + rows] @ b.T
            i, j = np.nonzero(sums >= threshold - SLACK)
        for at in range(0, len(i), 1 << 16):
            p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            s = sums[p, q]
            p = p + top
            for lo in range(dim if whole else STEP, dim, STEP):
                hi = min(lo + STEP, dim)
                s = s + (a[p, lo:hi] * b[q, lo:hi]).sum(1)
                bound = s + tail_a[p, hi] * tail_b[q, hi] if hi < dim else s
                on = bound >= threshold - SLACK
                p, q, s = p[on], q[on], s[on]
            near = np.abs(s - threshold) <= SLACK
            if near.any():                      # too near to call in the turned basis
                x, y = raw_a[p[near]], raw_b[q[near]]
                s[near] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            on = s >= threshold
            found_i.append(p[on])
            found_j.append(q[on])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.zeros(0, np.int64),) * 2


def tile_roots(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """Least index of each index's component under the pairs (i, j)."""
    low = np.arange(size)
    while True:
        least = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _leading(rows: int) -> int:
    """Leading signs of a trial that name a vector's bucket."""
    return max(0, math.ceil(math.log2(max(rows, 1) / SPLIT)))


def trial_plan(threshold: float, leading: int, dim: int) -> tuple[int, int, int]:
    """(trials, bits of a sketch, signs that may differ): random directions part a pair with odds of its angle over pi,
    each anew. `dim` is the largest; steps of 1 / GRID turn a vector by half its root of them at most."""
    angle = math.acos(min(1.0, max(-1.0, threshold))) + 1.01 * math.sqrt(dim) / GRID
    same = max(1e-2, 1 - angle / math.pi)
    bits = min(BITS, max(1, round(math.log(0.18) / math.log(same))))
    rest, part = TABLES * BITS - bits, 1 - same
    apart = math.ceil(rest * part)
    while apart < rest and rest * sum(x * math.log(x / y) for x, y in (
            ((apart + 1) / rest, part), (1 - (apart + 1) / rest, same)) if x) < -math.log(STRAY):    # Chernoff's bound
        apart += 1
    found = same ** leading * (1 - (1 - same ** bits) ** TABLES) * (1 - STRAY)
    return math.ceil(math.log(MISS) / math.log1p(-found)), bits, apart


def _by_tile(tiles: DataFrame, size: float) -> DataFrame:
    """`tiles` (of `size` bytes) with the rows of a tile together, 32 MB to a task or less."""
    tasks = math.ceil(size / (32 << 20))
    most = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tiles.repartition(tasks, "tile") if tasks > most else tiles.repartition("tile")).sortWithinPartitions("tile")


def _directions(trial: int, dim: int, leading: int) -> np.ndarray:
    """Columns of random directions, those of the bucket first."""
    return np.random.default_rng([SEED, trial, dim]).standard_normal((dim, leading + TABLES * BITS)).astype(np.float32)


def _buckets(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return (x @ directions > 0).astype(np.int64) @ (1 << np.arange(directions.shape[1]))


def _crowded(units: DataFrame, trials: int, leading: int) -> dict[tuple[int, int, int], int]:
    """(trial, dim, bucket) to its parts, for buckets of far more vectors than SPLIT."""
    if not leading:
        return {}

    def run(batches):
        turns: dict[tuple[int, int], np.ndarray] = {}
        for d, _, x in _gathered(_unpacked(batches)):
            x = x.astype(np.float32)
            for t in range(trials):
                if (t, d) not in turns:
                    turns[t, d] = _directions(t, d, leading)[:, :leading]
                bucket, n = np.unique(_buckets(x, turns[t, d]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), t), pa.int32()), pa.array(np.full(len(n), d), pa.int32()),
                                                  pa.array(bucket), pa.array(n.astype(np.int64))], names=["trial", "dim", "bucket", "n"])

    counts = (map_arrow(units, run, "trial int, dim int, bucket long, n long")
              .groupBy("trial", "dim", "bucket").agg(F.sum("n").alias("n")))
    return {(r["trial"], r["dim"], r["bucket"]): math.ceil(r["n"] * r["dim"] / (WIDE * SPLIT))
            for r in counts.where(F.col("n") * F.col("dim") > 4 * WIDE * SPLIT).collect()}


def _trial_tiles(units: DataFrame, trials: range, leading: int, crowded: dict) -> DataFrame:
    """(tile, trial, dim, groups, units): for each of `trials` every vector in its bucket, many to a row.

    Parts of a crowded bucket meet pairwise, two in a tile."""
    def run(batches):
        for d, group, x in _gathered(_unpacked(batches)):
            numbers = x.astype(np.float32)
            for t in trials:
                bucket = _buckets(numbers, _directions(t, d, leading)[:, :leading])
                order = np.argsort(bucket, kind="stable")
                bucket, dealt_group, dealt_x = bucket[order], group[order], x[order]
                cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
                rows = []
                for lo, hi in zip(cut, cut[1:]):
                    k, g_of, x_of = int(bucket[lo]), dealt_group[lo:hi], dealt_x[lo:hi]
                    parts = crowded.get((t, d, k), 1)
                    for p in range(parts):
                        own = slice(None) if parts == 1 else g_of % parts == p
                        g, v = g_of[own].tobytes(), x_of[own].tobytes()
                        if not g:
                            continue
                        rows += [(f"{t},{d},{k},{min(p, q)},{max(p, q)}", g, v) for q in range(parts) if q != p or parts == 1]
                        if sum(len(r[2]) for r in rows) >= 2 * GATHERED:
                            yield batch(rows, t, d)
                            rows = []
                if rows:
                    yield batch(rows, t, d)

    def batch(rows, t, d):
        tile, g, v = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(tile), pa.array([t] * len(tile), pa.int32()), pa.array([d] * len(tile), pa.int32()),
             pa.array(g, pa.binary()), pa.array(v, pa.binary())], names=["tile", "trial", "dim", "groups", "units"])

    return map_arrow(units, run, "tile string, trial int, dim int, groups binary, units binary")


def sketch_roots(x: np.ndarray, signs: np.ndarray, bits: int, apart: int, least: float) -> np.ndarray:
    """Least index of each row's component under the pairs with a product of `least` that share the first `bits` signs of
    one of the tables; neighbours in a table are looked at if no more than `apart` of all their signs (packed) differ."""
    size = len(x)
    words = [np.ascontiguousarray(w) for w in signs.view(np.uint64).T]
    sketches = signs.view(">u2").T.astype(np.uint16, order="C") >> (BITS - bits)
    root = np.arange(size)

    def joined(found: list) -> np.ndarray:
        if not found:
            return root
        ends = np.concatenate([root[np.concatenate(f)] for f in zip(*found)])
        some, at = np.unique(ends, return_inverse=True)
        low = np.arange(size)
        low[some] = some[tile_roots(*np.split(at, 2), len(some))]
        return low[root]

    for key in sketches:
        order = np.argsort(key, kind="stable")
        first = np.concatenate([[0], np.flatnonzero(np.diff(key[order])) + 1]) if size else np.zeros(0, np.int64)
        length = np.diff(np.concatenate([first, [size]]))
        left = np.repeat(first + length, length) - np.arange(size)       # rows of the run from here on
        ordered = [w[order] for w in words]
        found = []
        at = np.arange(size)
        for step in range(1, CLOSE + 1):
            many = 4 * len(at) > size                        # then slices cost less than picked rows
            here, there = (slice(size - step), slice(step, size)) if many else (at, at + step)
            near = sum(np.bitwise_count(w[here] ^ w[there]) for w in ordered) <= apart
            near = np.flatnonzero(near & (left[:size - step] > step)) if many else at[near]
            at = np.flatnonzero(left > step + 1) if many else at[left[at] > step + 1]
            a, b = order[near], order[near + step]
            on = root[a] != root[b]
            a, b = a[on], b[on]
            for lo in range(0, len(a), 1 << 14):
                p, q = a[lo:lo + (1 << 14)], b[lo:lo + (1 << 14)]
                on = np.einsum("ij,ij->i", x[p].astype(np.float32), x[q].astype(np.float32)) >= least
                if on.any():
                    found.append((p[on], q[on]))
            if not len(at):
                break
        root = joined(found)
        found = []
        for f, n in zip(first[length > CLOSE + 1].tolist(), length[length > CLOSE + 1].tolist()):
            run = order[f:f + n]
            if (root[run] == root[run[0]]).all():
                continue
            _, kind, counts = np.unique(root[run], return_inverse=True, return_counts=True)
            rest = run[kind != counts.argmax()]           # a pair that is not yet joined has one of these
            numbers = x[run].astype(np.float32).T
            for lo in range(0, len(rest), rows := max(1, (1 << 21) // n)):
                some = rest[lo:lo + rows]
                i, j = np.nonzero(x[some].astype(np.float32) @ numbers >= least)
                p, q = some[i], run[j]
                on = root[p] != root[q]
                if on.any():
                    _, one = np.unique(root[p[on]] * size + root[q[on]], return_index=True)
                    found.append((p[on][one], q[on][one]))
        root = joined(found)
    return root


def near_blocks(units: DataFrame, threshold: float, numbers: int, dim: int, name: str = "vector-blocks") -> DataFrame:
    """(node, root) of every vector of `units` that links with another: its block, named by the least member.

    `numbers` is the sum of all dimensions, `dim` the largest."""
    spark = units.sparkSession
    leading = _leading(numbers / WIDE)
    trials, bits, apart = trial_plan(threshold, leading, dim)
    crowded = _crowded(units, trials, leading)

    def tile_edges(trial: int, dim: int, held: list) -> pa.RecordBatch:
        group = np.frombuffer(b"".join(g for g, _ in held), np.int64)
        x = np.frombuffer(b"".join(u for _, u in held), np.int16).reshape(len(group), dim)
        turn = _directions(trial, dim, leading)[:, leading:]
        signs = np.concatenate([np.packbits(x[lo:lo + SLAB].astype(np.float32) @ turn > 0, axis=1)
                                for lo in range(0, len(x), SLAB)])
        # a link's product can be less by the steps and by rounding in single precision
        least = threshold - 1.01 * math.sqrt(dim) / GRID - 1e-5 - 1.2e-7 * dim
        root = sketch_roots(x, signs, bits, apart, least * GRID * GRID)
        new = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(group[new]), pa.array(group[root[new]])], names=["a", "b"])

    def run(batches):
        held, name = [], None
        for b in batches:
            for tile, t, d, g, v in zip(*(b.column(c) for c in ("tile", "trial", "dim", "groups", "units"))):
                if (this := (tile.as_py(), t.as_py(), d.as_py())) != name:
                    if held:
                        yield tile_edges(*name[1:], held)
                    held, name = [], this
                held.append((g.as_buffer(), v.as_buffer()))
        if held:
            yield tile_edges(*name[1:], held)

    each = max(2, DEALT_BYTES // max(1, 2 * numbers))
    edges = None
    for lo in range(0, trials, each):
        tiles = _trial_tiles(units, range(lo, min(lo + each, trials)), leading, crowded)
        found = written(spark, map_arrow(_by_tile(tiles, each * 2 * numbers), run, "a long, b long").distinct(), name)
        edges = found if edges is None else edges.unionByName(found)
        del tiles
        freed(spark)
    return components(edges, name)


def _members(groups: DataFrame, blocks: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(group, weight, dim, vector, cell, part, parts) of every vector of `blocks`, and (cell, rows, parts).

    A block of over half a part (of `most` vectors) is a cell, smaller ones share one; parts of a cell meet pairwise."""
    blocks = blocks.select(F.col("node").alias("group"), "root", row_salt("node").alias("salt"))
    small = max(1, math.ceil(16 * blocks.count() / most))
    placed = (attach(blocks, blocks.groupBy("root").agg(F.count(F.lit(1)).alias("n")), ["root"])
              .select("group", "salt", F.when(F.col("n") > most // 2, -1 - F.col("root"))
                      .otherwise(F.pmod(F.xxhash64("root"), F.lit(small))).alias("cell")))
    placed = written(groups.sparkSession, placed, "vector-cells")
    cells = written(groups.sparkSession, placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
                    .withColumn("parts", F.ceil(F.col("rows") / most).cast("int")), "vector-cells")
    placed = attach(placed, cells, ["cell"]).select(
        "group", "cell", F.pmod(F.xxhash64("group"), F.col("parts")).cast("int").alias("part"), "parts")
    return written(groups.sparkSession, groups.join(placed, "group").select(
        "group", "weight", "dim", "vector", "cell", "part", "parts"), "vector-members"), cells


def _dealt(members: DataFrame, lo: int, hi: int) -> DataFrame:
    """(tile, left, alone, dim, group, weight, vector): every vector in each pair of parts that it takes part in and
    whose distance around the cell's ring of parts is in [lo, hi)."""
    there = F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.least(
        F.pmod(p - F.col("part"), F.col("parts")), F.pmod(F.col("part") - p, F.col("parts"))).between(lo, hi - 1)))
    return (members.select("group", "weight", "vector", "dim", "cell", "part", there.alias("there"))
            .select(F.concat_ws("/", "dim", "cell", F.least("part", "there"), F.greatest("part", "there")).alias("tile"),
                    (F.col("part") <= F.col("there")).alias("left"), (F.col("part") == F.col("there")).alias("alone"),
                    "dim", "group", "weight", "vector"))


def tile_links(raw: np.ndarray, turn: np.ndarray, weight: np.ndarray, left: np.ndarray, alone: bool,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) per row of a tile: the rows it links with, of the other part if not `alone`, and its component.

    Rows so near to the rows' mean direction that any two of them must link (twice that distance is within the
    threshold's) are counted together; pairs with another row are compared."""
    size = len(raw)
    unit_rows = unit(raw)
    turned = unit_rows @ turn
    middle = unit_rows.sum(0)
    length = np.sqrt((middle * middle).sum())
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 - 1e-6
    core = np.zeros(size, bool)
    if length > 0 and reach > 0:
        core = unit_rows @ (middle / length) >= 1 - reach * reach / 2
    sides = [np.ones(size, bool)] * 2 if alone else [left, ~left]
    links, pairs = np.zeros(size), []
    for own, other in (sides[:1] * 2,) if alone else (sides, sides[::-1]):
        links += np.where(core & own, weight[core & other].sum() - (weight if alone else 0), 0)
    for on_x, on_y in (sides[0] & ~core, sides[1]), (sides[0] & core, sides[1] & ~core):
        x, y = np.flatnonzero(on_x), np.flatnonzero(on_y)
        if alone and core[x].any():
            continue                                          # the first of the two has these, turned about
        if len(x) and len(y):
            i, j = close_pairs(turned[x], turned[y], raw[x], raw[y], threshold)
            i, j = x[i], y[j]
            if alone:
                once = (i < j) | core[j]
                i, j = i[once], j[once]
            links += np.bincount(i, weight[j], size) + np.bincount(j, weight[i], size)
            pairs.append((i, j))
    star = np.flatnonzero(core)
    i, j = (np.concatenate(p) for p in zip(*pairs, (star, star[np.zeros(len(star), np.int64)])))
    return links.astype(np.int64), tile_roots(i, j, size)


def link_sums(groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links) per distinct vector of `groups` and tile pair in which it links: a itself, b a
    vector of its component there, the same for all, links the rows that it links with there."""
    rows, numbers, dim = groups.agg(F.count(F.lit(1)), *(F.coalesce(f("dim"), F.lit(0)) for f in (F.sum, F.max))).first()
    units = written(groups.sparkSession, unit_rows(groups), "vector-units")
    axes = principal_axes(units)
    most = max(1, min(TILE, TILE * WIDE * rows // max(1, numbers)))
    members, cells = _members(groups, near_blocks(units, threshold, numbers, dim), most)
    dealt, parts = cells.agg(F.coalesce(F.sum(F.col("rows") * F.col("parts")), F.lit(0)), F.coalesce(F.max("parts"), F.lit(1))).first()

    def tile_pairs(t: pa.Table) -> pa.RecordBatch:
        group, weight = t.column("group").to_numpy(), t.column("weight").to_numpy()
        alone, dim = t.column("alone")[0].as_py(), t.column("dim")[0].as_py()
        raw = _matrix(t.column("vector"), dim).astype(np.float64)
        links, root = tile_links(raw, axes[dim][0], weight, t.column("left").to_numpy(), alone, threshold)
        linked = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(group[linked]), pa.array(group[root[linked]]), pa.array(links[linked])],
                                          names=["a", "b", "links"])

    def run(batches):
        held, name = [], None
        for batch in batches:
            tile = np.array(batch.column("tile").to_pylist(), object)
            cut = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
            for s, e in zip(cut, cut[1:]):
                if e == s:
                    continue
                if tile[s] != name:
                    if held:
                        yield tile_pairs(pa.Table.from_batches(held))
                    held, name = [], tile[s]
                held.append(batch.slice(s, e - s))
        if held:
            yield tile_pairs(pa.Table.from_batches(held))

    # parts that meet pairwise are dealt out in rounds, each of about as many bytes as the vectors' at most twice
    rounds = math.ceil(dealt * numbers / max(1, rows) * 4 / max(DEALT_BYTES, 8 * numbers))
    width = math.ceil((parts // 2 + 1) / max(1, rounds))
    sums = None
    for lo in range(0, parts // 2 + 1, width):
        tiles = _dealt(members, lo, lo + width)
        found = written(groups.sparkSession, map_arrow(_by_tile(tiles, dealt * numbers / max(1, rows) * 4 / max(1, rounds)), run,
                                                       "a long, b long, links long"), "vector-links")
        sums = found if sums is None else sums.unionByName(found)
        del tiles
        freed(groups.sparkSession)
    return sums


def embedding_links(rows: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per row of `rows`."""
    spark = rows.sparkSession
    usable = usable_vectors(rows, id_col, vector_col).withColumn("digest", F.unhex(F.sha2("vector", 256)))
    vectors = written(spark, usable.select("_id", "digest").withColumn("salt", row_salt()), "vectors")
    # equal vectors are one group, numbered by a block-free unique number; `low` is its least id
    groups = written(spark, usable.where("vector IS NOT NULL").groupBy("vector", "dim", "digest")
                     .agg(F.count(F.lit(1)).alias("weight"), F.min("_id").alias("low"))
                     .withColumn("group", F.monotonically_increasing_id()), "vector-groups")
    sums = link_sums(groups.select("group", "weight", "dim", "vector"), threshold)
    links = sums.groupBy(F.col("a").alias("group")).agg(F.sum("links").alias("others"))
    roots = components(sums.select("a", "b"), "vector-star")
    named = (groups.select("digest", "group", "weight", "low").join(links, "group", "left")
             .join(roots.withColumnRenamed("node", "group"), "group", "left")
             .withColumn("root", F.coalesce("root", "group"))
             .withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("weight") - 1))
    named = written(spark, named, "vector-named")
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = named.join(least, "root").select("digest", "n_links", "component_id")
    linked = (attach(vectors.where("digest IS NOT NULL"), labels, ["digest"])
              .select("_id", "n_links", "component_id"))
    alone = vectors.where("digest IS NULL").select("_id", F.lit(0).cast("long").alias("n_links"),
                                                   F.col("_id").alias("component_id"))
    return (linked.unionByName(alone).withColumn("component_id", F.when(F.col("_id").isNotNull(), F.col("component_id")))
            .withColumn("kept", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)))
            .withColumnRenamed("_id", id_col))
