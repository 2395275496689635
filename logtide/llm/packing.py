"""Best-fit packing of token sequences by patterns of lengths.

A document is its ids and one end id; only longer ones are cut, the first piece
taking the remainder, so every other piece fills a sequence. What remains is a
histogram of at most `limit` lengths. On it (and on it alone, so the driver's
work does not grow with the documents) patterns of few documents that fill a
sequence are enumerated, their repeat counts fitted by non-negative least
squares, rounded down, and what is left is packed best fit, longest first, again
as patterns with repeat counts.

A full piece is a sequence by itself and needs no rank: its (negative) number is
unique without one. Every other piece gets its rank among the pieces of its
length, and the rank names its pattern, repetition and place. A length is ranked
in as many blocks as its count asks for (block counts, a running sum over
blocks, row numbers inside a block), so a hot length spreads and a rare one is
one block.

Defined results: a null or empty text is its end id alone (one piece of length
1); repeated rows are packed each on its own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import TOKEN_SLICE_BYTES, map_arrow, slices, texts_of, written
from logtide.llm.pieces import shared_pieces

BLOCK_ROWS = 4096
PATTERN_DOCS = 4
SWEEPS = 40
_RANKS = 1 << 50           # ranks below this; lengths above it in the combined key


def cut_lengths(n: int, limit: int) -> list[int]:
    """Lengths of the pieces of `n` ids: the remainder first, then full ones."""
    first = n % limit or limit
    return [first] + [limit] * ((n - first) // limit)


def token_pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, piece, start, length, ids_crc32): the pieces of every document.

    `row` numbers the rows of the scan, so that repeated ids stay apart."""
    end = int(end_id).to_bytes(4, "little")

    def run(part):
        out = {"at": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for i, ids in enumerate(shared_pieces(tokenizer).encode(texts_of(part, "_text"))):
            ids += end
            start = 0
            for k, size in enumerate(cut_lengths(len(ids) // 4, limit)):
                for name, v in zip(out, (i, k, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]))):
                    out[name].append(v)
                start += size
        at = np.array(out.pop("at"), np.int64)
        return at, out

    def batches(it):
        for whole in it:
            for part in slices(whole, "_text", TOKEN_SLICE_BYTES):
                at, out = run(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(pa.array(at)), part.column("_row").take(pa.array(at)),
                     pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                     pa.array(out["length"], pa.int64()), pa.array(out["ids_crc32"], pa.int64())],
                    names=["_id", "_row", "piece", "start", "length", "ids_crc32"])

    texts = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"),
                        F.coalesce(text_col, F.lit("")).alias("_text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return map_arrow(texts, batches, f"_id {id_type}, _row long, piece int, start long, length long, ids_crc32 long")


def _enumerate(lengths: np.ndarray, limit: int) -> list[tuple[int, ...]]:
    """Patterns of 2 to PATTERN_DOCS lengths, each filled up with the longest length that fits."""
    found: set[tuple[int, ...]] = set()

    def longest(space: int) -> int | None:
        i = int(np.searchsorted(lengths, space, "right")) - 1
        return int(lengths[i]) if i >= 0 else None

    middles = [int(x) for x in lengths[np.unique(np.linspace(0, len(lengths) - 1, 24).astype(int))]]
    for a in map(int, lengths):
        starts = [(a,)] + [(a, b) for b in middles if a + b < limit]
        starts += [(a,) * k for k in range(2, PATTERN_DOCS) if a * k < limit]
        for start in starts:
            pattern, space = list(start), limit - sum(start)
            while space > 0 and len(pattern) < PATTERN_DOCS:
                x = longest(space)
                if x is None:
                    break
                pattern.append(x)
                space -= x
                if space and space < limit // 256:
                    break
            if len(pattern) > 1 and space <= limit // 256:
                found.add(tuple(sorted(pattern, reverse=True)))
    return sorted(found, key=lambda p: (limit - sum(p), len(p), p))


def _nonnegative_least_squares(patterns: list[dict[int, int]], counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |sum of patterns * x - counts| (coordinate descent)."""
    x = [0.0] * len(patterns)
    rest = counts.astype(float).tolist()
    norm = [float(sum(m * m for m in p.values())) for p in patterns]
    items = [list(p.items()) for p in patterns]
    for _ in range(SWEEPS):
        moved = 0.0
        for k, pattern in enumerate(items):
            step = 0.0
            for length, m in pattern:
                step += m * rest[length]
            step = max(step / norm[k], -x[k])
            if step:
                x[k] += step
                moved += abs(step)
                for length, m in pattern:
                    rest[length] -= m * step
        if moved < 1e-3 * max(1.0, sum(x)):
            break
    return np.array(x)


def plan(histogram: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, longest first; how often): together exactly the histogram."""
    left = np.zeros(limit + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    out: list[tuple[tuple[int, ...], int]] = []
    if left[limit]:
        out.append(((limit,), int(left[limit])))
        left[limit] = 0
    lengths = np.flatnonzero(left)
    patterns = _enumerate(lengths, limit) if len(lengths) else []
    parts = [Counter(p) for p in patterns]
    for pattern, part, x in zip(patterns, parts, _nonnegative_least_squares(parts, left)):
        n = min([int(x), *(int(left[length]) // m for length, m in part.items())])
        if n > 0:
            out.append((pattern, n))
            for length, m in part.items():
                left[length] -= m * n
    # residuals: best fit, longest first, as often as the counts allow
    lengths = np.flatnonzero(left)
    while len(lengths):
        pattern, space = [], limit
        taken: Counter = Counter()
        top = len(lengths) - 1
        while top >= 0:
            top = min(top, int(np.searchsorted(lengths, space, "right")) - 1)
            while top >= 0 and left[lengths[top]] <= taken[int(lengths[top])]:
                top -= 1
            if top < 0:
                break
            length = int(lengths[top])
            m = min(space // length, int(left[length]) - taken[length])
            pattern += [length] * m
            taken[length] += m
            space -= m * length
        n = min(int(left[length]) // m for length, m in taken.items())
        out.append((tuple(pattern), n))
        for length, m in taken.items():
            left[length] -= m * n
        lengths = lengths[left[lengths] > 0]
    return out


def places(planned: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan as sorted runs of ranks: key (length, first rank), slots per sequence, first sequence, offsets."""
    next_rank: Counter = Counter()
    rows, offsets, sequence = [], [], 0
    for pattern, n in planned:
        slots: dict[int, list[int]] = {}
        at = 0
        for length in pattern:
            slots.setdefault(length, []).append(at)
            at += length
        for length, own in slots.items():
            rows.append((length * _RANKS + next_rank[length], len(own), sequence, len(offsets)))
            offsets += own
            next_rank[length] += n * len(own)
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": table[:, 0], "slots": table[:, 1], "sequence": table[:, 2], "offsets_at": table[:, 3],
            "offsets": np.array(offsets, np.int64)}


def place(runs: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence_id, offset) of the pieces with these lengths and ranks."""
    key = length.astype(np.int64) * _RANKS + rank
    i = np.searchsorted(runs["key"], key, "right") - 1
    k = key - runs["key"][i]
    slots = runs["slots"][i]
    return runs["sequence"][i] + k // slots, runs["offsets"][runs["offsets_at"][i] + k % slots]


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """pieces plus rank: 0, 1, ... among the pieces of the same length, without one task per length.

    `histogram` has every length's count; the table of blocks has a row a length."""
    blocks = pieces.sparkSession.createDataFrame(pa.table(       # from a list, Python workers of their own would read it
        {"length": pa.array(list(histogram), pa.int64()),
         "blocks": pa.array([-(-n // BLOCK_ROWS) for n in histogram.values()], pa.int64())}))
    keyed = (pieces.join(F.broadcast(blocks), "length")
             .withColumn("block", F.pmod(F.xxhash64("_row", "piece"), F.col("blocks"))).drop("blocks"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("rank_from", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("length", "block").orderBy("_row", "piece")
    return (keyed.withColumn("row_in_block", F.row_number().over(inside) - 1)
            .join(offsets.hint("shuffle_hash"), ["length", "block"])
            .withColumn("rank", F.col("rank_from") + F.col("row_in_block")))


def pack(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece."""
    pieces = written(docs.sparkSession, token_pieces(docs, tokenizer, limit, end_id, id_col, text_col), "pieces")
    rest = pieces.where(F.col("length") < limit)
    histogram = {r["length"]: r["n"] for r in          # fewer than `limit` rows
                 rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = places(plan(histogram, limit))

    def run(it):
        for b in it:
            s, o = place(runs, b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(s), pa.array(o)],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    cols = ["_id", "piece", "start", "length", "ids_crc32"]
    id_type = pieces.schema["_id"].dataType.simpleString()
    placed = map_arrow(
        ranked(rest, histogram).select(*cols, "rank"), run,
        f"_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    full = pieces.where(F.col("length") == limit).select(
        *cols, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full).withColumnRenamed("_id", id_col)
