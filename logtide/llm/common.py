"""Helpers the operators share: tables, shared folders, Arrow batches in bounded slices, seeded samples."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.session import scratch_path

SLICE_BYTES = 1 << 20
CHARS_SLICE_BYTES = 1 << 18          # for arrays over the characters, which take up to a hundred bytes each
SALTS = 256                          # tasks at most over which `attach` spreads the rows of one key
TOKEN_SLICE_BYTES = 2 << 20          # for tokenizers, whose pieces repeat more the larger the slice


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as `--py-files` would)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="logtide-py-"), "logtide_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """mapInArrow with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def freed(spark: SparkSession) -> None:
    """Let go of what finished jobs hold: Spark deletes a job's shuffle files when the driver collects its garbage; a
    chain of steps would otherwise hold those of all its jobs on the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    freed(spark)
    return spark.read.schema(df.schema).parquet(path)


def row_salt(*cols) -> Column:
    """A salt of each row by `cols`; by its position in the input where none are given (write it before use)."""
    return F.pmod(F.xxhash64(*cols) if cols else F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")


def attach(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` (with a column `salt`) inner joined to `values`, which has one row a key, however often a key occurs.

    The values go to the (key, salt) pairs that occur, which partial aggregation finds in each task: at most SALTS
    rows a key and one row a rare key. Rows then meet their own pair, so a key that a third of them hold is spread."""
    pairs = rows.select(*keys, "salt").distinct().join(values, keys)
    return rows.join(pairs, [*keys, "salt"])


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def one_text(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(columns of `ids`, text): of the rows that repeat one of the `ids` (few, in `_id`) the text of the least hash.

    Partial aggregation leaves one row an id in each task, however often a row repeats it.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return (texts.join(F.broadcast(ids), "_id").groupBy(*ids.columns)
            .agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.md5(F.col("_text").cast("binary")))).alias("_text")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, text) of at most `rows` labelled documents, chosen by a hash of the id.

    Only labels where `keep` holds are looked at; null labels are none, and of
    several labels of one id the largest counts, of several rows one. The chosen
    ids are at most `rows`, which bounds what is broadcast and what is returned.
    """
    known = (labels.where(keep & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
             .join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
             .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    return one_text(docs, known, id_col, text_col)


def slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about `budget` bytes of `column` (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes + 64) - 1) // budget
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, text_col: str,
              passed: list[str] = (), budget: int = CHARS_SLICE_BYTES) -> DataFrame:
    """mapInArrow over slices of about `budget` bytes: `fn(slice)` gives the new columns, `passed` columns go through."""
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in passed]

    def run(batches):
        for whole in batches:
            for part in slices(whole, text_col, budget):
                new = fn(part)
                names = [*passed, *new]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in passed]
                                                 + [v if isinstance(v, pa.Array) else pa.array(v)
                                                    for v in new.values()], names=names)

    return map_arrow(df, run, ", ".join([*kept, schema]))


def map_kept(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray], text_col: str) -> DataFrame:
    """The rows of `df`, all columns, for which `keep(slice)` is true."""
    def run(batches):
        for whole in batches:
            for part in slices(whole, text_col, CHARS_SLICE_BYTES):
                yield part.filter(pa.array(np.asarray(keep(part), bool)))

    return map_arrow(df, run, df.schema)
