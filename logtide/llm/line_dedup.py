"""Line dedup across documents: ranged hashes, secondary sort by document and position, keep bitmaps.

All of it is DataFrame operations. Every line of at least `least_chars` code points (after stripping
`[\\x20\\x09-\\x0D]` and lower-casing A-Z) becomes two independent 64-bit hashes with its document, the number of
the input split it came from and its position. These rows, never the texts, are range-partitioned by hash and split
and sorted by document, largest first, and position; a window streams over them and keeps the first occurrence in
each of the first `least_docs` documents of a hash and split. A line that a third of all documents hold is so at
most one split's rows in a task, and `least_docs` rows a split go on to the second step, which streams over the
hashes alone and finds those of enough documents and the one document that keeps its lines.

What comes back per document is its keep bitmap, run-length compressed: `dropped` holds (first, count) of every run
of lines that go, sorted; documents that lose nothing have no row. A bitmap belongs to a document id and a text
hash, as what a line's fate depends on is its key and its document's id.

Defined results: rows that share an id are one document, null ids together are one document, smaller than all
others; a null or empty text is one empty line; rows that repeat an id and a text get the same bitmap; an empty
table gives an empty table. Two different keys count as one if both 64-bit hashes collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import written

LEAST_CHARS = 20
LEAST_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keyed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h, g, split, doc, text_hash, pos) of every line that is long enough to count."""
    rows = docs.select(F.col(id_col).alias("doc"), _text(text_col).alias("_t"),
                       F.spark_partition_id().alias("split")).withColumn("text_hash", F.xxhash64("_t"))
    # the hash is taken below the explosion: above it would be taken of the whole text for each of its lines
    lines = rows.select("doc", "split", "text_hash", F.posexplode(F.split("_t", "\n")).alias("pos", "line"))
    keys = lines.select("doc", "split", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= least_chars).select(
        F.xxhash64("key").alias("h"), F.xxhash64(F.lit("line"), "key").alias("g"), "split", "doc", "text_hash", "pos")


def first_occurrences(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h, g, split, doc, place): a hash's first line in each of its `least_docs` largest documents of a split."""
    ranged = lines.select("h", "g", "split", "doc", "pos").repartitionByRange("h", "split")
    group = Window.partitionBy("h", "g", "split")
    sorted_lines = group.orderBy(F.desc("doc"), "pos")
    seen = (ranged.withColumn("row", F.row_number().over(sorted_lines))
            .withColumn("before", F.lag("doc").over(sorted_lines))
            .withColumn("place", F.dense_rank().over(group.orderBy(F.desc("doc")))))
    is_first = (F.col("row") == 1) | ~F.col("before").eqNullSafe(F.col("doc"))
    return seen.where(is_first & (F.col("place") <= least_docs)).select("h", "g", "split", "doc", "place")


def keepers(firsts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h, g, split, keeper) of every hash found in at least `least_docs` documents, for each split that holds it."""
    hashes = Window.partitionBy("h", "g")
    by_doc = hashes.orderBy(F.desc("doc"))
    ranked = (firsts.withColumn("rank", F.dense_rank().over(by_doc))
              .withColumn("keeper", F.first("doc").over(by_doc))
              .withColumn("docs", F.max("rank").over(hashes)))
    return ranked.where((F.col("docs") >= least_docs) & (F.col("place") == 1)).select("h", "g", "split", "keeper")


def _runs(positions: Column) -> Column:
    """Sorted positions as runs (first, count)."""
    def ends(step: int) -> Column:
        return F.filter(positions, lambda p, i: ~F.coalesce(F.get(positions, i + step), F.lit(-2)).eqNullSafe(p + step))

    return F.transform(F.arrays_zip(ends(-1).alias("a"), ends(1).alias("b")),
                       lambda r: F.struct(r["a"].alias("first"), (r["b"] - r["a"] + 1).alias("count")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc, text_hash, dropped array<struct<first, count>>, n_dropped) of every document that loses lines."""
    lines = written(docs.sparkSession, keyed_lines(docs, id_col, text_col, least_chars), "line-hashes")
    decided = keepers(first_occurrences(lines, least_docs), least_docs)
    gone = lines.join(decided, ["h", "g", "split"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return (gone.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
            .select("doc", "text_hash", _runs(F.col("positions")).alias("dropped"),
                    F.size("positions").alias("n_dropped")))


def _kept_text(text: Column, dropped: Column) -> Column:
    """`text` without the lines of the runs; the lines are split once."""
    def kept(lines: Column) -> Column:
        def upto(i: Column) -> Column:                    # lines before run i that run i - 1 has not taken
            last = F.get(dropped, i - 1)
            return F.coalesce(last["first"] + last["count"], F.lit(0))

        pieces = F.transform(dropped, lambda r, i: F.slice(lines, upto(i) + 1, r["first"] - upto(i)))
        tail = upto(F.size(dropped))
        return F.array_join(F.concat(F.flatten(pieces), F.slice(lines, tail + 1, F.size(lines) - tail)), "\n")

    return F.get(F.transform(F.array(F.split(text, "\n")), kept), F.lit(0))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, text): every row of `docs` with the lines that its bitmap keeps."""
    rows = docs.select(F.col(id_col), _text(text_col).alias("_t")).withColumn("_hash", F.xxhash64("_t"))
    found = rows.join(bitmaps, rows[id_col].eqNullSafe(bitmaps["doc"]) & (F.col("_hash") == F.col("text_hash")), "left")
    return found.select(
        rows[id_col], F.size(F.split("_t", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("_t")).otherwise(_kept_text(F.col("_t"), F.col("dropped"))).alias("text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, text) of every row: texts without the lines that other documents keep."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, least_chars, least_docs), id_col, text_col)
