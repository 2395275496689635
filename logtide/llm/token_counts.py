"""Token counts through a digest cache.

The cache is a Parquet table (content, version, n_tokens): content is the
SHA-256 of the text (a null text counts as empty; nothing else is normalised,
as any other change could change the count), version the digest of the
tokenizer file. Documents are joined to stored counts; of the contents that are
not stored, one document each is encoded, whole, and the counts are appended.

A Bloom filter of fixed size holds the contents that several documents share or
that are stored; a document outside it is surely the only one of a miss and is
encoded where it is read. Only the others cross the network, once, to the exact
choice of one document per miss. Stored counts are first reduced to the contents
of these documents; the join back to them is salted by row, so a content that a
third of the documents share spreads, also under one id or none.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
and null ids give one row each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm.common import TOKEN_SLICE_BYTES, attach, map_texts, row_salt, texts_of, written
from logtide.llm.pieces import shared_pieces, tokenizer_version
from logtide.llm.url_filter import possible_rows

CACHE_SCHEMA = "content string, version string, n_tokens long"


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored (content, n_tokens) of one tokenizer version; empty where nothing is stored yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("version")
    return (spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("version") == version)
            .select("content", "n_tokens").dropDuplicates(["content"]))


def _encode(texts: DataFrame, tokenizer: str) -> DataFrame:
    def run(part):
        ids = shared_pieces(tokenizer).encode(texts_of(part, "_text"))
        return {"n_tokens": np.array([len(i) // 4 for i in ids], np.int64)}

    return map_texts(texts.select("content", "_text"), run, "n_tokens long", "_text", ["content"],
                     TOKEN_SLICE_BYTES)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per document; misses are appended to the table at `cache`."""
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")) \
                .withColumn("content", F.sha2(F.col("_text").cast("binary"), 256))
    keyed = written(spark, texts.select("_id", "content", F.octet_length("_text").cast("long").alias("n_bytes"),
                                        row_salt().alias("salt")), "token-keys")
    stored = read_cache(spark, cache, version)
    name = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    contents = written(spark, keyed.groupBy("content").agg(F.min(name).alias("_name"), F.count(F.lit(1)).alias("n")),
                       "token-contents")
    # one row per content that is not stored: the document whose text will be encoded
    misses = written(spark, contents.join(stored, "content", "left_anti"), "token-misses")
    # of the stored contents only those of these documents concern this run
    joint = contents.where("n > 1").select("content").union(
        contents.where("n = 1").join(stored, "content", "left_semi").select("content"))
    marked = possible_rows(texts.withColumn("_name", name), joint, "content")
    # rows that repeat an id and its text, or that have no id, share a name: one of them is left before the exchange
    named = marked.where("possible").select("content", "_name", "_text").dropDuplicates(["content", "_name"])
    chosen = named.join(misses.select("content", "_name").hint("shuffle_hash"),
                                           ["content", "_name"], "left_semi")
    (_encode(marked.where("NOT possible"), tokenizer).union(_encode(chosen, tokenizer))
     .withColumn("version", F.lit(version))
     .select("content", "version", "n_tokens").write.mode("append").parquet(cache))
    counts = read_cache(spark, cache, version).join(contents.select("content"), "content", "left_semi")
    out = attach(keyed, counts, ["content"])
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
