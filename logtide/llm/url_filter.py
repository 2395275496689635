"""URL filters: longest-fitting host/path rules, then a listed-URL test through a blocked Bloom filter.

All of it is DataFrame operations. A url's canonical form (host, path without a
closing slash or `.html`, and the query without tracking parameters, no scheme
and no fragment) is hashed once; the hash names one block of `blocks` 512-bit
blocks and eight bits in it, one per 64-bit word. The filter is one row per
block whatever the length of the list (at most `blocks` * 72 bytes, 2.4 MB at
the default), which bounds what is broadcast. Rows whose bits are all set go on
to an exact join with the list, salted on both sides so that a hot url spreads;
the others skip it. A longer list makes more rows go on, never another result.

Rules: (host, path, verdict). A rule fits its host and all subdomains if the
url's path starts with the rule's path; the rule of the longest host, then of
the longest path, wins. `rule` is host + path of the winner.

Defined results: a null url, or one without `://`, has empty host and path, no
rule fits it, it is on no list, and it is allowed. Null list entries are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 15
WORDS = 8
SALTS = 8
TRACKING = r"^(utm_[a-z]+|ref)="


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """df plus host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return (df.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            .withColumn("path", path))


def query_parameters(url: str = "url") -> Column:
    """The parameters between the first `?` and the fragment, in their order."""
    before_fragment = F.substring_index(F.col(url), "#", 1)
    query = F.when(F.instr(before_fragment, "?") > 0, F.expr("substring(x, instr(x, '?') + 1)".replace(
        "x", f"substring_index(`{url}`, '#', 1)")))
    return F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: p != "")


def canonical(url: str = "url") -> Column:
    """Canonical form over the columns host, path and `url`; null where there is no host."""
    kept = F.filter(query_parameters(url), lambda p: ~p.rlike(TRACKING))
    path = F.regexp_replace(F.regexp_replace("path", r"\.html$", ""), "/+$", "")
    return F.when(F.col("host") != "", F.concat(
        "host", path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&")))
        .otherwise(F.lit(""))))


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the winning rule, null where none fits: one CASE, longest rules first."""
    rule = verdict = None
    for host, path, says in sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r)):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path))
        text = F.lit(host + path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: str, word: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({key}, 'bits'), {6 * word}), 64) AS INT))")


def bloom_filter(listed: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7): the blocked Bloom filter of the column `key`; at most `blocks` rows."""
    return (listed.where(F.col(key).isNotNull()).groupBy(_block(key, blocks).alias("block"))
            .agg(*[F.bit_or(_bit(key, w)).alias(f"w{w}") for w in range(WORDS)]))


def possible_rows(rows: DataFrame, names: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """`rows` plus possible: false only where `key` is surely not among `names` (distinct, not null)."""
    bits = bloom_filter(names, key, blocks)
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.col(f"w{w}").bitwiseAND(_bit(key, w)) != 0)
    return (rows.withColumn("block", _block(key, blocks))
            .join(F.broadcast(bits), "block", "left")
            .withColumn("possible", F.col(key).isNotNull() & F.coalesce(hit, F.lit(False)))
            .drop("block", *[f"w{w}" for w in range(WORDS)]))


def listed_rows(rows: DataFrame, listed: DataFrame, key: str, blocks: int = BLOCKS, salts: int = SALTS) -> DataFrame:
    """`rows` plus possible (the filter passes) and listed (its `key` is in `listed`, exactly)."""
    names = listed.select(key).where(F.col(key).isNotNull()).distinct()
    marked = possible_rows(rows, names, key, blocks)
    spread = (names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
              .withColumn("listed", F.lit(True)))
    exact = (marked.where("possible").withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
             .join(spread.hint("shuffle_hash"), [key, "salt"], "left").drop("salt")
             .withColumn("listed", F.coalesce("listed", F.lit(False))))
    return exact.unionByName(marked.where("NOT possible").withColumn("listed", F.lit(False)))


def tracked_urls(urls: DataFrame) -> DataFrame:
    """The list the query uses: canonical urls that some row carries with a tracking parameter."""
    return (urls.where(F.exists(query_parameters("url"), lambda p: p.rlike(TRACKING)))
            .select(canonical("url").alias("canonical")))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame | None = None,
               blocks: int = BLOCKS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, canonical, listed): rules first, then the list; else allowed.

    `listed` holds the column canonical; without it the tracked urls of `pages` are the list.
    """
    urls = with_host_path(pages.select(id_col, F.col(url_col).alias("url"))).withColumn("canonical", canonical("url"))
    names = tracked_urls(urls.drop("canonical")) if listed is None else listed.select("canonical")
    rule, verdict = rule_columns(rules)
    return (listed_rows(urls, names, "canonical", blocks)
            .withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))
            .select(id_col, "host", "path", "rule", "verdict", "canonical", "listed"))
