"""N-gram Jaccard join: size-banded tiles of hashed bitmap signatures, exact intersections, components.

A document's set is its distinct word shingles (64-bit hashes, sorted). Equal
sets are collapsed first, so a group of copies is one set whatever its size.

Tiles: every set names its `KEYS` least shingle hashes. Of the least `KEYS`
hashes of the union of two sets at the threshold, each is common with odds of at
least 3 in 4, and a common one is among the least of both; so two sets to link
share a key but for odds of 0.25**24, below those of a hash collision. Sets that
share a key meet in a tile. A key of at most `SMALL` sets makes one tile (and
equal tiles of several keys are one); a more frequent key is cut into size
bands, a band into parts of bounded size, and part meets part only within a
band or with the next, since sets to link differ in size by 4/3 at most.

In a tile, bit counts of the signatures (four to eight bits a shingle, folded to the
shorter) bound the overlap of two sets from above: a bit that only one of them
has stands for a shingle that the other lacks. Only pairs whose bound reaches
the threshold go on to an exact intersection of the sorted hash arrays. The
first round tries, per tile of the `FIRST_KEYS` least keys, the heaviest spanning
forest of those pairs, which joins a group of near copies by as many pairs as it
has members; the second, over all keys,
tries every other pair whose sides are not joined yet, of the tiles of frequent
keys in which two sets meet only in that of their least common one; keys whose sets
are all joined by then drop out before anything is dealt. So no link between
different components is lost, and no group is expanded into all its pairs.

Defined results: texts without words (null, empty) have no set and link with
nothing; rows that repeat an id count as one document; rows without an id link
with nothing (component null).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.chars import Chars
from logtide.llm.common import CHARS_SLICE_BYTES, attach, map_arrow, map_texts, row_salt, slices, texts_of, written
from logtide.llm.graph import components

WORDS = 5                  # fixed value: words in a shingle
PERCENT = 75               # fixed value: least similarity, percent
KEYS = 24
FIRST_KEYS = 4             # keys of a set that the first round deals by
SMALL = 64
TILE = 1024                # sets of a part in the first round
CROSS_TILE = 4096          # and in the second, where only pairs of different components are kept
BAND = 4 / 3
WIDEST = 1 << 16           # bits of the longest signature


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, cut): the sorted distinct shingle hashes of text i are hashes[cut[i]:cut[i + 1]]."""
    chars = Chars(texts, lower_ascii=True)
    at, h = chars.windows(words)
    doc = chars.wdoc[at]
    short = np.flatnonzero((chars.n_words > 0) & (chars.n_words < words))
    if len(short):              # the whole sequence as one shingle: hash of the word hashes, marked by their number
        first = np.searchsorted(chars.wdoc, short)
        acc = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            has = chars.n_words[short] > k
            acc[has] = acc[has] * np.uint64(0xD1342543DE82EF95) + chars.whash[first[has] + k]
        doc, h = np.concatenate([doc, short]), np.concatenate([h, acc ^ chars.n_words[short].astype(np.uint64)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def signature(hashes: np.ndarray) -> bytes:
    """Bitmap of four to eight bits per shingle (256 bits at least)."""
    bits = min(WIDEST, max(256, 1 << int(4 * len(hashes) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(hashes >> np.uint64(20)).astype(np.int64) % bits] = True
    return np.packbits(flags, bitorder="little").tobytes()


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n, digest, keys, bits): size, digest, least hashes and signature of each document's set."""
    def run(part):
        h, cut = shingles(texts_of(part, "_text"))
        own = [h[a:b] for a, b in zip(cut, cut[1:])]
        return {"n": np.diff(cut).astype(np.int64),
                "digest": pa.array([hashlib.md5(x.tobytes()).digest() if len(x) else None for x in own], pa.binary()),
                "keys": pa.array([x[:KEYS].view(np.int64) for x in own], pa.list_(pa.int64())),
                "bits": pa.array([signature(x) if len(x) else None for x in own], pa.binary())}

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    return map_texts(texts, run, "n long, digest binary, keys array<long>, bits binary", "_text", ["_id"])


def _same_width(blobs: list[bytes]) -> np.ndarray:
    """Signatures as rows of 64-bit words, longer ones folded to the shortest."""
    width = min(map(len, blobs))
    out = np.zeros((len(blobs), width), np.uint8)
    for i, b in enumerate(blobs):
        out[i] = np.bitwise_or.reduce(np.frombuffer(b, np.uint8).reshape(-1, width), 0)
    return out.view(np.uint64)


def overlap_bound(n_a: np.ndarray, bits_a: np.ndarray, n_b: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlap of each set of a with each of b, by bit counts."""
    out = np.empty((len(n_a), len(n_b)), np.int64)
    for i in range(len(n_a)):
        only_a = np.bitwise_count(bits_a[i] & ~bits_b).sum(1, dtype=np.int64)
        only_b = np.bitwise_count(bits_b & ~bits_a[i]).sum(1, dtype=np.int64)
        out[i] = np.minimum(n_a[i] - only_a, n_b - only_b)
    return out


def reaches(overlap: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the overlap is PERCENT of the union or more."""
    return 100 * overlap >= PERCENT * (n_a + n_b - overlap)


def _candidates(n: np.ndarray, blobs: list[bytes], left: np.ndarray, roots: np.ndarray,
                home: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, bound) of the pairs of a tile that may link and have different roots: of left sets
    with right ones, and in a home tile of left ones with each other."""
    found = []
    order = np.argsort(n, kind="stable")
    a_all, b_side = order[left[order]], order[~left[order]]
    for b_all in ([a_all] if home else []) + ([b_side] if len(b_side) else []):
        own = b_all is a_all
        for at in range(0, len(a_all), 256):
            a = a_all[at:at + 256]
            # sizes within the threshold of one of the block's
            b = b_all[(n[b_all] * 100 >= n[a[0]] * PERCENT) & (n[b_all] * PERCENT <= n[a[-1]] * 100)]
            if not len(b):
                continue
            bits = _same_width([blobs[k] for k in a] + [blobs[k] for k in b])
            bound = overlap_bound(n[a], bits[:len(a)], n[b], bits[len(a):])
            ok = reaches(bound, n[a][:, None], n[b][None, :]) & (roots[a][:, None] != roots[b][None, :])
            i, j = np.nonzero(ok)
            i, j, bound = a[i], b[j], bound[i, j]
            if own:                                 # each pair once
                i, j, bound = i[i < j], j[i < j], bound[i < j]
            found.append((i, j, bound))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Indices of the pairs that make up a heaviest spanning forest."""
    parent = list(range(size))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k in np.argsort(-weight, kind="stable").tolist():
        a, b = root(int(i[k])), root(int(j[k]))
        if a != b:
            parent[a] = b
            out.append(k)
    return np.array(out, np.int64)


def _tiles(keys: DataFrame, cross: bool) -> DataFrame:
    """(tile, left, _id): which sets meet where. With `cross`, parts of frequent keys meet other parts too.

    keys: (key, _id, n, salt), one row per set and key, keys of at least two sets, with `sets`, the number of a key."""
    few = (keys.where(F.col("sets") <= SMALL).groupBy("key")
           .agg(F.sort_array(F.collect_set("_id")).alias("members")).select("members").distinct()
           .select(F.hex(F.xxhash64("members")).alias("tile"), F.lit(True).alias("left"),
                   F.explode("members").alias("_id")))
    many = keys.where(F.col("sets") > SMALL).withColumn(
        "band", F.floor(F.log(BAND, F.col("n").cast("double"))).cast("int"))
    parts = (many.groupBy("key", "band")
             .agg(F.ceil(F.count(F.lit(1)) / (CROSS_TILE if cross else TILE)).cast("int").alias("parts"))
             .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("band", "parts"))).alias("parts")))
    dealt = attach(many, parts, ["key"]).withColumn(
        "part", F.pmod(F.xxhash64("_id", "key"), F.expr("parts[band]")).cast("int"))
    band, part = F.col("band"), F.col("part")

    def home(b, p):
        return F.concat_ws("/", F.lit("home"), F.col("key").cast("string"), b.cast("string"), p.cast("string"))

    if not cross:
        return few.unionByName(dealt.select(home(band, part).alias("tile"), F.lit(True).alias("left"), "_id"))

    def meet(b1, p1, b2, p2):
        return F.concat_ws("/", F.lit("x"), F.col("key").cast("string"), b1.cast("string"), p1.cast("string"),
                           b2.cast("string"), p2.cast("string"))

    def each(b, keep, row):
        """`row` of the parts p of band b that `keep` takes; none where the key has no such band."""
        count = F.coalesce(F.try_element_at(F.col("parts"), b), F.lit(0))
        numbers = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda x: x - 1)
        return F.transform(F.filter(numbers, lambda p: (count > 0) & keep(p)), row)

    # a part's home tile holds the part on the left and, on the right, the first part of the next band
    meets = F.concat(
        F.array(F.struct(home(band, part).alias("tile"), F.lit(True).alias("left"))),
        each(band, lambda p: p != part, lambda p: F.struct(
            meet(band, F.least(part, p), band, F.greatest(part, p)).alias("tile"), (part < p).alias("left"))),
        each(band + 1, lambda p: p > 0, lambda p: F.struct(
            meet(band, part, band + 1, p).alias("tile"), F.lit(True).alias("left"))),
        each(band - 1, lambda p: p >= 0, lambda p: F.struct(
            F.when(part == 0, home(band - 1, p)).otherwise(meet(band - 1, p, band, part)).alias("tile"),
            F.lit(False).alias("left"))))
    return few.unionByName(dealt.select("_id", F.inline(meets)).select("tile", "left", "_id"))


def _met_before(key: int, frequent: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sets i and j of a tile of `key` have a smaller frequent key in common, too."""
    size = np.diff(frequent.offsets.to_numpy())
    values, code = np.unique(frequent.flatten().to_numpy(), return_inverse=True)
    column = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    earlier = np.full((len(size), max(1, int(size.max(initial=0)))), -1, np.int32)
    earlier[np.repeat(np.arange(len(size)), size), column] = np.where(values[code] < key, code, -1)
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 14):
        a, b = earlier[i[at:at + (1 << 14)]], earlier[j[at:at + (1 << 14)]]
        for column in a.T:
            out[at:at + (1 << 14)] |= (column >= 0) & (column[:, None] == b).any(1)
    return out


def _pairs(tiles: DataFrame, sets: DataFrame, forest: bool) -> DataFrame:
    """(a, b): pairs of `tiles` (tile, left, _id, root) that the bounds let through, a < b.

    Round one takes a spanning forest per tile; round two all pairs of different roots, for which `sets` has each
    set's `frequent` keys: a pair that several of them bring together comes from the tile of the least alone."""
    frequent = ([] if forest else
                [F.when(F.col("tile").contains("/"), F.coalesce("frequent", F.array().cast("array<long>")))
                 .alias("frequent")])
    rows = tiles.join(sets.drop("digest", "keys", "salt"), "_id").select("tile", "left", "_id", "root", "n", "bits", *frequent)
    dealt = rows.repartition("tile").sortWithinPartitions("tile")

    def tile_pairs(t: pa.Table):
        ids, roots = t.column("_id").to_numpy(), t.column("root").to_numpy()
        n, left = t.column("n").to_numpy(), t.column("left").to_numpy(zero_copy_only=False)
        i, j, bound = _candidates(n, t.column("bits").to_pylist(), left, roots,
                                  not t.column("tile")[0].as_py().startswith("x/"))
        apart = ids[i] != ids[j]
        i, j, bound = i[apart], j[apart], bound[apart]
        if not forest and len(i) and "/" in t.column("tile")[0].as_py():
            # an id of several sets has a row of each, whose keys are not told apart: its pairs come from every tile
            _, where, rows = np.unique(ids, return_inverse=True, return_counts=True)
            once = (rows[where[i]] == 1) & (rows[where[j]] == 1)
            key = int(t.column("tile")[0].as_py().split("/")[1])
            new = ~(once & _met_before(key, t.column("frequent").combine_chunks(), i, j))
            i, j = i[new], j[new]
        if forest and len(i):
            pick = _forest(i, j, bound / (n[i] + n[j] - bound), len(ids))
            i, j = i[pick], j[pick]
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

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

    return map_arrow(dealt, run, "a long, b long").distinct()


def _hash_arrays(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, n, hashes) of the documents whose _id is in `chosen`: the exact sorted arrays.

    The join brings all rows of an id to one task, which skips those whose set it has seen."""
    texts = (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
             .join(chosen.select("_id").distinct(), "_id", "left_semi"))

    def run(batches):
        seen = set()
        for whole in batches:
            for part in slices(whole, "_text", CHARS_SLICE_BYTES):
                h, cut = shingles(texts_of(part, "_text"))
                rows = []
                for i, a, b in zip(part.column("_id").to_pylist(), cut, cut[1:]):
                    mark = (i, hashlib.md5(h[a:b].tobytes()).digest()[:8])
                    if b > a and mark not in seen:
                        seen.add(mark)
                        rows.append((i, b - a, h[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.binary())], names=["_id", "n", "hashes"])

    return map_arrow(texts, run, "_id long, n long, hashes binary")


def _ends(pairs: DataFrame) -> DataFrame:
    """(_id) of the sets that pairs name."""
    return pairs.select(F.col("a").alias("_id")).union(pairs.select("b"))


def _linked(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, by exact intersection."""
    left = arrays.select(F.col("_id").alias("a"), F.col("hashes").alias("ha"))
    right = arrays.select(F.col("_id").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "hb")

    def run(batches):
        for batch in batches:
            ok = []
            for ha, hb in zip(batch.column("ha"), batch.column("hb")):
                x, y = np.frombuffer(ha.as_buffer(), np.uint64), np.frombuffer(hb.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                ok.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return map_arrow(both, run, "a long, b long").distinct()


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per row of `docs`."""
    spark = docs.sparkSession
    sets = written(spark, shingle_sets(docs, id_col, text_col).withColumn("salt", row_salt()), "shingle-sets")
    usable = sets.where("n > 0 AND _id IS NOT NULL")
    # one set per digest, under the least id that has it; rows that repeat are one before they meet it
    groups = written(spark, usable.groupBy("digest").agg(F.min("_id").alias("rep")), "set-groups")
    reps = written(spark, usable.dropDuplicates(["digest", "_id"])
                   .join(groups.withColumnRenamed("rep", "_id"), ["digest", "_id"], "left_semi"), "set-reps")
    named = reps.select(F.posexplode("keys").alias("rank", "key"), "_id", "n", "salt")
    often = named.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    keys = written(spark, attach(named, often, ["key"]), "set-keys")

    # exact arrays only of sets in pairs that the bounds let through
    rooted = _tiles(keys.where(F.col("rank") < FIRST_KEYS), cross=False).withColumn("root", F.col("_id"))
    near = written(spark, _pairs(rooted, reps, forest=True), "set-pairs")
    arrays = written(spark, _hash_arrays(docs, _ends(near), id_col, text_col), "set-arrays")
    first = written(spark, _linked(near, arrays), "links")
    roots = written(spark, components(first, "star"), "roots")

    known = keys.join(roots.withColumnRenamed("node", "_id"), "_id", "left").withColumn("root", F.coalesce("root", "_id"))
    open_keys = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")) \
                     .where("low < high").select("key")
    with_root = (_tiles(attach(keys, open_keys, ["key"]), cross=True)
                 .join(roots.withColumnRenamed("node", "_id"), "_id", "left")
                 .withColumn("root", F.coalesce("root", "_id")))
    frequent = (keys.where(F.col("sets") > SMALL).groupBy("_id")
                .agg(F.collect_set("key").alias("frequent")))
    near = written(spark, _pairs(with_root, reps.join(frequent, "_id", "left"), forest=False), "set-pairs")
    more = _ends(near).join(arrays.select("_id"), "_id", "left_anti")
    arrays = arrays.unionByName(written(spark, _hash_arrays(docs, more, id_col, text_col), "set-arrays"))
    second = _linked(near, arrays)
    # rows that repeat an id tie their sets together
    twice = usable.select("_id", "digest").distinct().join(groups, "digest").where("rep <> _id") \
        .select(F.col("_id").alias("a"), F.col("rep").alias("b"))
    ids_twice = (usable.select("_id", "digest").distinct().groupBy("_id").agg(F.count(F.lit(1)).alias("k"))
                 .where("k > 1").select(F.col("_id").alias("a")))
    edges = first.unionByName(second).unionByName(twice.join(ids_twice, "a", "left_semi"))
    final = written(spark, components(edges, "star"), "roots")

    labels = (groups.join(final, groups["rep"] == final["node"], "left")
              .select("digest", F.coalesce("root", "rep").alias("component_id")))
    out = sets.select("_id", "n", "digest", "salt")
    has = attach(out.where("digest IS NOT NULL AND _id IS NOT NULL"), labels, ["digest"])
    alone = out.where("digest IS NULL OR _id IS NULL").withColumn("component_id", F.col("_id"))
    rows = has.select("_id", "n", "component_id").unionByName(alone.select("_id", "n", "component_id"))
    return rows.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that name their component; of rows that repeat an id only those with an equal
    or a linked text are one."""
    spark, has = docs.sparkSession, docs.where(F.col(id_col).isNotNull())
    rest = docs.where(F.col(id_col).isNull())
    if not has.groupBy(id_col).agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count():
        found = written(spark, ngram_components(docs, id_col, text_col), "components")
        kept = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
        return docs.join(kept.hint("shuffle_hash"), id_col, "left_semi").unionByName(rest)
    # one row per id and text, numbered in their order: each text stands for itself
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    texts = (has.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256).alias("hash"),
                        row.alias("row")).groupBy("id", "hash").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")))
    nodes = written(spark, texts.orderBy("id", "hash").withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = written(spark, ngram_components(nodes.select("node", F.col("row")[text_col].alias("text")), "node", "text"),
                    "components")
    kept = found.where("node = component_id").select("node")
    return nodes.join(kept.hint("shuffle_hash"), "node", "left_semi").select("row.*").unionByName(rest)
