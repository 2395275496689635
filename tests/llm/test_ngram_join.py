import random

import pytest
from pyspark.sql import functions as F

from logtide.llm import graph, ngram_join
from tests.llm.helpers import DOC_SCHEMA, doc_rows, jaccard_components, least_components


def _corpus(seed, passages=True):
    """Copies, near copies at many distances, a passage that many share, very short and very long texts."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 400)
    texts = [None, "", " \n", "one", "One", "one two three four", "ONE two three four", "one two three four five"]
    passage = " ".join(word() for _ in range(60))
    for k in range(40):
        base = [word() for _ in range(rng.randint(6, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n"]).join(copy))
        if passages:
            texts.append(" ".join(base[:rng.randint(1, 60)]) + " " + passage)
    texts.append(" ".join(word() for _ in range(20000)))
    texts.append(texts[-1] + " tail")
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small,tile", [(64, 1024), (2, 6)])
def test_components_match_brute_force(spark, monkeypatch, small, tile):
    monkeypatch.setattr(ngram_join, "SMALL", small)       # with small bounds every text meets others in split tiles
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "CROSS_TILE", tile)
    docs = doc_rows(_corpus(small))
    got = {r.doc_id: r for r in ngram_join.ngram_components(
        spark.createDataFrame(docs, DOC_SCHEMA).withColumn("n", F.lit(1)).withColumn("tile", F.lit(1))).collect()}
    sets, want = jaccard_components([(d[0], d[1]) for d in docs])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in want}


def test_bound_never_below_overlap():
    import numpy as np
    texts = [t for t in _corpus(9) if t and t.strip()]
    h, cut = ngram_join.shingles(texts)
    own = [h[a:b] for a, b in zip(cut, cut[1:])]
    n = np.array([len(x) for x in own])
    bits = ngram_join._same_width([ngram_join.signature(x) for x in own])
    bound = ngram_join.overlap_bound(n, bits, n, bits)
    for i in range(0, len(own), 7):
        for j in range(len(own)):
            assert bound[i, j] >= len(np.intersect1d(own[i], own[j]))


def test_keep_one_and_odd_rows(spark):
    rows = doc_rows(["a b c d e f g"] * 3 + [None, "", "x y z"]) + [(None, "a b c d e f g", "en", "s", 1),
                                                                    (5, "x y z", "en", "s", 2)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumn("component_id", F.lit("clash"))
    found = ngram_join.ngram_components(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 5), (None, None)}
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "5", "None"]
    assert ngram_join.ngram_components(docs.limit(0)).count() == 0
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_ids_that_carry_two_texts_tie_their_groups(spark):
    rows = [(7, "a b c d e f", "", "", 0), (7, "p q r s t u", "", "", 0), (9, "a b c d e f", "", "", 0),
            (3, "p q r s t u", "", "", 0), (8, "other words here now and then", "", "", 0)]
    got = {(r.doc_id, r.component_id) for r in ngram_join.ngram_components(
        spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    assert got == {(7, 3), (9, 3), (3, 3), (8, 8)}


def test_graph_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = least_components({x for e in edges for x in e}, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unrelated_texts_of_one_id_are_kept(spark):
    words = [f"w{i}" for i in range(400)]
    a, b, c = " ".join(words[:60]), " ".join(words[100:160]), " ".join(words[200:260])
    near = a + " end"
    rows = [(1, a), (1, b), (1, b), (1, near), (1, ""), (2, b), (3, c), (4, a)]
    docs = spark.createDataFrame([(i, t, "en", "src", k % 2) for k, (i, t) in enumerate(rows)], DOC_SCHEMA)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.keep_one(docs.repartition(3)).collect())
    assert [(i, t) for i, t in kept if t not in (a, near)] == [(1, ""), (1, b), (3, c)]
    assert len([t for _, t in kept if t in (a, near)]) == 1
    assert ngram_join.keep_one(docs.repartition(5)).exceptAll(ngram_join.keep_one(docs)).count() == 0


def test_pair_comes_from_its_least_frequent_key_alone(spark, monkeypatch):
    """Two sets that several frequent keys bring together are one row; an id of several sets meets in every tile."""
    import pyarrow as pa

    from logtide.llm import ngram_join

    sets = spark.createDataFrame(pa.table({
        "_id": [1, 2, 3, 4, 4], "n": [10] * 5, "bits": [b"\xff" * 32] * 5, "digest": [b"a", b"b", b"c", b"d", b"e"],
        "keys": [[5]] * 5, "salt": [0] * 5, "frequent": [[9, -5, 7], [-5, 9], [9, 7], [9, -5], [9, -5]]}))
    tiles = spark.createDataFrame(pa.table({
        "tile": ["home/-5/0/0"] * 3 + ["home/9/0/0"] * 4 + ["home/7/0/0"] * 2 + ["A0"] * 2, "left": [True] * 11,
        "_id": [1, 2, 4, 1, 2, 3, 4, 1, 3, 1, 2], "root": [1, 2, 4, 1, 2, 3, 4, 1, 3, 1, 2]}))
    runs = []
    monkeypatch.setattr(ngram_join, "map_arrow", lambda df, fn, schema: runs.append((df, fn)) or df)
    ngram_join._pairs(tiles, sets, forest=False)
    df, fn = runs[0]
    rows = [(r["a"], r["b"]) for out in fn(iter(df.coalesce(1).toArrow().to_batches())) for r in out.to_pylist()]
    assert rows.count((1, 2)) == 2                      # tile -5, and A0, whose key is not frequent
    assert rows.count((1, 3)) == 1 and rows.count((2, 3)) == 1
    assert rows.count((1, 4)) == rows.count((2, 4)) == 4 and rows.count((3, 4)) == 2
