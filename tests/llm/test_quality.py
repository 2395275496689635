import random

import numpy as np
import pytest

from logtide.llm import pu_quality, quality_rules
from logtide.llm.chars import Chars
from tests.llm.helpers import DOC_SCHEMA, base_counts, doc_rows

GOOD = "the river ran past old stones and quiet trees while birds sang over fields of green barley near home"


def _texts(n, seed):
    rng = random.Random(seed)
    out, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD.split()) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(25, 60))]
        good = i % 4 != 0
        if not good:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        out.append(" ".join(words))
        labels.append(int(good))
    return out, labels


EDGES = ["", " \n\t ", "one", "a b c d e f g h a b c d e f g h", "x\nx\n\n \nx", "é#|<>&%$*é", "\x1c\x85 \u00a0",
         "w " * 40000, "line\r\nline\r\nline", "😀 " * 9, "a b c d e f g h\na b c d e f g h", "##\n##\n"]


def test_base_counts_match_brute_force():
    rng = random.Random(3)
    texts = EDGES + [" ".join(rng.choice("ab#\n") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    got = Chars(texts).rules
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(int(got[k][i]) for k in names) for i in range(len(texts))] == [base_counts(t) for t in texts]


def test_scores_from_grams_equal_scores_from_features():
    texts, _ = _texts(12, 1)
    chars = Chars(texts + EDGES[:4])
    model = quality_rules.Model(np.random.default_rng(1).normal(size=1 << quality_rules.BITS).astype(np.float32), 0.3, 1, 0)
    slow = [0.3 + float((model.weights[b] * v).sum()) for b, v in quality_rules.features(chars)]
    assert np.allclose(quality_rules.raw_scores(chars, model), slow, atol=1e-3)


@pytest.fixture(scope="module")
def corpus(spark):
    texts, labels = _texts(160, 7)
    docs = spark.createDataFrame(doc_rows(texts + [None, ""]), DOC_SCHEMA)
    return docs, spark.createDataFrame([(i, q, 0) for i, q in enumerate(labels)] + [(500, None, None), (None, 1, 0)],
                                       "doc_id long, quality int, toxic int"), labels


def test_rules_learn_and_keep(spark, corpus):
    docs, labels, truth = corpus
    model = quality_rules.train(docs, labels)
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs, model).collect()}
    assert len(rows) == 162 and rows[160].base_failed and not rows[160].kept and rows[161].n_words == 0
    assert np.mean([rows[i].kept == bool(q) for i, q in enumerate(truth)]) > 0.95
    kept = quality_rules.keep_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_rules_without_labels_or_rows(spark, corpus):
    docs, labels, _ = corpus
    assert quality_rules.train(docs, labels.where("quality = 1")) is None
    assert quality_rules.train(docs.limit(0), labels) is None
    rows = quality_rules.quality_rules(docs, None).collect()
    assert all(r.kept == (not r.base_failed) and r.probability is None for r in rows)
    assert quality_rules.quality_rules(docs.limit(0), None).count() == 0


def test_pu_learns_from_positives_only(spark, corpus):
    docs, labels, truth = corpus
    from pyspark.sql import functions as F
    model = pu_quality.train(docs, labels, F.lit(True))
    again = pu_quality.train(docs, labels.where("quality = 1"), F.lit(True))
    assert model.prior == again.prior and 0.5 < model.prior < 0.95
    extra = docs.withColumn("score", F.lit("x")).unionByName(docs.limit(1).withColumn("score", F.lit("y")))
    rows = pu_quality.pu_quality(extra, model).collect()
    assert len(rows) == 163 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert np.mean([by_id[i].predicted == q for i, q in enumerate(truth)]) > 0.9
    assert pu_quality.keep_predicted(docs, model).columns == docs.columns


def test_pu_without_positives(spark, corpus):
    docs, labels, _ = corpus
    from pyspark.sql import functions as F
    assert pu_quality.train(docs, labels.where("quality = 0"), F.lit(True)) is None
    assert {(r.score, r.predicted) for r in pu_quality.pu_quality(docs, None).collect()} == {(0.5, 0)}
    assert pu_quality.keep_predicted(docs, None).count() == docs.count()
    assert pu_quality.pu_quality(docs.limit(0), None).count() == 0


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(2)
    pos = rng.normal(0, 1, (1500, 4))
    unl = np.vstack([rng.normal(0, 1, (1400, 4)), rng.normal(4, 1, (600, 4))])
    assert abs(pu_quality.estimate_prior(pos, unl) - 0.7) < 0.06


def test_extra_columns_with_clashing_names(spark, corpus):
    docs, labels, _ = corpus
    from pyspark.sql import functions as F
    clash = docs.withColumn("_text", F.lit(1)).withColumn("kept", F.lit(None).cast("string")).withColumn("_id", F.lit(2))
    model = quality_rules.train(clash, labels)
    assert quality_rules.keep_quality(clash, model).columns == clash.columns
    assert quality_rules.quality_rules(clash, model).count() == docs.count()


def test_a_repeated_id_is_learned_from_once(spark, corpus, monkeypatch):
    docs, labels, _ = corpus
    from pyspark.sql import functions as F
    from logtide.llm.common import labelled_sample
    again = docs.where("doc_id IN (3, 4)").crossJoin(spark.range(3000).withColumnRenamed("id", "k")) \
        .withColumn("text", F.concat("text", F.lit(" "), (F.col("k") % 7).cast("string"))).select(*docs.columns)
    hot = docs.unionByName(again)
    rows = labelled_sample(hot, labels, "quality", F.lit(True), 100_000).collect()
    assert len(rows) == len({r._id for r in rows}) == 160
    assert sorted(map(tuple, rows)) == sorted(map(tuple, labelled_sample(
        hot.repartition(7), labels, "quality", F.lit(True), 100_000).collect()))
    seen = []
    monkeypatch.setattr(pu_quality, "fit", lambda pos, unl, *_: seen.append((len(pos), len(unl))))
    pu_quality.train(hot, labels, F.lit(True))
    assert seen == [(120, 162)]


def test_prior_counts_documents_outside_the_sample(spark):
    from pyspark.sql import functions as F
    texts, good = _texts(1200, 3)
    docs = spark.createDataFrame(doc_rows(texts + [None]), DOC_SCHEMA)
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(good)], "doc_id long, quality int, toxic int")
    net = pu_quality.Net(np.zeros(18), np.ones(18), np.random.default_rng(1).normal(0, 1, (18, 2)), np.zeros(2), np.ones(2), 0.0)
    learned = spark.createDataFrame([(i,) for i in range(0, 600, 2)], "_id long")
    z = net.odds(pu_quality.features(Chars([t for i, t in enumerate(texts) if i % 2 or i >= 600] + [""])))
    at = np.quantile(z, [0.1, 0.5, 0.9])
    again = docs.unionByName(docs.where("doc_id = 7").crossJoin(spark.range(500)).select(*docs.columns))
    counts = pu_quality.count_reached(again, learned, net, at)
    assert counts.tolist() == np.bincount(np.searchsorted(at, z, "right"), minlength=4).tolist()
    seen, real = [], pu_quality.count_reached
    pu_quality.count_reached = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        model = pu_quality.train(docs, labels, F.lit(True), positives=200, unlabelled=80)
    finally:
        pu_quality.count_reached = real
    assert seen[0].sum() == 1201 - 40 and abs(model.prior - 0.75) < 0.1


def test_held_out_labels(spark):
    """Labels of fold 2 are not learned from: both classifiers are judged on them alone."""
    from pyspark.sql import functions as F

    from logtide.llm.common import fold, table
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = labels.where((fold("doc_id", 4) == 2) & F.col("quality").isNotNull()).select("doc_id", "quality")
    judged = docs.join(F.broadcast(held), "doc_id")
    pu = pu_quality.pu_quality(judged, pu_quality.train(docs, labels, fold("doc_id", 4) != 2))
    rules = quality_rules.quality_rules(judged, quality_rules.train(docs, labels.where(fold("doc_id", 4) != 2)))
    truth = {r.doc_id: r.quality for r in held.collect()}
    good, bad = ([r.predicted for r in pu.collect() if truth[r.doc_id] == q] for q in (1, 0))
    assert len(good) > 800 and np.mean(good) >= 0.98 and np.mean(bad) <= 0.05
    past = [(truth[r.doc_id], r.kept) for r in rules.collect() if not r.base_failed]
    assert np.mean([k for q, k in past if q == 1]) >= 0.98 and np.mean([k for q, k in past if q == 0]) <= 0.05
