import random

import numpy as np
from pyspark.sql import functions as F

from logtide.llm import toxicity as T
from tests.llm.helpers import DOC_SCHEMA, doc_rows


def _corpus(n, seed=4):
    rng = random.Random(seed)
    syllables = ["ba", "ko", "ri", "tem", "sul", "van", "el", "or", "ni", "dra"]
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(10, 120))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), "zugh" + rng.choice(syllables))
        texts.append(" ".join(words) + ".")
        labels.append(int(toxic))
    return texts, np.array(labels)


def test_windows_cover_every_word_and_overlap():
    for n in (1, 31, 32, 33, 55, 56, 57, 200):
        w = T.Words(["", " ".join(f"w{i}" for i in range(n)), "..."])
        assert set(w.wdoc.tolist()) == {1}
        assert set(w.index[w.valid].tolist()) == set(range(n))
        assert w.valid.any(1).all() and w.valid[:-1].all()


def test_gradients_match_differences():
    words = T.Words(["alpha beta gamma delta beta", "one two three", "alpha " * 40])
    net = T.Net.new(seed=1, dtype=np.float64)
    rows = np.arange(len(words.wdoc))
    own, index, valid = words.part(rows)
    x = net.inputs(own)
    z, kept = net.forward(x, index, valid, keep=True)
    assert np.allclose(z, net.windows(words))
    dz = np.linspace(0.5, 1.5, len(rows))
    grads = net.backward(x, own, index, valid, dz, kept)
    rng = np.random.default_rng(0)
    for name, p in net.p.items():
        at = tuple(own.word[:1]) + (0,) if name == "word" else (own.run[0], 1) if name == "run" else \
            tuple(int(rng.integers(s)) for s in p.shape)
        old, eps = p[at], 1e-5
        out = []
        for value in (old + eps, old - eps):
            p[at] = value
            out.append(float(net.forward(net.inputs(own), index, valid) @ dz))
        p[at] = old
        assert abs((out[0] - out[1]) / (2 * eps) - grads[name][at]) < 1e-6, name


def test_learns_unseen_words_by_their_characters(spark):
    texts, y = _corpus(420)
    net = T.fit(texts[:300], y[:300])
    p = T.score(texts[300:], net)
    assert ((p >= 0.7) == (y[300:] == 1)).mean() > 0.9
    long = " ".join(texts[301:303] * 30)
    assert T.score([long + " " + texts[300] + " " + long], net)[0] > T.score([long + " " + long], net)[0]


def test_query_cases(spark):
    texts, y = _corpus(90)
    docs = spark.createDataFrame(doc_rows(texts + [None, "", " ... "]), DOC_SCHEMA).withColumn("score", F.lit(9))
    labels = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(y)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    net = T.train(docs, labels, F.lit(True))
    rows = {r.doc_id: r for r in T.toxicity(docs, net).collect()}
    assert len(rows) == 93 and all(rows[i].score == 0.0 and rows[i].predicted == 0 for i in (90, 91, 92))
    assert np.mean([rows[i].predicted == v for i, v in enumerate(y)]) > 0.9
    assert T.toxicity(docs.limit(0), net).count() == 0
    assert T.train(docs, labels.where("toxic = 0"), F.lit(True)) is None
    assert T.train(docs.limit(0), labels, F.lit(True)) is None
    assert {r.score for r in T.toxicity(docs, None).collect()} == {0.0}


def test_long_labelled_texts_are_learned_from(spark):
    texts, y = _corpus(120)
    filler = " ".join(t for t, v in zip(texts, y) if not v)[:5_000]
    long = [f"{filler} {t} {filler}" for t in texts]
    assert min(map(len, long)) > 10_000
    docs = spark.createDataFrame(doc_rows(long), DOC_SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(y)], "doc_id long, quality int, toxic int")
    net = T.train(docs, labels, F.lit(True))
    rows = {r.doc_id: r for r in T.toxicity(docs, net).collect()}
    assert np.mean([rows[i].predicted == v for i, v in enumerate(y)]) > 0.9


def test_a_text_sends_two_windows_at_most():
    texts, y = _corpus(30)
    long = [" ".join([t] * 10) for t in texts]
    found, toxic = T.chosen_windows(long + [""], np.append(y, 1), np.arange(31), T.Net.new(), 1)
    assert len(found) <= 60 and max(len(w.split()) for w in found) <= T.WINDOW
    assert 10 <= toxic.sum() <= 20 and 20 <= (toxic == 0).sum() <= 40
