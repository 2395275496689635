"""Quality rules: base counts, then a calibrated hashed n-gram logistic regression against fixed thresholds.

Features are shares: of all word 1- and 2-grams (a word that follows itself is
one bigram feature whatever the word) and of all 3- and 5-character runs, hashed into 2**18 buckets. The
weights are fitted by full-batch gradient steps on labelled rows, the
probability is calibrated (Platt) on a quarter of them that the weights never
saw, and texts are scored in Arrow batches. `TRAIN_ROWS` bounds the labelled
rows used; everything else looks at every row and every character.

Defined results: a null or empty text has zero counts and fails the base
(fewer than 20 words). Without labelled rows of both classes there is no model
and the verdict is the base alone (probability null).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.chars import Chars, U
from logtide.llm.common import labelled_sample, map_kept, map_texts, texts_of

BITS = 18
TRAIN_ROWS = 1500          # bound of labelled rows the weights are fitted on
MIN_WORDS = 20             # fixed value: base rule
MAX_REPEAT_PERCENT = 30    # fixed value: base rule
KEEP_PROBABILITY = 0.5     # fixed threshold of the verdict
SCALE = 20.0
_DOUBLED = U(0x5851F42D4C957F2D)


@dataclasses.dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _grams(chars: Chars) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) per n-gram, one pair of arrays for words and one per character width; one at a time is held."""
    shift = U(64 - BITS)
    words = chars.whash
    yield chars.wdoc, (words * U(0xA24BAED4963EE407)) >> shift
    pair_at = np.flatnonzero(chars.wdoc[:-1] == chars.wdoc[1:]) if len(words) > 1 else np.zeros(0, np.int64)
    pair = words[pair_at] * U(0x9FB21C651E98DF25) + words[pair_at + 1] if len(pair_at) else np.zeros(0, U)
    if len(pair_at):
        pair[words[pair_at] == words[pair_at + 1]] = _DOUBLED
    yield chars.wdoc[pair_at], (pair * U(0xC2B2AE3D27D4EB4F)) >> shift
    for width in (3, 5):
        doc, h = chars.char_grams(width)
        yield doc, (h * U(2 * width + 1)) >> shift


def features(chars: Chars) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) of each text: every kind of n-gram weighs the same in all."""
    keys, values = [], []
    for doc, bucket in _grams(chars):
        key, count = np.unique(doc.astype(U) << U(BITS) | bucket, return_counts=True)
        total = np.bincount(doc, minlength=chars.n)
        keys.append(key)
        values.append(SCALE * count / total[(key >> U(BITS)).astype(np.int64)])
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    doc = (key >> U(BITS)).astype(np.int64)
    cut = np.searchsorted(doc, np.arange(chars.n + 1))
    bucket = (key & U((1 << BITS) - 1)).astype(np.int32)
    return [(bucket[a:b], value[a:b].astype(np.float32)) for a, b in zip(cut, cut[1:])]


def raw_scores(chars: Chars, model: Model) -> np.ndarray:
    """The same sum as over `features`, taken straight over the n-grams."""
    out = np.full(chars.n, model.bias)
    for doc, bucket in _grams(chars):
        total = np.maximum(np.bincount(doc, minlength=chars.n), 1)
        out += SCALE * np.bincount(doc, model.weights[bucket.astype(np.int64)], chars.n) / total
    return out


def probability(chars: Chars, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * raw_scores(chars, model) + model.offset, -40, 40)))


def fit_platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through scores `z`, with smoothed targets (Newton steps)."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - target))
        w -= np.clip(step, -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], steps: int = 150, rate: float = 0.05) -> Model | None:
    """Weights on three quarters of `rows` (label, buckets, values), calibration on the rest."""
    y_all = np.array([r[0] for r in rows])
    if len(set(y_all.tolist())) < 2 or len(rows) < 8:
        return None
    held = np.random.default_rng(5).permutation(len(rows)) % 4 == 3
    if len(set(y_all[~held].tolist())) < 2 or len(set(y_all[held].tolist())) < 2:
        held = np.zeros(len(rows), bool)

    def flat(pick):
        chosen = [rows[i] for i in np.flatnonzero(pick)]
        doc = np.repeat(np.arange(len(chosen), dtype=np.int32), [len(r[1]) for r in chosen])
        return doc, np.concatenate([r[1] for r in chosen]), np.concatenate([r[2] for r in chosen])

    doc, bucket, value = flat(~held)
    used, column = np.unique(bucket, return_inverse=True)
    y = y_all[~held]
    n = len(y)
    w, b = np.zeros(len(used)), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(doc, w[column] * value, n)
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        grad = np.append(np.bincount(column, g[doc] * value, len(used)) + 1e-5 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    pick = held if held.any() else ~held
    doc, bucket, value = flat(pick)
    slope, offset = fit_platt(b + np.bincount(doc, weights[bucket] * value, int(pick.sum())), y_all[pick])
    return Model(weights, float(b), slope, offset)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most `rows` labelled documents; features are made on the executors."""
    sample = labelled_sample(docs, labels, "quality", F.lit(True), rows)

    def extract(part):
        made = features(Chars(texts_of(part, "_text")))
        return {"bucket": pa.array([x[0] for x in made], pa.list_(pa.int32())),
                "value": pa.array([x[1] for x in made], pa.list_(pa.float32()))}

    got = map_texts(sample, extract, "bucket array<int>, value array<float>", "_text",
                    ["_id", "_label"]).toArrow()
    order = np.argsort(got.column("_id").to_numpy(), kind="stable")
    bucket, value = got.column("bucket").combine_chunks(), got.column("value").combine_chunks()
    label = got.column("_label").to_numpy()
    return fit([(int(label[i] > 0), bucket[int(i)].values.to_numpy(), value[int(i)].values.to_numpy()) for i in order])


def judge(texts: list[str], model: Model | None) -> dict[str, np.ndarray]:
    """Counts, base verdict, probability (nan without a model) and final verdict of each text."""
    chars = Chars(texts)
    out = dict(chars.rules)
    out["base_failed"] = ((out["n_words"] < MIN_WORDS)
                          | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"]))
    out["probability"] = np.full(chars.n, np.nan) if model is None else probability(chars, model)
    out["kept"] = ~out["base_failed"] & ~(out["probability"] < KEEP_PROBABILITY)
    return out


def quality_rules(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts, base_failed, probability, kept."""
    def run(part):
        out = judge(texts_of(part, text_col), model)
        out["probability"] = pa.array(out["probability"], from_pandas=True)
        return out

    return map_texts(docs.select(id_col, text_col), run,
                     "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, probability double, kept boolean", text_col, [id_col])


def keep_quality(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that the rules keep."""
    return map_kept(docs, lambda part: judge(texts_of(part, text_col), model)["kept"], text_col)
