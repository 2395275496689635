"""Quality classifier by positive-unlabelled learning.

A small network over whole-text statistics minimises the non-negative unbiased
risk: with class prior p, positives P and unlabelled web text U,

    p * E_P[loss+] + max(0, E_U[loss-] - p * E_P[loss-])

The prior is estimated first: a positive-versus-unlabelled network is fitted on
half of the sampled rows; the smallest ratio, over score thresholds, of the
unlabelled share above to the positive share above (with a confidence margin)
bounds p from above. The positive share is that of the other half, the unlabelled
share that of all documents outside the half fitted on (of rows that repeat an id
one). Negative labels are never used.

Bounds: `POSITIVES` trusted and `UNLABELLED` web texts (chosen by a hash of the
id) are what the networks are fitted on; all texts are scored whole.

Defined results: null and empty texts are scored like any text without words.
Without a trusted positive there is no model; the score is then 0.5 and
predicted 0, and `keep_predicted` keeps every row.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.chars import Chars
from logtide.llm.common import labelled_sample, map_kept, map_texts, one_text, texts_of

POSITIVES = 4000           # bound of trusted positives the networks see
UNLABELLED = 8000          # bound of unlabelled texts the networks see
PREDICT_AT = 0.7           # fixed value: score from which a text counts as good
FEATURES = 18
_TABLE = 0x250             # letters up to here are told apart by a table


def _classes() -> np.ndarray:
    """Upper, lower, digit, punctuation flags of the code points below the table's end."""
    chars = [chr(i) for i in range(_TABLE)]
    flags = np.array([[c.isupper(), c.islower(), c.isdigit(), not c.isalnum() and not c.isspace()] for c in chars])
    return np.vstack([flags, np.zeros((1, 4), bool)])


def features(chars: Chars) -> np.ndarray:
    """One row of whole-text statistics per text; all are shares or logarithms."""
    rules = chars.rules
    c = np.minimum(chars.codes, _TABLE)
    flags = _classes()[c]
    upper, lower, digit, punct = (chars.per_doc(flags[:, k]) for k in range(4))
    size, words = np.maximum(chars.lens, 1), np.maximum(chars.n_words, 1)
    lines = chars.per_doc(chars.codes == 10) + 1
    h = chars.by_doc(chars.wdoc, chars.whash)
    new, where = np.unique(h, return_index=True)
    distinct = np.bincount(chars.wdoc[where], minlength=chars.n)
    same = (chars.whash[:-1] == chars.whash[1:]) & (chars.wdoc[:-1] == chars.wdoc[1:])
    doubled = np.bincount(chars.wdoc[:-1][same], minlength=chars.n)
    up_count = np.concatenate([[0], np.cumsum(flags[:, 0])])
    low_count = np.concatenate([[0], np.cumsum(flags[:, 1])])
    shout = (up_count[chars.we] - up_count[chars.ws] >= 2) & (low_count[chars.we] == low_count[chars.ws])
    shouted = np.bincount(chars.wdoc[shout], minlength=chars.n)
    lone = np.bincount(chars.wdoc[chars.we - chars.ws == 1], minlength=chars.n)
    long = np.bincount(chars.wdoc[chars.we - chars.ws > 25], minlength=chars.n)

    def count(char: str) -> np.ndarray:
        return chars.per_doc(chars.codes == ord(char))

    share = np.sqrt
    return np.stack([
        np.log1p(chars.n_words), share(rules["n_symbols"] / size), share(upper / np.maximum(upper + lower, 1)),
        share(shouted / words), share(rules["n_dup_lines"] / lines), share(rules["n_repeat_words"] / words),
        share(doubled / words), share(digit / size), share(punct / size), share(count("!") / words),
        share(count("|") / words), np.minimum(rules["word_chars"] / words, 30),
        distinct / words * np.log1p(chars.n_words), share(lone / words), share(long / words),
        np.log1p(words / lines), share(chars.per_doc(chars.codes >= 128) / size),
        (chars.n_words == 0).astype(float)], 1)


@dataclasses.dataclass
class Net:
    """Standardised inputs, one tanh layer, one output (log odds)."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return x, np.tanh(x @ self.w1 + self.b1)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.w2 + self.b2


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _train(pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int = 500, width: int = 16) -> Net:
    """Adam on the non-negative risk; without a prior, on plain positive-versus-unlabelled loss."""
    rng = np.random.default_rng(7)
    both = np.vstack([pos, unl])
    net = Net(both.mean(0), both.std(0) + 1e-3, rng.normal(0, 0.3, (both.shape[1], width)), np.zeros(width),
              rng.normal(0, 0.3, width), 0.0)
    n_p, n_u = len(pos), len(unl)
    is_pos = np.arange(n_p + n_u) < n_p
    params = ["w1", "b1", "w2", "b2"]
    first, second = {k: 0.0 for k in params}, {k: 0.0 for k in params}
    for t in range(1, steps + 1):
        x, hid = net.hidden(both)
        z = hid @ net.w2 + net.b2
        s = _sigmoid(z)
        to_pos, to_neg = s - 1, s                   # d loss+/dz, d loss-/dz of the logistic loss
        if prior is None:
            g = np.where(is_pos, to_pos / n_p, to_neg / n_u)
        else:
            loss_neg = np.logaddexp(0, z)
            rest = loss_neg[~is_pos].mean() - prior * loss_neg[is_pos].mean()
            g_pos = prior * to_pos / n_p
            g_rest = np.where(is_pos, -prior * to_neg / n_p, to_neg / n_u)
            # a negative estimate of a non-negative risk is overfitting: step back on that part alone
            g = np.where(is_pos, g_pos, 0) + g_rest if rest >= 0 else -g_rest
        back = np.outer(g, net.w2) * (1 - hid ** 2)
        grads = {"w1": x.T @ back + 1e-4 * net.w1, "b1": back.sum(0), "w2": hid.T @ g + 1e-4 * net.w2, "b2": g.sum()}
        for k in params:
            first[k] = 0.9 * first[k] + 0.1 * grads[k]
            second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
            step = 0.02 * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
            setattr(net, k, getattr(net, k) - step)
    return net


def _above(k: np.ndarray, thresholds: int) -> tuple[np.ndarray, int]:
    """Share of texts at or above each threshold, and their number, from texts by how many thresholds they reach."""
    return np.cumsum(k[::-1])[::-1][1:thresholds + 1] / max(k.sum(), 1), int(k.sum())


def estimate_prior(pos: np.ndarray, unl: np.ndarray, reached: Callable | None = None) -> float:
    """Share of positives among the unlabelled: the smallest bounded ratio of shares above a threshold.

    `reached(net, at, learned)` counts the unlabelled texts, but for the rows `learned` of `unl`, by how many of the
    thresholds `at` they reach; by default those are the other half of `unl`."""
    rng = np.random.default_rng(3)
    pos, order = rng.permutation(pos), rng.permutation(len(unl))      # halves that no order of the ids shapes
    net = _train(pos[::2], unl[order[::2]], None, steps=300)
    zp = np.sort(net.odds(pos[1::2]))
    if not len(zp):
        return 0.5
    at = np.quantile(zp, np.linspace(0.0, 0.7, 71))
    share_p = 1 - np.searchsorted(zp, at) / len(zp)
    counts = (reached(net, at, order[::2]) if reached else
              np.bincount(np.searchsorted(at, net.odds(unl[order[1::2]]), "right"), minlength=len(at) + 1))
    share_u, n_u = _above(counts, len(at))
    if not n_u:
        return 0.5
    margin = 1.5 * np.sqrt(share_u * (1 - share_u) / n_u + share_p * (1 - share_p) / len(zp)) / share_p
    best = int(np.argmin(share_u / share_p + margin))
    return float(np.clip(share_u[best] / share_p[best], 0.02, 0.995))


@dataclasses.dataclass
class Model:
    net: Net
    prior: float


def fit(pos: np.ndarray, unl: np.ndarray, reached: Callable | None = None) -> Model | None:
    if len(pos) < 2 or len(unl) < 2:
        return None
    prior = estimate_prior(pos, unl, reached)
    return Model(_train(pos, unl, prior), prior)


def count_reached(docs: DataFrame, learned: DataFrame, net: Net, at: np.ndarray) -> np.ndarray:
    """Documents but those of the (few) ids `learned`, counted by how many of the thresholds `at` they reach."""
    def run(part):
        return {"k": np.searchsorted(at, net.odds(features(Chars(texts_of(part, "_text")))), "right")}

    texts = (docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
             .join(F.broadcast(learned), "_id", "left_anti").withColumn("_hash", F.xxhash64("_text")))
    with_id, without = (map_texts(texts.where(rows), run, "k long", "_text", ["_id", "_hash"])
                        for rows in ("_id IS NOT NULL", "_id IS NULL"))
    each = (with_id.groupBy("_id").agg(F.min(F.struct("_hash", "k"))["k"].alias("k"))
            .unionByName(without.select("_id", "k")))
    got = each.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(len(at) + 1, np.int64)
    for r in got:
        out[r["k"]] = r["n"]
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> Model | None:
    """Fit on trusted positives (label 1 where `learn` holds on the labels' doc_id) and unlabelled texts."""
    trusted = labelled_sample(docs, labels.where(F.col("quality") > 0), "quality", learn, positives)
    ids = (docs.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("_id", F.lit("unlabelled")), "_id").limit(unlabelled))
    web = one_text(docs, ids).withColumn("_label", F.lit(0))
    rows = trusted.select("_id", "_label", "_text").union(web.select("_id", "_label", "_text"))

    def extract(part):
        return {"x": pa.array(list(features(Chars(texts_of(part, "_text")))), pa.list_(pa.float64()))}

    got = map_texts(rows, extract, "x array<double>", "_text", ["_id", "_label"]).toArrow()
    if not got.num_rows:
        return None
    x = got.column("x").combine_chunks().values.to_numpy().reshape(-1, FEATURES)
    order = np.argsort(got.column("_id").to_numpy(), kind="stable")
    label = got.column("_label").to_numpy()[order]
    ids = got.column("_id").take(pa.array(order[label == 0]))
    # an Arrow table: from a list of rows, Python workers of their own would read it
    return fit(x[order][label > 0], x[order][label == 0], lambda net, at, learned: count_reached(
        docs, docs.sparkSession.createDataFrame(pa.table({"_id": ids.take(pa.array(learned))})), net, at))


def score(texts: list[str], model: Model | None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    return _sigmoid(model.net.odds(features(Chars(texts))))


def pu_quality(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted."""
    def run(part):
        p = score(texts_of(part, text_col), model)
        return {"score": p, "predicted": (p >= PREDICT_AT).astype(np.int32)}

    return map_texts(docs.select(id_col, text_col), run, "score double, predicted int", text_col, [id_col])


def keep_predicted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that the model calls good (all without a model)."""
    if model is None:
        return docs
    return map_kept(docs, lambda part: score(texts_of(part, text_col), model) >= PREDICT_AT, text_col)
