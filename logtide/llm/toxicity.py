"""Toxicity: a bidirectional gated recurrent network with attention pooling, over all overlapping windows.

Inputs are words (runs of letters and digits, lower case): a hashed word vector
and the scaled sum of hashed vectors of the word's 3-, 4- and 5-character runs,
its ends marked. Windows of 32 words, 24 apart, cover every text whole; a window's
forward and backward states are pooled by attention into one log odds, and a
logistic curve over a text's three highest windows and its number of windows
gives the score.

Trained here in numpy by back-propagation through time. A text's label says only
that some window is toxic, so a toxic text contributes its highest windows and a
clean one its highest and another; the first choice and the first coordinate of
each vector come from shrunken log odds of words and runs in the training texts.
Bounds: `PER_CLASS` labelled texts per class, of any length, are learned from; a
quarter of them fit only the logistic curve (unless a class has fewer than `FEW`).
They stay on the executors: in each round those look at all windows of all learned
texts and send at most two per text, whose words go whole; the curve is fitted on
scores of whole texts.

Defined results: a text without words (null, empty) scores 0.0. Without labelled
rows of both classes there is no model and every score is 0.0.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.chars import Chars, U, mix
from logtide.llm.common import SLICE_BYTES, labelled_sample, map_texts, texts_of, written

WINDOW, STRIDE = 32, 24
WORD_BITS, RUN_BITS = 15, 16
WORD_DIM, RUN_DIM, HIDDEN = 6, 6, 10
RUNS = (3, 4, 5)
TOP = 3
PER_CLASS = 1500          # bound of labelled rows learned from, per class
FEW = 100                  # with fewer texts of a class all are learned from and fit the curve too
PREDICT_AT = 0.7           # fixed value: score from which a text counts as toxic
NOTHING = -8.0             # log odds that stand for a missing window
BLOCK = 4096


class Words:
    """Words of several texts: distinct ones with their buckets, windows of indices into them."""

    def __init__(self, texts: list[str]):
        chars = Chars([t.lower() for t in texts], letters=True)
        self.n = chars.n
        distinct, first, inverse = np.unique(chars.whash, return_index=True, return_inverse=True)
        self.inverse, self.doc = inverse.astype(np.int64), chars.wdoc
        self.word = (distinct >> U(64 - WORD_BITS)).astype(np.int64)
        s, e = chars.ws[first], chars.we[first]
        self.codes, self.begin, self.end = chars.codes, s, e
        size = e - s + 2
        start = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(len(s)), size)
        at = np.arange(int(start[-1])) - start[owner]
        inside = (at > 0) & (at < size[owner] - 1)
        codes = np.where(at == 0, 1, 2).astype(np.uint32)     # end marks
        codes[inside] = chars.codes[(s[owner] + at - 1)[inside]]
        runs, owners = [], []
        for width in RUNS:
            m = len(codes) - width + 1
            if m <= 0:
                continue
            h = np.full(m, U(width), U)
            for k in range(width):
                h = h * U(0x9E3779B97F4A7C15) + codes[k:k + m]
            h ^= h >> U(29)
            own = owner[:m]
            ok = own == owner[width - 1:]
            runs.append(((h * U(0xD6E8FEB86659FD93)) >> U(64 - RUN_BITS)).astype(np.int64)[ok])
            owners.append(own[ok])
        self.run = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(self.owner, kind="stable")
        self.run, self.owner = self.run[order], self.owner[order]
        self.run_count = np.bincount(self.owner, minlength=len(s))
        self.run_start = np.cumsum(self.run_count) - self.run_count
        # windows: at least one per text with words, the last one reaching its end
        per = np.bincount(self.doc, minlength=self.n)
        begin = np.concatenate([[0], np.cumsum(per)])[:-1]
        many = np.where(per > 0, np.maximum(0, -(-(per - WINDOW) // STRIDE)) + 1, 0)
        self.wdoc = np.repeat(np.arange(self.n), many)
        k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        pos = k[:, None] * STRIDE + np.arange(WINDOW)[None, :]
        self.valid = pos < per[self.wdoc][:, None]
        self.index = (self.inverse[np.where(self.valid, begin[self.wdoc][:, None] + pos, 0)] if len(self.wdoc)
                      else np.zeros((0, WINDOW), np.int64))

    def spelled(self, row: int) -> str:
        """The words of a window, apart by spaces."""
        return " ".join(self.codes[self.begin[w]:self.end[w]].tobytes().decode("utf-32-le", "surrogatepass")
                        for w in self.index[row][self.valid[row]])

    def part(self, rows: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
        """(the distinct words of these windows, the windows as indices into them, valid)."""
        used, index = np.unique(self.index[rows], return_inverse=True)
        out = object.__new__(Words)
        out.word, out.run_count = self.word[used], self.run_count[used]
        total = np.cumsum(out.run_count)
        out.owner = np.repeat(np.arange(len(used)), out.run_count)
        within = np.arange(len(out.owner)) - np.repeat(total - out.run_count, out.run_count)
        out.run = self.run[self.run_start[used][out.owner] + within]
        return out, index.reshape(len(rows), WINDOW), self.valid[rows]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclasses.dataclass
class Net:
    p: dict[str, np.ndarray]
    curve: np.ndarray | None = None

    @staticmethod
    def new(seed: int = 5, dtype=np.float32) -> Net:
        rng = np.random.default_rng(seed)

        def normal(scale, *shape):
            return rng.normal(0, scale, shape).astype(dtype)

        d, h = WORD_DIM + RUN_DIM, HIDDEN
        p = {"word": normal(0.1, 1 << WORD_BITS, WORD_DIM), "run": normal(0.1, 1 << RUN_BITS, RUN_DIM),
             "att": normal(0.3, 2 * h, h), "att_v": normal(0.3, h), "out": normal(0.3, 2 * h),
             "out_b": np.zeros(1, dtype)}
        for side in "fb":
            p |= {f"w{side}": normal(0.3, d, 3 * h), f"b{side}": np.zeros(3 * h, dtype), f"u{side}": normal(0.3, h, 3 * h)}
        return Net(p)

    def inputs(self, words: Words) -> np.ndarray:
        """One input vector per distinct word."""
        runs = np.zeros((len(words.word), RUN_DIM), self.p["run"].dtype)
        if len(words.run):
            starts = np.concatenate([[0], np.cumsum(words.run_count)])[:-1]
            has = words.run_count > 0
            runs[has] = np.add.reduceat(self.p["run"][words.run], starts[has], axis=0)
        return np.hstack([self.p["word"][words.word], runs / np.sqrt(np.maximum(words.run_count, 1))[:, None]
                          .astype(runs.dtype)])

    def _pass(self, x: np.ndarray, index: np.ndarray, valid: np.ndarray, side: str, keep: bool):
        """States of one direction, (time, window, hidden); with `keep` what the backward pass needs."""
        h_dim = HIDDEN
        given = x @ self.p[f"w{side}"] + self.p[f"b{side}"]
        u = self.p[f"u{side}"]
        h = np.zeros((len(index), h_dim), x.dtype)
        states = np.empty((WINDOW, len(index), h_dim), x.dtype)
        saved = []
        for t in (range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)):
            g = given[index[:, t]]
            hu = h @ u
            zr = _sigmoid(g[:, :2 * h_dim] + hu[:, :2 * h_dim])
            z, r = zr[:, :h_dim], zr[:, h_dim:]
            n = np.tanh(g[:, 2 * h_dim:] + r * hu[:, 2 * h_dim:])
            m = valid[:, t, None].astype(x.dtype)
            new = h + m * (1 - z) * (n - h)
            if keep:
                saved.append((t, h, z, r, n, hu[:, 2 * h_dim:], m))
            states[t] = h = new
        return states, saved

    def forward(self, x: np.ndarray, index: np.ndarray, valid: np.ndarray, keep: bool = False):
        """Log odds of each window."""
        f, saved_f = self._pass(x, index, valid, "f", keep)
        b, saved_b = self._pass(x, index, valid, "b", keep)
        s = np.concatenate([f, b], 2)
        a = np.tanh(s @ self.p["att"])
        e = np.where(valid.T, a @ self.p["att_v"], -1e9)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = (w[:, :, None] * s).sum(0)
        z = pooled @ self.p["out"] + self.p["out_b"][0]
        return (z, (saved_f, saved_b, s, a, w, pooled)) if keep else z

    def backward(self, x, words: Words, index, valid, dz, kept) -> dict[str, np.ndarray]:
        """Gradients of all parameters for d loss / d log odds."""
        saved_f, saved_b, s, a, w, pooled = kept
        p, h_dim = self.p, HIDDEN
        g = {"out": pooled.T @ dz, "out_b": np.array([dz.sum()], x.dtype)}
        d_pooled = np.outer(dz, p["out"])
        ds = w[:, :, None] * d_pooled[None]
        dw = (s * d_pooled[None]).sum(2)
        de = w * (dw - (w * dw).sum(0))
        g["att_v"] = np.einsum("tbk,tb->k", a, de)
        da = de[:, :, None] * p["att_v"] * (1 - a * a)
        g["att"] = np.einsum("tbi,tbk->ik", s, da)
        ds = ds + da @ p["att"].T
        dx = np.zeros_like(x)
        for side, saved, part in (("f", saved_f, slice(0, h_dim)), ("b", saved_b, slice(h_dim, None))):
            u = p[f"u{side}"]
            gu = np.zeros_like(u)
            d_given = np.zeros((len(x), 3 * h_dim), x.dtype)
            dh = np.zeros((len(index), h_dim), x.dtype)
            for t, h, z, r, n, hun, m in reversed(saved):
                dh = dh + ds[t][:, part]
                d_new = dh * m
                dn = d_new * (1 - z) * (1 - n * n)
                d_zr = np.hstack([-d_new * (n - h) * z * (1 - z), dn * hun * r * (1 - r)])
                d_hu = np.hstack([d_zr, dn * r])
                gu += h.T @ d_hu
                np.add.at(d_given, index[:, t], np.hstack([d_zr, dn]))
                dh = dh - d_new * (1 - z) + d_hu @ u.T
            g[f"u{side}"], g[f"w{side}"], g[f"b{side}"] = gu, x.T @ d_given, d_given.sum(0)
            dx += d_given @ p[f"w{side}"].T
        g["word"], g["run"] = np.zeros_like(p["word"]), np.zeros_like(p["run"])
        np.add.at(g["word"], words.word, dx[:, :WORD_DIM])
        scaled = dx[:, WORD_DIM:] / np.sqrt(np.maximum(words.run_count, 1))[:, None].astype(x.dtype)
        np.add.at(g["run"], words.run, scaled[words.owner])
        return g

    def windows(self, words: Words) -> np.ndarray:
        x = self.inputs(words)
        parts = [self.forward(x, words.index[k:k + BLOCK], words.valid[k:k + BLOCK])
                 for k in range(0, len(words.wdoc), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def text_features(z: np.ndarray, wdoc: np.ndarray, n: int) -> np.ndarray:
    """Per text: its TOP highest windows, log of the number of windows, 1."""
    order = np.lexsort((-z, wdoc))
    rank = np.arange(len(z)) - np.searchsorted(wdoc[order], wdoc[order])
    out = np.full((n, TOP + 2), NOTHING)
    best = rank < TOP
    out[wdoc[order][best], rank[best]] = np.clip(z[order][best], -12, 12)
    out[:, TOP] = np.log1p(np.bincount(wdoc, minlength=n))
    out[:, TOP + 1] = 1
    return out


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    w[0] = 0.5
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        prior = w.copy()
        prior[0] -= 0.5
        grad = x.T @ (p - y) + 0.3 * prior
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.3 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
    return w


def _holders(doc: np.ndarray, bucket: np.ndarray, bits: int, y: np.ndarray) -> np.ndarray:
    """Per bucket how many clean and how many toxic texts hold it: two rows."""
    pair = np.unique(doc * (1 << bits) + bucket)
    toxic, b = y[pair >> bits] == 1, pair & ((1 << bits) - 1)
    return np.stack([np.bincount(b[~toxic], minlength=1 << bits), np.bincount(b[toxic], minlength=1 << bits)])


def _shrunken_odds(holders: np.ndarray, clean: int, toxic: int) -> np.ndarray:
    """Per bucket the log odds of the texts that hold it, in standard errors beyond 2."""
    none, one = holders + 0.5
    odds = np.log(one / (toxic + 1)) - np.log(none / (clean + 1))
    err = odds / np.sqrt(1 / one + 1 / none)
    return np.sign(err) * np.maximum(np.abs(err) - 2, 0)


def holders_of(texts: list[str], y: np.ndarray) -> np.ndarray:
    """Per word bucket, then per run bucket, how many clean and how many toxic texts hold it: two rows."""
    words = Words(texts)
    of_words = _holders(words.doc, words.word[words.inverse], WORD_BITS, y)
    pair = np.unique(words.doc * len(words.word) + words.inverse)
    cuts = np.searchsorted(pair, np.arange(0, len(y) + 64, 64) * len(words.word))
    of_runs = np.zeros((2, 1 << RUN_BITS), np.int64)
    for lo, hi in zip(cuts, cuts[1:]):                  # 64 texts at a time
        if lo == hi:
            continue
        w_of, d_of = pair[lo:hi] % len(words.word), pair[lo:hi] // len(words.word)
        count = words.run_count[w_of]
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        run_at = np.repeat(words.run_start[w_of], count) + within
        of_runs += _holders(np.repeat(d_of, count), words.run[run_at], RUN_BITS, y)
    return np.hstack([of_words, of_runs])


def chosen_windows(texts: list[str], y: np.ndarray, seed: np.ndarray, net: Net, r: int) -> tuple[list[str], np.ndarray]:
    """(words, toxic) of the windows to learn from in round `r`, at most two per text, out of all its windows."""
    words = Words(texts)
    if not len(words.wdoc):
        return [], np.zeros(0, np.int64)
    if r:
        z = net.windows(words)
    else:
        first = net.inputs(words)
        hint = np.maximum(first[:, 0] + first[:, WORD_DIM], 0)
        z = np.where(words.valid, hint[words.index], 0).sum(1)
    order = np.lexsort((-z, words.wdoc))
    rank = np.empty(len(z), np.int64)
    rank[order] = np.arange(len(z)) - np.searchsorted(words.wdoc[order], words.wdoc[order])
    many = np.bincount(words.wdoc, minlength=words.n)
    has = np.flatnonzero(many)
    other = np.zeros(len(z), bool)
    other[(np.cumsum(many) - many)[has] + (mix(seed[has].astype(np.int64).view(U) + U(r)) % many[has].astype(U))
          .astype(np.int64)] = True
    toxic = y[words.wdoc] == 1
    # of a toxic text's second window only one that the hint or the net finds counts as toxic;
    # a clean text: its highest window and one drawn from all
    pick = np.flatnonzero((rank == 0) | np.where(toxic, (rank == 1) & (z > 0), other))
    return [words.spelled(k) for k in pick], toxic[pick].astype(np.int64)


def features_of(texts: list[str], net: Net) -> np.ndarray:
    words = Words(texts)
    return text_features(net.windows(words), words.wdoc, words.n)


class Listed:
    """Labelled texts in memory: the passes over them that `learn_from` makes."""

    def __init__(self, texts: list[str], y: np.ndarray):
        held = np.random.default_rng(5).permutation(len(y)) % 4 == 3
        if min(y.sum(), len(y) - y.sum()) < FEW:
            held = np.zeros(len(y), bool)
        self.learned = [texts[i] for i in np.flatnonzero(~held)], y[~held]
        used = held if held.any() else ~held
        self.curve = [texts[i] for i in np.flatnonzero(used)], y[used]

    def holders(self) -> tuple[np.ndarray, int, int]:
        texts, y = self.learned
        return holders_of(texts, y), int((y == 0).sum()), int(y.sum())

    def windows(self, net: Net, r: int) -> tuple[list[str], np.ndarray]:
        texts, y = self.learned
        return chosen_windows(texts, y, np.arange(len(y)), net, r)

    def scored(self, net: Net) -> tuple[np.ndarray, np.ndarray]:
        texts, y = self.curve
        return features_of(texts, net), y


class Spread:
    """Labelled texts (_id, _label 0 or 1, _text) in a table: the same passes, made by the executors."""

    def __init__(self, rows: DataFrame):
        rows = rows.withColumn("_seed", F.xxhash64("_id", F.lit("toxicity")))
        held = F.pmod("_seed", F.lit(4)) == 3
        self.n = [rows.where(F.col("_label") == k).count() for k in (0, 1)]
        few = min(self.n) < FEW
        self.learned, self.curve = (rows, rows) if few else (rows.where(~held), rows.where(held))

    def holders(self) -> tuple[np.ndarray, int, int]:
        def run(part):
            found = holders_of(texts_of(part, "_text"), part.column("_label").to_numpy())
            at = np.flatnonzero(found.any(0))
            return {"at": at, "clean": found[0, at], "toxic": found[1, at]}

        got = (map_texts(self.learned, run, "at long, clean long, toxic long", "_text", budget=SLICE_BYTES)
               .groupBy("at").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
        out = np.zeros((2, (1 << WORD_BITS) + (1 << RUN_BITS)), np.int64)
        out[:, got.column("at").to_numpy()] = got.column("clean").to_numpy(), got.column("toxic").to_numpy()
        clean, toxic = self.learned.agg(F.count_if(F.col("_label") == 0), F.count_if(F.col("_label") == 1)).first()
        return out, clean, toxic

    def windows(self, net: Net, r: int) -> tuple[list[str], np.ndarray]:
        def run(part):
            found, toxic = chosen_windows(texts_of(part, "_text"), part.column("_label").to_numpy(),
                                          part.column("_seed").to_numpy(), net, r)
            return {"words": pa.array(found, pa.string()), "toxic": toxic}

        got = sorted(zip(*map_texts(self.learned, run, "words string, toxic long", "_text", budget=SLICE_BYTES).toArrow()
                         .to_pydict().values()))
        return [words for words, _ in got], np.array([toxic for _, toxic in got], np.int64)

    def scored(self, net: Net) -> tuple[np.ndarray, np.ndarray]:
        def run(part):
            return {"x": pa.array(list(features_of(texts_of(part, "_text"), net)), pa.list_(pa.float64()))}

        got = sorted((r["_id"], r["_label"], r["x"])
                     for r in map_texts(self.curve, run, "x array<double>", "_text", ["_id", "_label"],
                                       SLICE_BYTES).toArrow().to_pylist())
        return np.array([x for _, _, x in got]).reshape(-1, TOP + 2), np.array([y for _, y, _ in got], np.int64)


def learn_from(sample: Listed | Spread, share: float | None = None, rounds: int = 3, steps: int = 100, batch: int = 128) -> Net | None:
    """Train on three quarters of the sample, fit the curve on the rest (both on all, if a class has few).

    `share` is that of toxic texts where scores are to be probabilities; the sample's own by default."""
    holders, clean, toxic = sample.holders()
    net = Net.new()
    net.p["word"][:, 0] = 0.3 * _shrunken_odds(holders[:, :1 << WORD_BITS], clean, toxic)
    net.p["run"][:, 0] = 0.3 * _shrunken_odds(holders[:, 1 << WORD_BITS:], clean, toxic)
    rng = np.random.default_rng(11)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    for r in range(rounds):
        found, target = sample.windows(net, r)
        if not found:
            return None
        words, target = Words(found), target.astype(np.float32)
        weight = np.where(target == 1, 0.5 * len(target) / max(target.sum(), 1),
                          0.5 * len(target) / max((1 - target).sum(), 1)).astype(np.float32)
        per_epoch = max(1, len(found) // batch)
        for _ in range(max(2, -(-steps // per_epoch))):
            for rows in np.array_split(rng.permutation(len(found)), per_epoch):
                step += 1
                own, index, valid = words.part(rows)
                x = net.inputs(own)
                out, kept = net.forward(x, index, valid, keep=True)
                dz = ((_sigmoid(out) - target[rows]) * weight[rows] / len(rows)).astype(np.float32)
                grads = net.backward(x, own, index, valid, dz, kept)
                for k, g in grads.items():
                    m, v = moment[k]
                    if k in ("word", "run"):
                        g = g + 1e-5 * net.p[k]
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    net.p[k] -= (0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    x, y = sample.scored(net)
    net.curve = _fit_curve(x, y)
    if share is not None:                       # the sample has as many toxic as clean texts, the corpus has not
        own = y.mean()
        net.curve[-1] += np.log(share / (1 - share)) - np.log(own / (1 - own))
    return net


def fit(texts: list[str], labels: np.ndarray, share: float | None = None) -> Net | None:
    """Train on texts in memory."""
    y = np.asarray(labels).astype(np.int64)
    return learn_from(Listed(texts, y), share) if len(set(y.tolist())) == 2 else None


def score(texts: list[str], net: Net | None) -> np.ndarray:
    if net is None:
        return np.zeros(len(texts))
    words = Words(texts)
    x = text_features(net.windows(words), words.wdoc, words.n)
    p = 1 / (1 + np.exp(-np.clip(x @ net.curve, -30, 30)))
    return np.where(np.bincount(words.wdoc, minlength=words.n) > 0, p, 0.0)


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Net | None:
    """Fit on at most `per_class` labelled texts of each class (where `learn` holds on the labels' doc_id)."""
    found = [labelled_sample(docs, labels.where(keep), "toxic", learn, per_class)
             .select("_id", F.lit(label).cast("long").alias("_label"), "_text")
             for label, keep in ((1, F.col("toxic") > 0), (0, F.col("toxic") <= 0))]
    sample = Spread(written(docs.sparkSession, found[0].union(found[1]), "toxicity-sample"))
    if not min(sample.n):
        return None
    toxic, clean = labels.where(learn).agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    return learn_from(sample, toxic / (toxic + clean))


def toxicity(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted."""
    def run(part):
        p = score(texts_of(part, text_col), net)
        return {"score": p, "predicted": (p >= PREDICT_AT).astype(np.int32)}

    return map_texts(docs.select(id_col, text_col), run, "score double, predicted int", text_col, [id_col], SLICE_BYTES)
