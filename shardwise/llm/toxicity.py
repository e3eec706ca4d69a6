"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is read as windows of ``window`` words.  Every word contributes its
character n-grams (with word boundaries), hashed into ``buckets`` vectors, so an
unseen misspelling shares most vectors with the word it came from.  A window is
the mean of its n-gram vectors; a softmax layer turns it into P(toxic).  Both
layers are trained jointly in numpy on a bounded sample of labelled
rows (``most`` per class, chosen by a hash of the id; the texts are whole).  As
only a few words make a long text toxic, training alternates between fitting and
choosing which windows of a toxic text carry its label (the highest-scoring
ones).  A text scores by its highest windows and their mean, calibrated.

Defined results: null and empty texts have no n-grams and score by the bias
alone; texts are read whole; equal texts score equally; without labels of both
classes every text scores the share of toxic labels (0 without labels).  Labels
that repeat an id are toxic if one of them is; null ids or labels are not used;
if an id occurs in several rows, its smallest text is learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.llm.common import hash_sample, ship, slices, text_slices
from shardwise.llm.textvec import codes_of, is_word_char

BUCKETS = 1 << 15
SIZES = (3, 4, 5, 6)
WINDOW = 4
DIM = 8
TOP = 4
MOST = 1500  # labelled rows per class in the training sample
SLICE_CHARS = 400_000


class Grams(NamedTuple):
    bucket: np.ndarray  # uint16 bucket of each n-gram, by window
    window: np.ndarray  # int64 start of each window's n-grams, and the total
    text: np.ndarray  # int64 first window of each text, and the total


class Model(NamedTuple):
    weight: np.ndarray  # float32 per bucket: embedding times the difference of the class vectors
    scale: tuple[float, ...]  # calibration of a text's features
    shift: float


def grams(texts: list[str], buckets: int = BUCKETS, sizes: tuple[int, ...] = SIZES, window: int = WINDOW) -> Grams:
    codes, starts = codes_of(["", *texts])  # the leading blank is the first word's boundary
    starts = starts[1:]
    letter = is_word_char(codes)
    chars = np.where(letter, codes, 32).astype(np.uint32)
    begins = letter & ~np.concatenate([[False], letter[:-1]])
    word = np.cumsum(begins) - 1  # of the word at or before a character
    n = len(chars)
    pos, ids = [], []
    for size in sizes:
        if n < size:
            continue
        m = n - size + 1
        ok = letter[1 : 1 + m].copy()  # all but the two outer characters belong to one word
        for k in range(2, size - 1):
            ok &= letter[k : k + m]
        at = np.flatnonzero(ok)
        h = np.full(len(at), 0x811C9DC5 + size, dtype=np.uint32)
        for k in range(size):
            h = (h ^ chars[at + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        pos.append(at + 1)  # a character of the word itself
        ids.append(((h * np.uint32(0x9E3779B1)) >> np.uint32(16)) & np.uint32(buckets - 1))
    at = np.concatenate(pos) if pos else np.empty(0, np.int64)
    bucket = np.concatenate(ids).astype(np.uint16) if ids else np.empty(0, np.uint16)
    first_word = np.searchsorted(np.flatnonzero(begins), starts)  # of each text, and the total
    n_windows = -(-np.diff(first_word) // window)
    text = np.concatenate([[0], np.cumsum(n_windows)]).astype(np.int64)
    w = word[at]
    doc = np.searchsorted(first_word, w, side="right") - 1
    win = text[doc] + (w - first_word[doc]) // window
    order = np.argsort(win, kind="stable")
    return Grams(bucket[order], np.searchsorted(win[order], np.arange(text[-1] + 1)).astype(np.int64), text)


def window_scores(g: Grams, weight: np.ndarray) -> np.ndarray:
    """Mean weight of each window's n-grams (0 for a window without any)."""
    if len(g.window) < 2:
        return np.empty(0)
    sums = np.concatenate([[0.0], np.cumsum(weight[g.bucket], dtype=np.float64)])
    size = np.diff(g.window)
    return (sums[g.window[1:]] - sums[g.window[:-1]]) / np.maximum(size, 1)


def features(g: Grams, scores: np.ndarray) -> np.ndarray:
    """Per text: its highest window, the mean of its ``TOP`` highest windows
    (a missing one counts 0) and the mean of all; zeros without a window."""
    n = np.diff(g.text)
    out = np.zeros((len(n), 3))
    has = n > 0
    if has.any():
        doc = np.repeat(np.arange(len(n)), n)
        ranked = scores[np.lexsort((-scores, doc))]
        out[has, 0] = ranked[g.text[:-1][has]]
        first = (np.arange(len(doc)) - g.text[doc]) < TOP
        out[:, 1] = np.bincount(doc, weights=np.where(first, ranked, 0), minlength=len(n)) / TOP
        out[has, 2] = np.bincount(doc, weights=scores, minlength=len(n))[has] / n[has]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit_layers(g: Grams, chosen: np.ndarray, target: np.ndarray, share: np.ndarray, state: dict, epochs: int, rate: float, rng: np.random.Generator) -> None:
    """Minibatch steps over the chosen windows: Adam for the softmax, Adagrad
    for the embedding table."""
    sizes = g.window[chosen + 1] - g.window[chosen]
    chosen, target, share, sizes = (x[sizes > 0] for x in (chosen, target, share, sizes))
    buckets, dim = state["E"].shape
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // 2048)):
            lo, size = g.window[chosen[batch]], sizes[batch]
            offsets = np.concatenate([[0], np.cumsum(size)])
            take = np.repeat(lo - offsets[:-1], size) + np.arange(offsets[-1])
            bucket = g.bucket[take].astype(np.int64)
            mean = np.add.reduceat(state["E"][bucket], offsets[:-1], axis=0) / size[:, None]
            logits = mean @ state["W"] + state["b"]
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), target[batch]] -= 1
            p *= share[batch][:, None] / share[batch].sum()
            state["t"] += 1
            for k, x in (("W", mean.T @ p), ("b", p.sum(axis=0))):
                state["m" + k] = 0.9 * state["m" + k] + 0.1 * x
                state["v" + k] = 0.999 * state["v" + k] + 0.001 * x * x
                fix = np.sqrt(1 - 0.999 ** state["t"]) / (1 - 0.9 ** state["t"])
                state[k] = state[k] - rate * fix * state["m" + k] / (np.sqrt(state["v" + k]) + 1e-7)
            back = (p @ state["W"].T) / size[:, None]
            ge = np.empty((buckets, dim), dtype=np.float32)
            for d in range(dim):
                ge[:, d] = np.bincount(bucket, weights=np.repeat(back[:, d], size), minlength=buckets)
            state["vE"] += ge * ge
            state["E"] -= rate * 10 * ge / (np.sqrt(state["vE"]) + 1e-7)


def fit(texts: list[str], toxic: list[int], buckets: int = BUCKETS, dim: int = DIM, window: int = WINDOW, rounds: int = 3, epochs: int = 2, rate: float = 0.02, seed: int = 7) -> Model:
    """Embeddings, softmax and calibration from labelled texts."""
    y = np.asarray(toxic, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(buckets, np.float32), (0.0, 0.0, 0.0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    parts = [grams(texts[a:b], buckets, window=window) for a, b in slices([len(t) for t in texts], SLICE_CHARS)]
    at = np.concatenate([[0], np.cumsum([len(p.bucket) for p in parts])])
    wins = np.concatenate([[0], np.cumsum([p.text[-1] for p in parts])])
    g = Grams(np.concatenate([p.bucket for p in parts]), np.concatenate([p.window[:-1] + o for p, o in zip(parts, at, strict=False)] + [at[-1:]]), np.concatenate([p.text[:-1] + o for p, o in zip(parts, wins, strict=False)] + [wins[-1:]]))
    del parts
    rng = np.random.default_rng(seed)
    state: dict = {"E": rng.normal(0, 0.05, (buckets, dim)).astype(np.float32), "W": np.vstack([-np.ones(dim), np.ones(dim)]).T.astype(np.float32) * 0.5, "b": np.zeros(2, np.float32), "t": 0}
    state |= {"vE": np.full((buckets, dim), 1e-8, np.float32)} | {k + x: np.zeros_like(state[x]) for k in "mv" for x in "Wb"}
    doc = np.repeat(np.arange(len(y)), np.diff(g.text))
    carries = y[doc].astype(bool)  # windows taken as toxic so far
    weight = np.zeros(buckets, np.float32)
    for r in range(rounds):
        use = np.flatnonzero(carries | (y[doc] == 0)) if r == 0 else np.arange(len(doc))
        target = carries[use].astype(np.int64)
        n_of = np.bincount(doc[use], minlength=len(y))
        share = np.where(target == 1, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))
        if r == 0:  # every toxic text counts once, however long it is
            share = np.where(target == 1, 0.5 / (n_of[doc[use]] * max((y == 1).sum(), 1)), share)
        _fit_layers(g, use, target, share * len(use), state, epochs, rate, rng)
        weight = (state["E"] @ (state["W"][:, 1] - state["W"][:, 0])).astype(np.float32)
        scores = window_scores(g, weight)
        top = features(g, scores)[:, 0]
        clean_top = np.sort(top[y == 0])
        bar = clean_top[int(0.98 * (len(clean_top) - 1))] if len(clean_top) else 0.0
        carries = (y[doc] == 1) & ((scores > bar) | (scores >= top[doc]))
    return Model(weight, *_calibrate(features(g, window_scores(g, weight)), y))


def _calibrate(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[tuple[float, ...], float]:
    """Logistic fit of the label to a text's features (Newton steps, smoothed
    targets, both classes weighing equally)."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    mid, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mid) / spread, np.ones(len(x))])
    coef, ridge = np.zeros(z.shape[1]), np.diag([1e-3] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = _sigmoid(z @ coef)
        grad = z.T @ (weight * (p - target)) + ridge @ coef
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(hess, grad)
        coef -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    scale = coef[:-1] / spread
    return tuple(scale.tolist()), float(coef[-1] - scale @ mid)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    out = np.empty(len(texts))
    for a, b in slices([len(t) for t in texts], SLICE_CHARS):
        g = grams(texts[a:b], len(model.weight))
        out[a:b] = _sigmoid(features(g, window_scores(g, model.weight)) @ np.array(model.scale) + model.shift)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST, id_col: str = "doc_id", text: str = "text", label: str = "toxic", keep=None) -> DataFrame:
    """At most ``most`` labelled texts per class, chosen by a hash of the id
    among the ids that satisfy ``keep``: columns id, y, text."""
    lab = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    lab = lab.where(keep(F.col("_id"))) if keep is not None else lab
    lab = lab.groupBy("_id").agg(F.max("_y").alias("_y"))
    known = docs.select(F.col(id_col).alias("_id")).distinct()  # labels of absent documents must not use up the bound
    lab = lab.join(known, "_id", "left_semi")
    clean, toxic = (hash_sample(lab.where(F.col("_y") == y), F.col("_id"), most) for y in (0, 1))
    chosen = clean.unionByName(toxic)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(chosen.select("_id", "_y", "_h")), "_id")  # at most 2 * most ids
    return rows.groupBy("_id", "_y", "_h").agg(F.min("_text").alias("_text"))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, keep=None, **names: str) -> Model:
    """Fit on a bounded sample of labelled rows (``2 * most`` texts) in one
    task; only the fitted numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True)), key=lambda r: (r[0], str(r[1])))
        if len(rows) > 2 * most:
            raise ValueError(f"training sample: more than {2 * most} rows")
        m = fit([r[3] for r in rows], [r[2] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([m.weight.tobytes()], pa.binary()), pa.array([list(m.scale)], pa.list_(pa.float64())), pa.array([m.shift])], names=["weight", "scale", "shift"])

    ship(docs.sparkSession)
    rows = training_rows(docs, labels, most, keep=keep, **names).select("_h", "_id", "_y", "_text")
    r = rows.repartition(1).mapInArrow(run, "weight binary, scale array<double>, shift double").first()
    if r is None:  # no labelled rows
        return fit([], [])
    return Model(np.frombuffer(r["weight"], dtype=np.float32), tuple(r["scale"]), r["shift"])


def score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with ``out``, the calibrated P(toxic) of each whole text.  The
    model (one float per bucket) is the only thing sent to the executors."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf(T.DoubleType())
    def predict(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*shared.value)
        for texts in it:
            yield pa.array(np.concatenate([np.empty(0), *(score_texts(part, m) for _, _, part in text_slices(texts, SLICE_CHARS))]), type=pa.float64())

    return df.withColumn(out, predict(F.coalesce(F.col(text), F.lit(""))))
