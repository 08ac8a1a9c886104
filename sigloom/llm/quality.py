"""Quality classifier: a factorisation machine.

Features of a text: hashed words (L2-normalised log counts), structure
statistics (each cut into bins, one-hot) and metadata (the magnitude of n_chars,
one-hot). A text's score is

    w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

the pairwise interactions <v_i, v_j> x_i x_j by the sum-of-squares identity, in
time linear in the features. It is trained by AdaGrad with logistic loss on a
sample of at most `bound` labelled texts; every row is scored, on its whole text.

Defined results: null and empty texts have no words and are scored from their
structure features; without any label of both classes in the training folds
every score is the share of label 1 (0.5 without labels); repeated rows get a row each
and count once in training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import samples as S
from sigloom.llm import textnp as T

BITS = 16
N_STATS, BINS = 14, 16
STATS_AT = 1 << BITS
META_AT = STATS_AT + N_STATS * BINS
N_FEATURES = META_AT + 32


def statistics(buf: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, ptr: np.ndarray, hashes: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Structure statistics of each row, each within 0 to 1."""
    n_bytes = np.maximum(np.diff(offs), 1)
    n_words = np.diff(ptr)
    some = np.maximum(n_words, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        pre = np.r_[0, np.cumsum(mask)]
        return (pre[offs[1:]] - pre[offs[:-1]]) / n_bytes

    upper = (buf >= 65) & (buf <= 90)
    lower = (buf >= 97) & (buf <= 122)
    digit = (buf >= 48) & (buf <= 57)
    high = buf >= 128
    blank = T.SPACE[buf] if len(buf) else np.zeros(0, bool)
    sign = ~(upper | lower | digit | high | blank)
    stop = (buf == 46) | (buf == 44)
    row = T.owners(ptr)
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    odd = (sign & ~stop)[ends - 1] if len(ends) else np.zeros(0, bool)
    alone = (ends - starts == 1) & sign[starts] if len(ends) else np.zeros(0, bool)
    by = lambda x: T.segment_sum(np.asarray(x, float), ptr)
    return np.stack([
        np.log1p(n_words) / 12,
        by(ends - starts) / some / 24,
        share(upper) * 2,
        share(digit) * 4,
        share(sign & ~stop) * 3,
        share(stop) * 8,
        share(buf == 10) * 12,
        share(high) * 4,
        distinct / some,
        by(same) / some,
        by(odd) / some,
        by(alone) / some * 2,
        np.log1p(by(same)) / 8,
        np.log1p(T.segment_sum((sign & ~stop).astype(float), offs)) / 10,
    ], axis=1)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pointers, feature ids and weights of words and structure. Metadata is added by with_meta."""
    low = T.LOWER[buf]
    s, e, p = T.words(low, offs)
    h = T.range_hash(low, s, e)
    n = len(offs) - 1
    ptr, ids, counts = T.bag(T.owners(p), h >> T.U64(64 - BITS), n, BITS)
    w = 1 + np.log(counts)
    norm = np.sqrt(np.maximum(T.segment_sum(w * w, ptr), 1e-9))
    w = w / np.repeat(norm, np.diff(ptr))
    stats = statistics(buf, offs, s, e, p, h, np.diff(ptr).astype(float))
    bins = np.clip((stats * BINS).astype(np.int64), 0, BINS - 1) + STATS_AT + np.arange(N_STATS) * BINS
    at = np.repeat(ptr[1:], N_STATS)
    return ptr + np.arange(n + 1) * N_STATS, np.insert(ids, at, bins.ravel()), np.insert(w, at, 1 / np.sqrt(N_STATS))


def with_meta(ptr: np.ndarray, ids: np.ndarray, w: np.ndarray, magnitude: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds a row's metadata feature: the magnitude of its length as the table has it."""
    return ptr + np.arange(len(ptr)), np.insert(ids, ptr[1:], META_AT + magnitude), np.insert(w, ptr[1:], 0.25)


def magnitude(n_chars) -> np.ndarray:
    """Binary magnitude of n_chars, 0 for null or less than 1."""
    x = np.asarray([0 if v is None or v != v or v < 1 else min(int(v).bit_length(), 31) for v in n_chars], np.int64)
    return x


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, ptr: np.ndarray, ids: np.ndarray, w: np.ndarray) -> np.ndarray:
        vx = self.factors[ids] * w[:, None].astype(np.float32)
        total = T.segment_sum(vx, ptr)
        squares = T.segment_sum((vx * vx).sum(axis=1), ptr)
        return self.bias + T.segment_sum(self.linear[ids] * w, ptr) + 0.5 * ((total * total).sum(axis=1) - squares)

    def score(self, ptr, ids, w) -> np.ndarray:
        return S.sigmoid(self.raw(ptr, ids, w))


def train(ptr, ids, w, y, rank: int = 8, epochs: int = 12, rate: float = 0.08, l2: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """AdaGrad over small batches. With one class alone, the model is that share (kept within 0.02 to 0.98)."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
    m = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), np.zeros((N_FEATURES, rank), np.float32))
    if len(y) == 0 or y.min() == y.max():
        return m
    m.factors = (rng.normal(size=(N_FEATURES, rank)) * 0.02).astype(np.float32)
    g_lin, g_fac, g0 = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, rank), 1e-6, np.float32), 1e-6
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 32):
            rows = order[at : at + 32]
            pos, p = S.gather_batch(ptr, rows)
            i, x = ids[pos], w[pos]
            owner = T.owners(p)
            vx = m.factors[i] * x[:, None].astype(np.float32)
            total = T.segment_sum(vx, p)
            raw = m.bias + T.segment_sum(m.linear[i] * x, p) + 0.5 * ((total * total).sum(axis=1) - T.segment_sum((vx * vx).sum(axis=1), p))
            err = (S.sigmoid(raw) - y[rows])[owner] / len(rows)
            u, inv = np.unique(i, return_inverse=True)
            gl = np.bincount(inv, err * x, len(u)) + l2 * m.linear[u]
            item = (err * x)[:, None] * (total[owner] - vx)
            gf = np.stack([np.bincount(inv, item[:, f], len(u)) for f in range(rank)], axis=1) + l2 * m.factors[u]
            g_lin[u] += gl * gl
            g_fac[u] += gf * gf
            m.linear[u] -= rate * gl / np.sqrt(g_lin[u])
            m.factors[u] -= (rate * 0.3) * gf / np.sqrt(g_fac[u])
            b = float((S.sigmoid(raw) - y[rows]).mean())
            g0 += b * b
            m.bias -= rate * b / np.sqrt(g0)
    return m


def with_length(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.length("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 6000) -> FactorisationMachine:
    """Train on at most bound labelled texts outside the held-out fold."""
    ids = S.labelled_ids(labels, label, bound)
    rows = S.sample(with_length(docs).select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars")), ids, ["label", "n_chars"], bound)
    ptr, feats, w, kept = S.collect_bags(rows, features, ["doc_id", "label", "n_chars"])
    ptr, feats, w = with_meta(ptr, feats, w, magnitude(kept["n_chars"]))
    return train(ptr, feats, w, (np.asarray(kept["label"], float) > 0).astype(float))


def score(docs: DataFrame, model: FactorisationMachine, keep: list[str], with_text: bool = False) -> DataFrame:
    """keep columns and `score` of every row; with_text: its text too."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear.astype(np.float32), model.factors))

    def run(buf, offs, batch):
        m = FactorisationMachine(*sent.value)
        lengths = batch.column(batch.schema.get_field_index("_len")).to_pylist()
        return {"score": pa.array(m.score(*with_meta(*features(buf, offs), magnitude(lengths))))}

    d = with_length(docs).select("text", *keep, F.col("n_chars").cast("double").alias("_len"))
    return S.map_scores(d, run, [*keep, "_len"], "score double", with_text).drop("_len")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bound: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    out = score(docs.select("doc_id", "text", *[c for c in ("n_chars",) if c in docs.columns]), fit(docs, labels, bound=bound), ["doc_id"])
    return out.select("doc_id", S.fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
