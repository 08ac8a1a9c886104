"""Toxicity: non-negative positive-unlabelled learning.

A linear classifier over words (folded to lower case, bare of punctuation) is
trained in numpy from confirmed toxic texts and from unlabelled texts alone. With
the class prior pi (the share of toxic among the labelled rows of the training
folds, or a parameter) its risk is

    pi R_p(+) + max(0, R_u(-) - pi R_p(-)),

the class-prior-corrected estimate that keeps the second part from going below
zero; while it is below -beta, a step goes against that part. Words take part
when they are significantly more frequent among the positives than among the
unlabelled texts. Non-toxic labels are used for the prior only.

Defined results: texts without any such word, empty and null texts get the
score of the bare bias; without positives every score is 0; repeated rows get a row
each and count once in training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import samples as S
from sigloom.llm import textnp as T

BITS = 20


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence of hashed bare words."""
    low = T.LOWER[buf]
    s, e, p = T.words(low, offs, T.PLAIN)
    ptr, ids, _ = T.bag(T.owners(p), T.range_hash(low, s, e) >> T.U64(64 - BITS), len(offs) - 1, BITS)
    return ptr, ids, np.ones(len(ids))


@dataclass
class Linear:
    bias: float
    weights: np.ndarray

    def score(self, ptr, ids) -> np.ndarray:
        return S.sigmoid(self.bias + T.segment_sum(self.weights[ids], ptr))


def nnpu(x_p: tuple, x_u: tuple, prior: float, n: int, steps: int = 800, rate: float = 0.05, l2: float = 2e-4, beta: float = 0.0) -> tuple[float, np.ndarray]:
    """Adam on the non-negative risk with the logistic loss; full batches of sparse rows (pointers, ids)."""
    w, b = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    (pp, ip), (pu, iu) = x_p, x_u
    op, ou = T.owners(pp), T.owners(pu)
    n_p, n_u = max(len(pp) - 1, 1), max(len(pu) - 1, 1)
    softplus = lambda z: np.logaddexp(0, z)
    for t in range(1, steps + 1):
        zp, zu = b + T.segment_sum(w[ip], pp), b + T.segment_sum(w[iu], pu)
        negative = softplus(zu).mean() - prior * softplus(zp).mean()
        d_pos, d_neg_p, d_neg_u = -S.sigmoid(-zp) / n_p, S.sigmoid(zp) / n_p, S.sigmoid(zu) / n_u
        if negative >= -beta:
            dp, du = prior * (d_pos - d_neg_p), d_neg_u
        else:
            dp, du = prior * d_neg_p, -d_neg_u
        g = np.r_[np.bincount(ip, dp[op], n) + np.bincount(iu, du[ou], n) + l2 * prior * w, dp.sum() + du.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return b, w


def select(x_p: tuple, x_u: tuple, least: int = 3, z: float = 4.0) -> np.ndarray:
    """Ids more frequent among positives than among unlabelled rows: the log ratio of their rates is z standard errors above zero, at least."""
    (pp, ip), (pu, iu) = x_p, x_u
    size = 1 << BITS
    a, c = np.bincount(ip, minlength=size) + 0.5, np.bincount(iu, minlength=size) + 0.5
    ratio = np.log(a / len(pp)) - np.log(c / len(pu))
    return np.flatnonzero((a > least) & (ratio > z * np.sqrt(1 / a + 1 / c)))


def train(x_p: tuple, x_u: tuple, prior: float) -> Linear:
    model = Linear(-35.0, np.zeros(1 << BITS))
    if len(x_p[0]) < 2 or prior <= 0:
        return model
    chosen = select(x_p, x_u)
    to = np.full(1 << BITS, -1)
    to[chosen] = np.arange(len(chosen))

    def cut(x):
        ptr, ids = x
        keep = to[ids] >= 0
        return np.r_[0, np.cumsum(keep)][ptr], to[ids[keep]]

    b, w = nnpu(cut(x_p), cut(x_u), prior, len(chosen))
    model.bias = b
    model.weights[chosen] = w
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = 4000, unlabelled: int = 12000, prior: float | None = None) -> Linear:
    """Train on at most `positives` confirmed and `unlabelled` other texts of the training folds."""
    texts = docs.select("doc_id", "text")
    if prior is None:
        got = labels.where(~S.fold(F.col("doc_id")) & F.col(label).isNotNull()).agg(F.avg((F.col(label) > 0).cast("double")).alias("p")).first()
        prior = float(got["p"] or 0.0)
    marked = S.labelled_ids(labels, label, positives, F.col("label") > 0)
    p_ptr, p_ids, _, _ = S.collect_bags(S.sample(texts, marked, [], positives), features, ["doc_id"])
    some = docs.select("doc_id").where(~S.fold(F.col("doc_id"))).orderBy(S.order_key(F.col("doc_id")), "doc_id").limit(unlabelled).distinct()
    u_ptr, u_ids, _, _ = S.collect_bags(S.sample(texts, some, [], unlabelled), features, ["doc_id"])
    return train((p_ptr, p_ids), (u_ptr, u_ids), prior)


def score(docs: DataFrame, model: Linear, keep: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights.astype(np.float32)))

    def run(buf, offs, batch):
        ptr, ids, _ = features(buf, offs)
        return {"score": pa.array(Linear(*sent.value).score(ptr, ids))}

    return S.map_scores(docs, run, keep, "score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels, **bounds), ["doc_id"])
    return out.select("doc_id", S.fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
