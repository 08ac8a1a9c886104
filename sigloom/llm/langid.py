"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte n-grams (3 to 5) of each word between word marks, hashed.
A text is the mean of its subwords' embeddings; a linear softmax over it gives
the languages. Both are trained by stochastic gradient descent in numpy on at most
`per_language` labelled texts of each language. As everything after the mean is
linear, scoring adds up each subword's class scores. The temperature is fitted
on a part of the sample that training leaves out, and so is the rejection limit:
the confidence below which a text of that part is more likely wrong than the
accepted error rate allows.

Defined results: null texts and texts without a letter are `und` with score 0; a
text with letters always gets a learned language, and `rejected` tells whether its
confidence is under the limit. Without any label all texts are `und`. Repeated rows get a
row each and count once in training; a doc_id with several texts or languages counts with each. Texts of any length
are scored in pieces of about a megabyte between words, but for a longer word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import samples as S
from sigloom.llm import textnp as T

BITS = 16
SIZES = (3, 4, 5)


def subwords(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each subword, with repeats."""
    low = T.LOWER[buf]
    s, e, p = T.words(low, offs, T.PLAIN)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # words one after another, each between two marks
    n = e - s + 2
    at = np.r_[0, np.cumsum(n)]
    flat = np.full(at[-1], 60, np.uint8)
    inside = np.ones(at[-1], bool)
    inside[at[:-1]] = inside[at[1:] - 1] = False
    flat[inside] = low[np.repeat(s - at[:-1] - 1, n - 2) + np.flatnonzero(inside)]
    owner = np.repeat(T.owners(p), n)
    left = np.repeat(at[1:], n) - np.arange(at[-1])
    codes = flat.astype(np.uint64)
    rows, buckets = [], []
    h = codes.copy()
    for k in range(2, max(SIZES) + 1):
        h = h[:-1] * T.U64(0x100000001B3) + codes[k - 1 :] + T.U64(k)
        if k in SIZES:
            ok = left[: len(h)] >= k
            rows.append(owner[: len(h)][ok])
            buckets.append((T.mix(h[ok]) >> T.U64(64 - BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, buckets = subwords(buf, offs)
    return T.bag(rows, buckets, len(offs) - 1, BITS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # class scores of each subword
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def proba(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n, k = len(offs) - 1, len(self.languages)
        count, z = np.zeros(n, np.int64), np.zeros((n, k))
        # a long text comes alone; its sums are added up piece by piece
        for part in T.pieces(buf, T.PLAIN) if n == 1 else [buf]:
            rows, buckets = subwords(part, np.asarray([0, len(part)]) if n == 1 else offs)
            count += np.bincount(rows, minlength=n)
            z += np.stack([np.bincount(rows, self.table[buckets, c], n) for c in range(k)], axis=1)
        z = z / np.maximum(count, 1)[:, None] + self.bias
        z = z / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def softmax(z):
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def train(ptr, ids, counts, langs: list[str], dims: int = 16, epochs: int = 6, rate: float = 0.8, accept_error: float = 0.01, seed: int = 3) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    y = np.searchsorted(np.asarray(names), np.asarray(langs))
    rng = np.random.default_rng(seed)
    emb = (rng.normal(size=(1 << BITS, dims)) * 0.1).astype(np.float32)
    out, bias = np.zeros((dims, len(names)), np.float32), np.zeros(len(names))
    order = rng.permutation(len(y))
    # a fifth is left out, but of each language one text stays
    _, stay = np.unique(y[order], return_index=True)
    rest = np.delete(order, stay)
    held = rest[: len(y) // 5]
    learn = np.r_[rest[len(y) // 5 :], order[stay]]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for row in rng.permutation(learn):
            i, c = ids[ptr[row] : ptr[row + 1]], counts[ptr[row] : ptr[row + 1]]
            if not len(i):
                continue
            c = (c / c.sum()).astype(np.float32)
            x = c @ emb[i]
            g = softmax(x @ out + bias)
            g[y[row]] -= 1
            back = out @ g.astype(np.float32)
            out -= step * np.outer(x, g).astype(np.float32)
            bias -= 0.1 * step * g
            emb[i] -= step * len(i) ** 0.5 * c[:, None] * back
    table = (emb @ out).astype(np.float32)
    model = Model(names, table, bias)
    if len(held):
        pos, p = S.gather_batch(ptr, held)
        total = np.maximum(T.segment_sum(counts[pos].astype(float), p), 1)
        z = T.segment_sum(table[ids[pos]] * counts[pos][:, None], p) / total[:, None] + bias
        grid = np.geomspace(0.1, 8, 40)
        loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        q = softmax(z / model.temperature)
        top, right = q.max(axis=1), q.argmax(axis=1) == y[held]
        by = np.argsort(-top)
        wrong = np.cumsum(~right[by]) / np.arange(1, len(by) + 1)
        good = np.flatnonzero(wrong <= accept_error)
        model.reject_below = float(top[by][good[-1]]) * 0.5 if len(good) and good[-1] == len(by) - 1 else float(top[by][good[-1]]) if len(good) else 1.0
    return model


def fit(docs: DataFrame, per_language: int = 400, total: int = S.SAMPLE_BYTES) -> Model | None:
    """Train on at most per_language distinct texts of each language, outside the held-out fold.

    Every language has one text at least, all those beyond it hold total bytes together; the
    sample is as large as the model, whose classes the languages are.
    """
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~S.fold(F.col("doc_id")))
    names = known.groupBy("lang").agg(F.lit(1).alias("_any"))
    each = total // max(1, names.count())
    ptr, feats, counts, kept = S.collect_bags(S.sample(known, names, ["lang"], per_language, "lang", each), features, ["doc_id", "lang"])
    return train(ptr, feats, counts, kept["lang"])


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """keep columns, lang_pred, score, rejected for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(buf, offs, batch):
        m = sent.value
        letters = pc.fill_null(pc.match_substring_regex(batch.column(0), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if m is None:
            n = len(offs) - 1
            return {"lang_pred": pa.array(["und"] * n), "score": pa.array(np.zeros(n)), "rejected": pa.array([True] * n)}
        p = m.proba(buf, offs)
        best = p.argmax(axis=1)
        score = np.where(letters, p[np.arange(len(p)), best], 0.0)
        return {"lang_pred": pa.array(np.where(letters, np.asarray(m.languages, object)[best], "und"), pa.string()), "score": pa.array(score), "rejected": pa.array(~letters | (score < m.reject_below))}

    return S.map_scores(docs, run, keep, "lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs."""
    out = predict(docs.select("doc_id", "text"), fit(docs, per_language), ["doc_id"])
    return out.select("doc_id", S.fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
