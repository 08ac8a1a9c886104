"""The registered queries of operators 1, 2 and 10 against scores worked out text by text with dictionaries, from the same fitted models."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from sigloom.llm import langid, quality, queries, toxicity
from sigloom.llm import textnp as T

MORE = [(900_001, None, None), (900_002, "", "en"), (900_003, " \n\t ", "en"), (900_004, "ONE one One, 12 %% % a", "en"), (900_005, "12 34 !! ??", None), (900_006, "é ü ñ 日本語 🎉 Ünï", "xx"), (None, "a text without an id , in some words .", "en"), (900_004, "another text of that id", "de")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of a given table, none very long, with awkward ones; and labels for most of them."""
    folder = str(tmp_path_factory.mktemp("scores"))
    d = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect() if len(r["text"] or "") < 1500][:160] + MORE
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in d], "doc_id long, text string, lang string, n_chars int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    known = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    labels = [(i, *known.get(i, (int(i % 3 > 0), int("ga" in (t or "")[:40])))) for i, t, _ in d if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, d


def check(rows, want, name="score"):
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r[name]) for r in rows)
    want = sorted((-1 if i is None else i, s) for i, s in want)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert max(abs(a[1] - b[1]) for a, b in zip(got, want)) < 2e-6


def sigmoid(z):
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def word_hash(word):
    buf = np.frombuffer(word, np.uint8)
    return int(T.range_hash(buf, np.asarray([0]), np.asarray([len(buf)]))[0])


def lower(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def quality_features(text, n_chars):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    low = [lower(w) for w in words]
    counts = Counter(word_hash(w) >> 48 for w in low)
    weight = {i: 1 + math.log(c) for i, c in counts.items()}
    norm = math.sqrt(max(sum(x * x for x in weight.values()), 1e-9))
    x = {i: v / norm for i, v in weight.items()}
    size, some = max(len(data), 1), max(len(words), 1)
    is_sign = lambda b: not (65 <= b <= 90 or 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 or b in b" \t\n\v\f\r")
    odd = lambda b: is_sign(b) and b not in b".,"
    same = sum(a == b for a, b in zip(low, low[1:]))
    # words are told apart by the 16 bits of their hash
    stats = [
        math.log1p(len(words)) / 12, sum(map(len, words)) / some / 24, sum(65 <= b <= 90 for b in data) / size * 2, sum(48 <= b <= 57 for b in data) / size * 4, sum(map(odd, data)) / size * 3, sum(b in b".," for b in data) / size * 8, data.count(b"\n") / size * 12,
        sum(b >= 128 for b in data) / size * 4, len(counts) / some, same / some, sum(odd(w[-1]) for w in words) / some, sum(len(w) == 1 and is_sign(w[0]) for w in words) / some * 2, math.log1p(same) / 8, math.log1p(sum(map(odd, data))) / 10,
    ]
    for k, s in enumerate(stats):
        x[quality.STATS_AT + 16 * k + min(max(int(s * 16), 0), 15)] = 1 / math.sqrt(14)
    x[quality.META_AT + (0 if not n_chars or n_chars < 1 else min(n_chars.bit_length(), 31))] = 0.25
    return x


def test_quality_query_by_pairs(spark, tables):
    """All pairs of features, without the identity."""
    folder, docs = tables
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert np.abs(model.factors).max() > 0.03
    linear = model.linear.astype(np.float32)
    want = []
    for i, text, _ in docs:
        x = quality_features(text, None if text is None else len(text))
        ids = sorted(x)
        v = np.asarray([model.factors[k].astype(float) * x[k] for k in ids])
        pairs = sum(float(v[a] @ v[b]) for a in range(len(ids)) for b in range(a))
        want.append((i, sigmoid(model.bias + sum(float(linear[k]) * x[k] for k in ids) + pairs)))
    out = queries.op1_quality_fm(spark, folder).collect()
    check(out, want)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_toxicity_query_by_words(spark, tables):
    folder, docs = tables
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    weights = model.weights.astype(np.float32)
    want = []
    for i, text, _ in docs:
        words = {word_hash(w) >> 44 for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower((text or "").encode()))}
        want.append((i, sigmoid(model.bias + sum(float(weights[k]) for k in words))))
    out = queries.op2_toxicity_nnpu(spark, folder).collect()
    check(out, want)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in out)


def test_language_query_by_subwords(spark, tables):
    folder, docs = tables
    model = langid.fit(spark.read.parquet(f"{folder}/documents.parquet"))
    assert len(model.languages) >= 4

    def bucket(gram):
        h = gram[0]
        for k in range(2, len(gram) + 1):
            h = (h * 0x100000001B3 + gram[k - 1] + k) % (1 << 64)
        return int(T.mix(np.asarray([h], np.uint64))[0]) >> 48

    want = []
    for i, text, _ in docs:
        words = [b"<" + w + b"<" for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower((text or "").encode()))]
        grams = [bucket(w[a : a + k]) for w in words for k in (3, 4, 5) for a in range(len(w) - k + 1)]
        z = (sum(model.table[g].astype(float) for g in grams) / max(len(grams), 1) + model.bias) / model.temperature
        p = np.exp(z - np.max(z))
        p = p / p.sum()
        letters = any(c.isalpha() for c in text or "")
        want.append((i, float(p.max()) if letters else 0.0, model.languages[int(p.argmax())] if letters else "und"))
    out = queries.op10_language_id(spark, folder).collect()
    check(out, [w[:2] for w in want])
    assert Counter((r["doc_id"], r["lang_pred"]) for r in out) == Counter((i, name) for i, _, name in want)
