"""The ten operators and the pipeline: awkward tables, brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigloom.llm import bpe, ctw, decontam, html, langid, mtree, neardup, quality, substring, textnp, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
AWKWARD = [
    (1, None, "en", 5), (2, "", "en", 0), (3, "   \n\t ", None, 3), (4, "one", "en", 3), (5, "one", "en", 3), (5, "one", "en", 3),
    (None, "a text without id that has some words in it", "en", 10), (6, "é ü   ñ 日本語 🎉", "xx", None), (7, "12 34 !! ??", "en", 11),
    (8, LONG, "en", len(LONG)), (9, "the same words again and again " * 30, "en", 1), (10, "the same words again and again " * 30, "en", 1),
]
SCHEMA = "doc_id long, text string, lang string, n_chars long"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    d = spark.createDataFrame(AWKWARD, SCHEMA)
    for c in ("score", "label", "kept", "n_words", "_block", "_id", "bands", "held_out", "n_tokens", "ids", "w", "_row", "component_id"):
        d = d.withColumn(c, F.lit("clash"))
    return d.repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def labels_of(spark, rows=((1, 1, 0), (2, 0, 0), (8, 1, 1), (8, 1, 0), (9, None, None))):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def low(text):
    return (text or "").encode().translate(bytes(textnp.LOWER.tolist()))


def in_fold(i, m, r):
    return i is None or zlib.crc32(str(i).encode()) % m == r


# words and hashes


def test_words_match_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n é\x0b日") for _ in range(rng.randrange(40))) for _ in range(200)] + [None, ""]
    for a, b, buf, offs in textnp.slices(pa.array(texts), 64):
        s, e, p = textnp.words(buf, offs)
        got = [[bytes(buf[s[k] : e[k]]).decode() for k in range(p[i], p[i + 1])] for i in range(b - a)]
        assert got == [WORD.findall(t or "") for t in texts[a:b]]


def test_hashes_depend_on_content_alone():
    buf = np.frombuffer(b"abc xx abc yy abcd abc", np.uint8)
    s, e, _ = textnp.words(buf, np.asarray([0, len(buf)]))
    h = textnp.range_hash(buf, s, e)
    assert h[0] == h[2] == h[5] and len(set(h.tolist())) == 4


# 1, 2, 10: classifiers


@pytest.mark.parametrize("op", [quality.classify, toxicity.classify])
def test_classifiers_take_awkward_tables(spark, awkward, empty, op):
    out = op(awkward, labels_of(spark)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out)
    assert all(r["held_out"] == in_fold(r["doc_id"], 5, 0) for r in out)
    assert op(empty, labels_of(spark)).count() == 0
    none = op(awkward, labels_of(spark).limit(0)).collect()
    assert len({r["score"] for r in none}) == 1


def test_quality_and_toxicity_on_held_out_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    q = quality.classify(d, lab).where("held_out").join(lab, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    t = toxicity.classify(d, lab).where("held_out").join(lab, "doc_id")
    hit, clean = t.where("toxic = 1").agg(F.avg("predicted")).first()[0], t.where("toxic = 0").agg(F.avg("predicted")).first()[0]
    assert q > 0.97 and hit > 0.8 and clean < 0.01


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(2)
    m = quality.FactorisationMachine(0.3, rng.normal(size=quality.N_FEATURES), rng.normal(size=(quality.N_FEATURES, 4)).astype(np.float32))
    ids, w = np.asarray([3, 700, 9000, 65_540]), np.asarray([0.5, 1.0, -0.2, 0.3])
    pairs = sum(float(m.factors[ids[i]] @ m.factors[ids[j]]) * w[i] * w[j] for i in range(4) for j in range(i))
    want = 0.3 + float(m.linear[ids] @ w) + pairs
    assert abs(m.raw(np.asarray([0, 4]), ids, w)[0] - want) < 1e-4


def test_nnpu_risk_stays_non_negative_and_separates():
    p = (np.asarray([0, 1, 2, 3]), np.asarray([0, 0, 0]))
    u = (np.asarray([0, 1, 2, 3, 4, 5]), np.asarray([0, 1, 1, 1, 1]))
    b, w = toxicity.nnpu(p, u, 0.2, 2)
    assert b + w[0] > 0 > b + w[1]


def test_language_id(spark, awkward, empty):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.99
    rows = {r["doc_id"]: r for r in langid.identify(awkward).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 7)] == ["und"] * 4 and rows[1]["score"] == 0
    assert rows[4]["lang_pred"] in ("en", "xx") and 0 <= rows[8]["score"] <= 1
    assert langid.identify(empty).count() == 0


# 3: substring dedup


def brute_substrings(rows, window):
    ws = [WORD.findall(t or "") for _, t in rows]
    n = Counter(tuple(w[k : k + window]) for w in ws for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, ws):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if n[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [8, 9, 35])
def test_substrings_against_brute_force(spark, docs, awkward, window):
    rng = random.Random(window)
    made = [(100 + i, " ".join(rng.choice("a b c d".split()) for _ in range(rng.randrange(120)))) for i in range(40)]
    rows = [(r[0], r[1]) for r in AWKWARD] + made + [tuple(r) for r in docs.select("doc_id", "text").collect()]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in substring.deduplicate(d, ["doc_id"], window).collect())
    assert got == brute_substrings(rows, window)


def test_substrings_empty_and_text(spark, awkward, empty):
    assert substring.deduplicate(empty, ["doc_id"]).count() == 0
    kept = {r["doc_id"]: r["kept_text"] for r in substring.deduplicate(awkward, ["doc_id"], with_text=True).collect()}
    assert kept[9] == "" and len(kept[8].split()) == 2 * 977 * 31 - 60_000 and kept[4] == "one"


# 4: HTML


def test_html_model_on_unseen_pages():
    pages = html.training_pages(150, seed=99)
    got = html.extract_many([re.sub(" data-y", "", p) for p, _ in pages], html.default_model())
    assert sum(g == t for g, (_, t) in zip(got, pages)) >= 140


def test_messages_give_exact_marginals():
    rng = np.random.default_rng(0)
    m = html.Model(rng.normal(size=(html.N_FEATURES, 2)), rng.normal(size=(html.N_KIND, 2, 2)))
    parent, kind = np.asarray([-1, 0, 0, 1, 1, 3]), np.asarray([0, 1, 2, 3, 4, 5])
    x = rng.normal(size=(6, html.N_FEATURES))
    p = np.zeros((6, 2))
    for code in range(64):
        y = [(code >> i) & 1 for i in range(6)]
        s = sum(float(x[i] @ m.unary[:, y[i]]) for i in range(6)) + sum(m.edge[kind[i], y[parent[i]], y[i]] for i in range(1, 6))
        for i in range(6):
            p[i, y[i]] += math.exp(s)
    got, _, z = m.infer(x, kind, parent, html.levels(parent))
    assert np.allclose(got, p / p.sum(axis=1, keepdims=True)) and abs(z - math.log(p[0].sum())) < 1e-9


def test_html_awkward_pages(spark):
    page = "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/a>a</a></ul></nav><article><h1>Head &amp; line</h1><p>One two three, four five six seven.<p>Next   one\n is here, and it goes on &lt;b&gt; for a while.<br>More of it.</article><div class='comments'><p>I disagree, said a reader.</p></div><footer>&copy; x</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<"), (5, "u", "</p></div>"), (6, "u", "<p " * 50), (1, "u", page)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    out = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract(d, ["page_id", "url"]).collect())
    want = "Head & line\n\nOne two three, four five six seven.\n\nNext one is here, and it goes on <b> for a while. More of it."
    assert out[0] == out[1] == (1, want, len(want)) and [o[2] for o in out[2:4]] == [0, 0] and all(o[2] == len(o[1]) for o in out)
    assert html.extract(d.limit(0), ["page_id", "url"]).count() == 0


# 5: M-tree


@pytest.mark.parametrize("shape", ["random", "copies", "line"])
def test_mtree_against_brute_force(shape):
    rng = np.random.default_rng(4)
    x = {"random": rng.integers(-80, 80, (1500, 8)), "copies": np.repeat(rng.integers(-9, 9, (3, 8)), 500, axis=0), "line": np.arange(1500)[:, None] * np.ones((1, 8), int)}[shape]
    ids = rng.permutation(len(x))
    tree = mtree.MTree(ids, x)
    for i in range(0, len(x), 97):
        s = x @ x[i]
        want = sorted(((-int(s[j]), int(ids[j])) for j in range(len(x)) if ids[j] != ids[i]))[:5]
        assert tree.search(int(ids[i]), x[i], 5) == [(-a, b) for a, b in want]


def test_mtree_awkward_table(spark):
    rows = [(0, [1.0, 0.5]), (50, [0.25, None]), (100, None), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [-1.0]), (None, [1.0, 1.0]), (150, [])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in mtree.top_k(d).collect())
    assert [g for g in got if g[0] == 0] == [(0, 1, 1, 81920), (0, 2, 1, 81920), (0, 3, 150, 0), (0, 4, 4, -65536)]
    assert {g[0] for g in got} == {0, 150} and mtree.top_k(d.limit(0)).count() == 0


# 6: context-tree weighting


def test_ctw_is_a_distribution(spark):
    """The probabilities of all symbols after a context add up to one, with every depth in play."""
    rng = np.random.default_rng(5)
    data = rng.choice(np.frombuffer(b"abca ", np.uint8), 3000)
    u, ptr = ctw.codes(data, np.asarray([0, 1500, 3000]), 4)
    keys, n = ctw.tally(u)
    context = np.uint64(0x61_62_63_61_00)
    every = np.unique(np.r_[keys, context | np.arange(256, dtype=np.uint64)])
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, keys)] = n
    deep = ctw.weigh(every, counts, 4, 3)
    pair, at = np.unique(((every >> np.uint64(24)) << np.uint64(8)) | (every & np.uint64(255)), return_inverse=True)
    mid = ctw.weigh(pair, np.bincount(at, counts, len(pair)), 2, 2, (deep.keys, deep.sums))
    latest, to = np.unique(((pair >> np.uint64(16)) << np.uint64(8)) | (pair & np.uint64(255)), return_inverse=True)
    model = ctw.Top(latest, np.bincount(to, np.bincount(at, counts, len(pair)), len(latest)), mid.keys, mid.sums)
    below = np.where(deep.seen, mid.a[at] + mid.b[at] * deep.c, mid.c[at])
    p = 10 ** model.log10(every, below, mid.seen[at], 4)
    mine = (every >> np.uint64(8)) == (context >> np.uint64(8))
    assert mine.sum() == 256 and abs(p[mine].sum() - 1) < 1e-9


def plain_ctw(train, texts, depth):
    """Context-tree weighting by dictionaries."""
    seq = lambda t: bytes(depth) + low(t) + b"\xff"
    count = defaultdict(lambda: [0, 0])
    kids = defaultdict(set)

    def steps(t):
        s = seq(t)
        for i in range(depth, len(s)):
            node = 1
            for k in range(7, -1, -1):
                yield s, i, node, (s[i] >> k) & 1
                node = 2 * node + ((s[i] >> k) & 1)

    for t in train:
        for s, i, node, bit in steps(t):
            for d in range(depth + 1):
                count[s[i - d : i], node][bit] += 1
                if d:
                    kids[s[i - d + 1 : i], node].add(s[i - d : i])
    pe = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for k, (a, b) in count.items()}
    pw, share = {}, {}
    for c, node in sorted(count, key=lambda k: -len(k[0])):
        if len(c) == depth:
            pw[c, node], share[c, node] = pe[c, node], 1.0
        else:
            rest = sum(pw[x, node] for x in kids[c, node])
            share[c, node] = 1 / (1 + math.exp(max(-700, min(700, rest - pe[c, node]))))
            pw[c, node] = np.logaddexp(pe[c, node], rest) - math.log(2)
    out = []
    for t in texts:
        total = 0.0
        for s, i, node, bit in steps(t):
            p = None
            for d in range(depth, -1, -1):
                key = (s[i - d : i], node)
                if key in count:
                    a = count[key]
                    e = (a[bit] + 0.5) / (sum(a) + 1)
                    p = e if p is None else share[key] * e + (1 - share[key]) * p
            total += math.log10(0.5 if p is None else p)
        out.append(total)
    return out


@pytest.mark.parametrize("part", [256, 1])
def test_ctw_against_dictionaries(spark, awkward, empty, monkeypatch, part):
    if part == 1:  # many blocks, each a part of its own, merged as a tree
        monkeypatch.setattr(ctw, "BLOCK", 300)
        monkeypatch.setattr(ctw, "PART", 2)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", "on", "mat", "é"]) for _ in range(rng.randrange(25)))) for i in range(60)] + [(200, None), (201, ""), (None, "cat")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = lambda i: in_fold(i, 7, 2)
    got = {(r["doc_id"]): r for r in ctw.score(d, ["doc_id"]).collect()}
    train = [t for i, t in rows if not held(i)]
    c = Counter(w for t in train for w in low(t).split() + [b" "])
    n, v = sum(c.values()), len(c)
    for (i, t), want in zip(rows, plain_ctw(train, [t for _, t in rows], ctw.DEPTH)):
        ws = low(t).split() + [b" "]
        r = got[i]
        assert abs(r["score"] - want) < 1e-3 + 1e-5 * abs(want), (i, t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(ws), sum(x in c for x in ws), n)
        assert abs(r["bits_per_byte"] + r["score"] / math.log10(2) / (len(low(t)) + 1)) < 1e-9
        assert abs(r["base_score"] - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-9
    assert ctw.score(empty, ["doc_id"]).count() == 0
    assert ctw.score(awkward, ["doc_id"]).where("score is null or score > 0").count() == 0


def test_ctw_without_training_texts(spark):
    i = next(i for i in range(99) if in_fold(i, 7, 2))
    r = ctw.score(spark.createDataFrame([(i, "ab")], "doc_id long, text string"), ["doc_id"]).first()
    assert abs(r["score"] - 24 * math.log10(0.5)) < 1e-9 and r["train_tokens"] == 0 and r["n_known"] == 0


# 7: near-duplicates


def shingle_set(text, k):
    w = low(text).split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_groups(rows, k=4):
    sets = [shingle_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                up[find(a)] = find(b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in least[find(i)] if x is not None), default=None) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return Counter(out)


def near_copies(seed=8, n=120):
    rng = random.Random(seed)
    bases = [[f"b{b}w{rng.randrange(500)}" for _ in range(rng.choice([6, 40, 160]))] for b in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def test_near_duplicates_against_brute_force(spark, awkward, empty, docs):
    rows = [(r[0], r[1]) for r in AWKWARD] + near_copies() + [tuple(r) for r in docs.select("doc_id", "text").collect() if r["doc_id"] > 20]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in neardup.group(d, ["doc_id"]).collect()) == brute_groups(rows)
    assert neardup.group(empty, ["doc_id"]).count() == 0 and neardup.group(awkward, ["doc_id"]).count() == len(AWKWARD)


def test_hot_groups_in_parts_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 8)
    rows = near_copies(9, 100)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in neardup.group(d, ["doc_id"]).collect()) == brute_groups(rows)


def test_odd_sketch_estimates():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (400, 50, 50))
    sets = [np.unique(np.r_[common, a]), np.unique(np.r_[common, b])]
    s = neardup.odd_sketch(neardup.signatures(np.asarray([0, 450, 900]), np.concatenate(sets)))
    n = int(np.bitwise_count(s[0] ^ s[1]).sum())
    assert abs(n - neardup.expected_count(0.8)) < 30 and n <= neardup.count_limit(0.8)


# 8: decontamination


def test_planted_leaks_and_parameters(spark, awkward, empty):
    items = [(1, "Tom Baker has 12 apples and gives 3 apples to Mary before noon . Then he walks 5 km to the market and sells 9 apples for 2 dollars each"), (2, None), (3, ""), (4, "too few words"), (1, "Tom Baker has 12 apples and gives 3 apples to Mary before noon . Then he walks 5 km to the market and sells 9 apples for 2 dollars each")]
    other = "So Ann Clark has 40 apples and gives 7 apples to Sue before noon . Then he walks 8 miles to the market and sells 11 apples for 6 euros each"
    mixed = other.replace("7 apples to Sue", "40 apples to Clark").replace("11 apples", "40 apples")
    rows = [(1, items[0][1]), (2, "x " * 300 + items[0][1].upper() + " y" * 300), (3, other), (4, "apples and market"), (5, None), (6, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.matches(d, b).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3} and all(r["item_id"] == 1 for r in got) and len(got) == 6
    assert {r["changed_slots"] for r in got if r["doc_id"] == 3} > {0} or min(r["changed_slots"] for r in got if r["doc_id"] == 3) >= 5
    twisted = items[0][1].replace("12 apples", "3 apples")
    slots = spark.createDataFrame([(7, twisted)], "item_id long, text string")
    assert decontam.matches(spark.createDataFrame([(3, other)], "doc_id long, text string"), slots).count() == 0 and mixed
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(d, b).collect()) == [4, 5, 6]
    assert decontam.matches(empty, b).count() == 0 and decontam.matches(awkward, b.limit(0)).count() == 0 and decontam.matches(awkward, b).count() == 0


def test_every_full_copy_of_an_item_is_found(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    b = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    norm = lambda t: " ".join((t or "").lower().split())
    items = [(r["item_id"], norm(r["text"])) for r in b.collect()]
    texts = [(r["doc_id"], norm(r["text"])) for r in d.select("doc_id", "text").collect()]
    want = {(i, k) for i, t in texts for k, u in items if u in t}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.matches(d, b).collect()} == want


# 9: byte-level BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.codec().ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    rng = random.Random(11)
    parts = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "é", "日", "1", "!", "\t", "the", " the", "x" * 50, "ab" * 40, " ", "🎉", "''", "l", "\x00", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 30, 400, 3000 if i % 20 == 0 else 10]))) for i in range(1500)]
    texts += ["a" * 3000, "ab" * 4000, "".join(rng.choice("abcdefgh") for _ in range(9000)), " " * 5000 + "x", LONG]
    c = bpe.codec()
    for t in texts:
        ids = c.encode(t)
        assert ids == library.encode_ordinary(t) and c.decode(ids) == t.encode()


def test_bpe_awkward_table(awkward, empty, library):
    for r in bpe.encode(awkward, ["doc_id"]).join(awkward.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.encode(empty, ["doc_id"]).count() == 0


def test_mtree_in_many_trees_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 40)
    monkeypatch.setattr(mtree, "BLOCK", 1)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(400, 5))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q = np.floor(256 * x)
    want = [(i, k + 1, j, -s) for i in range(0, 400, 4) for k, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in range(400) if j != i)[:3])]
    assert sorted(tuple(r) for r in mtree.top_k(d, k=3, every=4).collect()) == sorted(want)


def test_bpe_long_runs(library):
    """Runs that move every token when a half is joined: the heap merges as the plain way does, and windows end right."""
    c = bpe.codec()
    rng = np.random.default_rng(8)
    for unit, n in (("a", 5000), ("-", 3001), ("-=", 2000), ("é", 1500), ("ab", 1)):
        text = unit * n if n > 1 else "".join(rng.choice(list("ab"), 3000))
        assert c.encode(text) == library.encode_ordinary(text)
        data = text.encode()[:1500]
        want = [c.ranks[data]] if data in c.ranks else c.merge_long(data)
        assert want == library._encode_single_piece(data) == c.piece(data)
