"""Operator 11 against plain tokenization of whole texts, pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sigloom.llm import alignment, queries
from test_llm_operators import AWKWARD, SCHEMA, awkward, empty  # noqa: F401

PIECES = ["a", "Z", "1", " ", ".", ",", "'", "\n", "\t", "  ", " é", "日", "🎉", "▁", " ́", " the", "'s", "<s>", "<0x41>", "<|endoftext|>", "　", "\x1c", "\x85", " "]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def spans(ids, data):
    out, at = [], 0
    for i, d in zip(ids, data):
        out.append((i, at, at + len(d)))
        at += len(d)
    return out


def brute(tokenizers, text):
    """n_a, n_b, groups, links and group ends of one text, or None; every pair of tokens is looked at."""
    a, b = tokenizers
    whole = (" " + (text or "")).encode()
    ids, other = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    letters = alignment.byte_letters()
    x = spans(ids, [bytes(letters[c] for c in a.id_to_token(i)) for i in ids])
    y = spans(other, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other])
    joined = [b"".join(whole[s:e] for _, s, e in side) for side in (x, y)]
    data = [b"".join(bytes(letters[c] for c in a.id_to_token(i)) for i in ids), b"".join(bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other)]
    if not text or joined != [whole, whole] or data != [whole, whole]:
        return None
    links = [(i, j) for i, s, e in x for j, u, v in y if s < v and u < e]
    ends = sorted({e for *_, e in x} & {e for *_, e in y})
    groups = [(",".join(str(i) for i, _, e in x if s < e <= t), ",".join(str(j) for j, _, e in y if s < e <= t)) for s, t in zip([0, *ends], ends)]
    return len(x), len(y), ";".join("|".join(g) for g in groups), links, ends


def brute_rows(tokenizers, rows):
    """Rows of the registered query for (doc_id, text)."""
    found = [(d, brute(tokenizers, t)) for d, t in rows]
    count = Counter(p for _, f in found if f for p in f[3])
    best = {}
    for (_, j), n in count.items():
        best[j] = max(n, best.get(j, 0))
    out = []
    for d, f in found:
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((d, f[0], f[1], len(f[4]), len(f[3]), sum(count[p] == best[p[1]] for p in f[3]), sum(count[p] for p in f[3]), hashlib.sha256(f[2].encode()).hexdigest()))
    return Counter(out)


def random_texts(n, seed=3):
    rng = np.random.default_rng(seed)
    common = [x for x in PIECES if x != "▁"]
    return ["".join(rng.choice(common if i % 9 else PIECES, rng.integers(1, 40))) for i in range(n)]


@pytest.mark.parametrize("part", [1 << 19, 40])
def test_kernel_is_whole_text_tokenization(tokenizers, part):
    texts = random_texts(600) + ["x" * 3000, "foo  bar" + " q" * 300, "▁x", "x▁", " ", "\n", None, ""]
    for text, f in zip(texts, alignment.align_texts(alignment.pair_of(), texts, True, part)):
        want = brute(tokenizers, text)
        if want is None:
            assert f.n.tolist() == [0] * 4 and not f.links
            continue
        codes = np.concatenate(f.links).tolist()
        assert (*f.n[:2].tolist(), ";".join(f.groups), np.concatenate(f.ends).tolist()) == (*want[:3], want[4])
        assert Counter(divmod(c, 32000) for c in codes) == Counter(want[3])


def test_query_equals_brute_force(spark, tokenizers, tmp_path, small, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 20_000)
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if len(r["text"] or "") < 3000]
    rows = [(r[0], r[1]) for r in AWKWARD if len(r[1] or "") < 3000] + documents + list(enumerate(random_texts(80, 4), 10_000))
    wide = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id int, text string, n_a string, links int, _block int").repartition(5)
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_token_alignment(spark, str(tmp_path))
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert Counter(tuple(r) for r in got.collect()) == brute_rows(tokenizers, rows)


def test_real_outputs_and_awkward_tables(spark, tokenizers, awkward, empty):  # noqa: F811
    assert alignment.align(empty, ["doc_id"]).count() == 0
    out = alignment.align(awkward, ["doc_id"], groups=True).collect()
    assert len(out) == len(AWKWARD)
    for r in out:
        text = next(x[1] for x in AWKWARD if x[0] == r["doc_id"])
        if text and len(text) < 3000 and r["n_a"]:
            want = brute(tokenizers, text)
            assert (r["groups"], r["group_ends"]) == (want[2], want[4])
    long = next(r for r in out if r["doc_id"] == 8)
    assert long["group_ends"][-1] == len((" " + AWKWARD[-3][1]).encode()) and long["groups"].count("|") == long["n_groups"]
    nothing = spark.createDataFrame([(1, None, "", 0)], SCHEMA)
    assert tuple(alignment.align(nothing, ["doc_id"]).first())[1:] == (0, 0, 0, 0, "", 0, 0)
