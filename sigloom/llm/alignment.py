"""Alignment of two tokenizers' tokens: byte-level BPE (A) and sentence pieces with byte fallback (B).

A text's bytes, with a space before them, get one label each: none, A-end, B-end or both,
by whether a token of A or of B ends with that byte. A regular expression scans the
labels for spans up to and including each both-label. How many A-ends and B-ends
a span has tells how many tokens of each side form the group: no token crosses its ends. Every
byte with a label but none closes one stretch that belongs to one token of A and one of B;
these stretches are the links, one for each pair of overlapping tokens.

Both tokenizers end a token before a single space between two other characters (A's pattern lets a
space only begin a piece, no piece of B has a space after another character, which is checked when it is loaded), so
words between such spaces are encoded by themselves, each distinct one once in a while, and
long texts are worked on in parts that end there. Text without such a space is one word.

Counts of linked id pairs over the whole corpus meet in blocks and buckets (`blocks`): texts are read and
encoded once, a written table holds each document's facts and link codes by block, a block sends each bucket of pairs one
array of its distinct pairs with their numbers, a bucket adds them up and answers. The highest count of
each B id is one number for each entry of B's vocabulary, at most MAX_VOCABULARY, and goes to every task.

Defined results: texts that are null or empty, or whose joined A or B bytes differ from space + text (B knows
no U+2581 but as a space), have no tokens: zeros and an empty digest, and no part in counts; rows without doc_id and
repeated rows count like any others; texts of any length are worked on in parts, but for 4 bytes a link.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import blocks as B
from sigloom.llm import textnp as T
from sigloom.session import bucketed

BLOCK = 16 << 20
#: Characters of a part of a text or of the texts handled at once.
PART = 1 << 19
#: Distinct words and tokens of them remembered by a task, and new words encoded together.
MEMO_WORDS, MEMO_TOKENS, TOGETHER = 400_000, 4_000_000, 1000
MAX_VOCABULARY = 1 << 20
A_END, B_END, BOTH = 1, 2, 3

CUT = re.compile(r" (?<=\S )(?=\S)")
SPAN = re.compile(rb"[^\x03]*\x03")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level entries: printable bytes themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers of a worker, the bytes of their entries and what is remembered of words."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        entries = self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece has a space after another character: words can't be encoded by themselves")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.asarray([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        self.strings = pa.array([f"{i},".encode() for i in range(n_a)] + [f"{i}|".encode() for i in range(n_a)] + [f"{i},".encode() for i in range(n_b)] + [f"{i};".encode() for i in range(n_b)], pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.a_ids, self.b_ids, self.a_ptr, self.b_ptr, self.whole = array("I"), array("I"), array("q", [0]), array("q", [0]), array("b")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of each text, which A has with a space before it."""
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        return [e.ids for e in encode([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)

    def remember(self, words: list[str], a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray, whole: np.ndarray) -> None:
        """Words with their ids side by side and their numbers of ids."""
        self.memo.update(zip(words, range(len(self.whole), len(self.whole) + len(words))))
        self.whole.frombytes(whole.astype(np.int8).tobytes())
        for ids, ptr, x, n in ((self.a_ids, self.a_ptr, a, a_n), (self.b_ids, self.b_ptr, b, b_n)):
            ptr.frombytes((len(ids) + np.cumsum(n)).astype(np.int64).tobytes())
            ids.frombytes(x.astype(np.uint32).tobytes())

    def learn(self, words: list[str]) -> None:
        """Encode words and remember them; whole tells whether both sides give back the bytes.

        Words that have no space in them or at either end, nor what B can't tell from one, are encoded together, some thousand at a time, as the text
        that they make; their tokens are told apart by bytes.
        """
        plain, apart = [], []
        for w in words:
            (apart if not w or w[0].isspace() or w[-1].isspace() or " " in w or "▁" in w else plain).append(w)
        groups = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        for group, a, b in zip(groups, *self.encode([" ".join(g) for g in groups])):
            a, b = np.asarray(a), np.asarray(b)
            data = (" " + " ".join(group)).encode()
            ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32)[1:], len(data))
            if len(ends) == len(group) and all(b"".join(map(side.__getitem__, x.tolist())) == data for side, x in ((self.a_bytes, a), (self.b_bytes, b))):
                n = [np.diff(np.searchsorted(np.cumsum(size[x]), ends, "right"), prepend=0) for size, x in ((self.a_len, a), (self.b_len, b))]
                self.remember(group, a, n[0], b, n[1], np.ones(len(group), bool))
            else:
                apart += group
        for w, a, b in zip(apart, *self.encode(apart)):
            data = (" " + w).encode()
            whole = b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b))
            self.remember([w], np.asarray(a), np.asarray([len(a)]), np.asarray(b), np.asarray([len(b)]), np.asarray([whole]))

    def words(self, words: list[str]) -> np.ndarray:
        """Places of words in what is remembered."""
        if len(self.memo) > MEMO_WORDS or len(self.a_ids) + len(self.b_ids) > MEMO_TOKENS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.memo]
        if new:
            self.learn(new)
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))


def gather(ids: np.ndarray, ptr: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of rows `at` side by side, and each row's number of items."""
    n = ptr[at + 1] - ptr[at]
    return ids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - ptr[at], n)], n


def labels_of(a_len: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """A label for each byte. Tokens have one byte at least."""
    out = np.zeros(int(a_len.sum()), np.uint8)
    out[np.cumsum(a_len) - 1] |= A_END
    out[np.cumsum(b_len) - 1] |= B_END
    return out


def span_counts(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A-ends and B-ends of each span up to a both-label."""
    spans = SPAN.findall(labels.tobytes())
    seen = {s: i for i, s in enumerate(set(spans))}
    counts = np.asarray([(s.count(A_END) + s.count(BOTH), s.count(B_END) + s.count(BOTH)) for s in seen], np.int64).reshape(-1, 2)
    out = counts[np.fromiter(map(seen.__getitem__, spans), np.int64, len(spans))]
    return out[:, 0], out[:, 1]


class Facts:
    """What is known of one document once all its parts are in."""

    def __init__(self):
        self.n = np.zeros(4, np.int64)
        self.digest, self.links, self.groups, self.ends, self.bytes, self.whole = hashlib.sha256(), [], [], [], 0, True

    def add(self, n: np.ndarray, n_bytes: int, text: memoryview, links: np.ndarray, ends: np.ndarray | None) -> None:
        if self.n[0]:
            self.digest.update(b";")
        self.digest.update(text)
        self.links.append(links)
        if ends is not None:
            self.groups.append(bytes(text).decode())
            self.ends.append(ends + self.bytes)
        self.n += n
        self.bytes += n_bytes


def align_parts(pair: Pair, parts: list[tuple[int, str]], facts: dict[int, Facts], keep: bool) -> None:
    """Adds what parts (document, text) come to to their documents' facts."""
    words, sizes = [], []
    for _, text in parts:
        w = CUT.split(text)
        words += w
        sizes.append(len(w))
    at, sizes = pair.words(words), np.asarray(sizes)
    whole = np.frombuffer(pair.whole, np.int8).astype(bool)[at]
    good = np.logical_and.reduceat(whole, np.cumsum(sizes) - sizes)
    for (doc, _), ok in zip(parts, good.tolist()):
        facts[doc].whole &= ok
    at, sizes = at[np.repeat(good, sizes)], sizes[good]
    docs = [doc for (doc, _), ok in zip(parts, good.tolist()) if ok]
    if not docs:
        return
    a, a_n = gather(np.frombuffer(pair.a_ids, np.uint32).astype(np.int64), np.frombuffer(pair.a_ptr, np.int64), at)
    b, b_n = gather(np.frombuffer(pair.b_ids, np.uint32).astype(np.int64), np.frombuffer(pair.b_ptr, np.int64), at)
    first = np.cumsum(sizes) - sizes
    a_to, b_to = np.cumsum(np.add.reduceat(a_n, first)), np.cumsum(np.add.reduceat(b_n, first))
    a_len = pair.a_len[a]
    labels = labels_of(a_len, pair.b_len[b])
    byte_to = np.cumsum(a_len)[a_to - 1]
    # groups: where each begins and ends among both sides' tokens
    a_in, b_in = span_counts(labels)
    a_end, b_end = np.cumsum(a_in), np.cumsum(b_in)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
    of_a, of_b = np.repeat(np.arange(len(a_in)), a_in), np.repeat(np.arange(len(b_in)), b_in)
    strings = np.empty(len(a) + len(b), np.int64)
    last = np.zeros(len(a), bool)
    last[a_end - 1] = True
    strings[np.arange(len(a)) + (b_end - b_in)[of_a]] = a + n_a * last
    last = np.zeros(len(b), bool)
    last[b_end - 1] = True
    strings[np.arange(len(b)) + a_end[of_b]] = 2 * n_a + b + n_b * last
    listed = pair.strings.take(pa.array(strings))
    _, offs, data = listed.buffers()
    text = memoryview(data) if data is not None else memoryview(b"")
    text_to = np.frombuffer(offs, np.int64, len(listed) + 1)[a_to + b_to]
    # links: every labelled byte closes a stretch of one token of each side
    place = np.flatnonzero(labels)
    label = labels[place]
    ia, ib = np.cumsum(label & A_END) - (label & A_END), np.cumsum(label >> 1) - (label >> 1)
    codes = a[ia] * n_b + b[ib]
    codes = codes.astype(np.uint32 if n_a * n_b < 1 << 32 else np.uint64)
    link_to = np.searchsorted(place, byte_to)
    ends = np.flatnonzero(labels == BOTH) + 1
    group_to = np.searchsorted(ends, byte_to, "right")
    tops = np.stack([a_to, b_to, group_to, link_to, text_to, byte_to], axis=1)
    for doc, low, top in zip(docs, np.r_[np.zeros((1, 6), np.int64), tops[:-1]].tolist(), tops.tolist()):
        own = ends[low[2] : top[2]] - low[5] if keep else None
        facts[doc].add(np.subtract(top[:4], low[:4]), top[5] - low[5], text[low[4] : top[4] - 1], codes[low[3] : top[3]], own)


def cut_parts(text: str, size: int) -> list[str]:
    """The text in parts of about `size` characters; a space where both tokenizers end a token is left out between them."""
    out, at = [], 0
    while len(text) - at > size:
        m = CUT.search(text, at + size)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.end()
    out.append(text[at:])
    return out


def align_texts(pair: Pair, texts: list[str | None], keep: bool = False, part: int = PART) -> list[Facts]:
    """Facts of every text. Texts of about `part` characters are worked on together."""
    facts = [Facts() for _ in texts]
    held, size = [], 0
    for i, text in enumerate(texts):
        for piece in cut_parts(text, part) if text else []:
            if held and size + len(piece) > part:
                align_parts(pair, held, facts, keep)
                held, size = [], 0
            held.append((i, piece))
            size += len(piece)
    if held:
        align_parts(pair, held, facts, keep)
    return [f if f.whole else Facts() for f in facts]


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a_path: str | None = None, b_path: str | None = None) -> Pair:
    """The worker's tokenizers; by default the public 50k byte-level entries and the 32k pieces."""
    if a_path is None or b_path is None:
        import public_tokenizers as P

        a_path, b_path = a_path or P.path("byte_bpe_50k.json"), b_path or P.path("piece_bpe_32k.model")
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def encoded(docs: DataFrame, keep: list[str], a_path: str | None, b_path: str | None, groups: bool) -> tuple[DataFrame, int, int]:
    """keep columns, facts, links (codes of each link) and _block of every document, written by block; numbers of buckets and blocks."""
    kept = docs.select("text", *keep)
    total = kept.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    more = ", groups string, group_ends array<long>" if groups else ""

    def run(batches):
        pair = pair_of(a_path, b_path)
        first, seq, size = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batches:
            for a, b, buf, _ in T.slices(batch.column(0)):
                if size and size + len(buf) > BLOCK:
                    seq, size = seq + 1, 0
                size += len(buf)
                part = batch.slice(a, b - a)
                facts = align_texts(pair, part.column(0).to_pylist(), groups)
                n = np.stack([f.n for f in facts])
                digests = [f.digest.hexdigest() if f.n[0] else "" for f in facts]
                links = [b"".join(x.tobytes() for x in f.links) for f in facts]
                cols = [*part.columns[1:], *[pa.array(n[:, i]) for i in range(4)], pa.array(digests, pa.string()), pa.array(links, pa.binary()), pa.array(np.full(b - a, first + seq))]
                if groups:
                    ends = [np.concatenate(f.ends) if f.ends else [] for f in facts]
                    cols[-2:-2] = [pa.array([";".join(f.groups) for f in facts], pa.string()), pa.array(ends, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = T.schema(kept, f"{FACTS}{more}, links binary, _block long", 1)
    names = schema.names
    blocks = max(4, -(-total // BLOCK))
    table = bucketed(kept.mapInArrow(run, schema), ["_block"], blocks, "aligned")
    return table, max(4, -(-total // min(B.MOST_BUCKET, max(B.LEAST_BUCKET, total >> 14)))), blocks


def align(docs: DataFrame, keep: list[str], a_path: str | None = None, b_path: str | None = None, groups: bool = False) -> DataFrame:
    """keep columns, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    With groups also the groups themselves, `a1,a2|b1;a3|b2,b3`, and the byte of space + text at which each ends.
    """
    pair = pair_of(a_path, b_path)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
    if n_b > MAX_VOCABULARY:
        raise ValueError(f"B has {n_b} entries; a number for each goes to every task, for {MAX_VOCABULARY} at most")
    kind = np.uint32 if n_a * n_b < 1 << 32 else np.uint64
    table, n_buckets, _ = encoded(docs, keep, a_path, b_path, groups)

    def own_codes(column) -> list[np.ndarray]:
        return [np.frombuffer(x, kind) for x in column.to_pylist()]

    def ask(t: pa.Table) -> pa.Table:
        codes, n = np.unique(np.concatenate(own_codes(t["links"])), return_counts=True)
        codes = codes.astype(np.uint64)
        out = list(B.packed(B.bucket_of(codes, n_buckets), n_buckets, t["_block"][0].as_py(), codes, n.astype(np.uint64)))
        return pa.Table.from_batches(out) if out else pa.table({"_bucket": pa.array([], pa.int32()), "_block": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})

    asked = table.select("_block", "links").groupBy("_block").applyInArrow(ask, B.MESSAGE)
    messages = bucketed(asked.repartition(n_buckets, "_bucket"), ["_bucket"], n_buckets, "pairs")

    def added(t: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """What each block sent, the bucket's distinct codes and their numbers in the corpus."""
        parts = B.unpack(t["data"], 2)
        items = np.concatenate(parts)
        order = np.argsort(items[:, 0], kind="stable")
        codes, n = items[order, 0], items[order, 1].astype(np.int64)
        new = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return parts, codes[new], np.add.reduceat(n, new)

    def highest(t: pa.Table) -> pa.Table:
        _, codes, n = added(t)
        best = np.zeros(n_b, np.int64)
        np.maximum.at(best, (codes % n_b).astype(np.int64), n)
        b = np.flatnonzero(best)
        return pa.table({"b": pa.array(b, pa.int32()), "best": pa.array(best[b])})

    best = np.zeros(n_b, np.int64)
    for r in messages.groupBy("_bucket").applyInArrow(highest, "b int, best long").groupBy("b").agg(F.max("best").alias("best")).collect():
        best[r["b"]] = r["best"]

    def answer(t: pa.Table) -> pa.Table:
        parts, codes, n = added(t)
        value = 2 * n + (n == best[(codes % n_b).astype(np.int64)])
        out = [np.stack([p[:, 0].view(np.int64), value[np.searchsorted(codes, p[:, 0])]], axis=1).tobytes() for p in parts]
        return pa.table({"_block": t["_block"], "data": pa.array(out, pa.binary())})

    def finish(t: pa.Table, answers: pa.Table) -> pa.Table:
        links = own_codes(t["links"])
        ptr = np.r_[0, np.cumsum([len(x) for x in links])]
        n_best = count = np.zeros(len(links), np.int64)
        if len(answers):
            known = np.concatenate(B.unpack(answers["data"], 2))
            known = known[np.argsort(known[:, 0])]
            value = known[np.searchsorted(known[:, 0], np.concatenate(links).astype(np.uint64)), 1].astype(np.int64)
            total = lambda x: np.diff(np.r_[0, np.cumsum(x)][ptr])
            n_best, count = total(value & 1), total(value >> 1)
        out = t.drop_columns(["links", "_block"])
        return out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count))

    answers = messages.groupBy("_bucket").applyInArrow(answer, B.ANSWER)
    schema = T.schema(table.drop("links", "_block"), "n_best long, count_sum long")
    return B.with_answers(table, answers, finish, schema)
