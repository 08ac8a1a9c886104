"""Substring deduplication with repeated-phrase automata.

A window is WINDOW consecutive words of a document. A word goes if a window that
covers it has a word sequence that also starts anywhere else in the table.

1. Recurring phrases. Each window's anchor is one of its PHRASE-word phrases, the one
   with the least hash (the leftmost of equals); windows with equal words have
   equal anchors. Blocks of documents send their anchors to buckets, which confirm
   the phrases that recur. A word stands as a 15-bit code in a phrase.
2. Automata. The recurring phrases of a block are compiled into Aho-Corasick automata,
   in shards of at most SHARD phrases, and the block's documents are streamed through
   them, three characters a word; they locate every occurrence. Automata are thus as
   many as the blocks, each of bounded size, and a document meets only phrases it may hold.
3. Confirmation. Windows anchored at a located occurrence go to buckets as 128-bit hashes of
   their words, which confirm those that start in two places or more.
4. Removal. The documents are streamed through their block's automata again; at each
   located occurrence the windows anchored there are compared with the confirmed
   ones, and the words they cover go. Nothing goes that no automaton located.

A hot passage costs each block one key per window however many copies it
has. Defined results: null and empty texts have no words; texts under WINDOW words
keep all; repeated rows are copies of each other; the kept text is its words joined
by one space.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import blocks as B
from sigloom.llm import textnp as T
from sigloom.session import materialise

WINDOW = 35
PHRASE = 8
SHARD = 20_000
#: A word's code has 15 bits. In the automata it is three characters of 5 bits, each from a range of its own: a node
#: then has few children, among which the automaton looks one by one, and no match begins within a word.
CODES = 1 << 15


class Words:
    """The words of a piece of texts, their codes and phrases."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, window: int):
        self.buf, self.offs, self.window = buf, offs, window
        s, e, self.ptr = T.words(buf, offs)
        self.first, self.end = s, e
        self.hash = T.range_hash(buf, s, e)
        n_words = np.diff(self.ptr)
        n = np.maximum(n_words - window + 1, 0)
        self.starts = np.repeat(self.ptr[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def anchors(self) -> np.ndarray:
        """For each window the word at which its anchor begins. Sets codes and the phrases k1, k2."""
        self.codes = (self.hash >> T.U64(40)) % T.U64(CODES)
        n = len(self.codes) - PHRASE + 1
        if n <= 0 or not len(self.starts):
            self.k1 = self.k2 = np.zeros(0, np.uint64)
            return np.zeros(0, np.int64)
        half = [self.codes[i : i + n] << T.U64(16 * (i % 4)) for i in range(PHRASE)]
        self.k1 = half[0] | half[1] | half[2] | half[3]
        self.k2 = half[4] | half[5] | half[6] | half[7]
        bits = max(24, int(n).bit_length())
        low = T.U64((1 << bits) - 1)
        key = (T.mix(self.k1 * T.U64(0x9FB21C651E98DF25) ^ T.mix(self.k2)) & ~low) | np.arange(n).astype(np.uint64)
        span, width = self.window - PHRASE + 1, 1
        least = key
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        return (least[self.starts] & low).astype(np.int64)

    def string(self) -> str:
        return letters(self.codes)


def letters(codes: np.ndarray) -> str:
    """Three characters for each code."""
    c = codes.astype(np.uint16)
    out = np.stack([0x100 + (c >> 10), 0x200 + ((c >> 5) & 31), 0x300 + (c & 31)], axis=1)
    return out.astype("<u2").tobytes().decode("utf-16-le")


def compile_shards(phrases: np.ndarray):
    """Automata over the phrases (k1, k2), SHARD in each."""
    texts = letters(np.frombuffer(phrases.astype("<u8").tobytes(), "<u2"))
    size = 3 * PHRASE
    for at in range(0, len(phrases), SHARD):
        a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for i in range(at, min(at + SHARD, len(phrases))):
            a.add_word(texts[size * i : size * (i + 1)])
        a.make_automaton()
        yield a


def located(w: Words, automata: list) -> np.ndarray:
    """Whether a recurring phrase begins at each word."""
    found = np.zeros(len(w.codes) + 1, bool)
    text = w.string()
    for a in automata:
        ends = [end for end, _ in a.iter(text)]
        found[np.asarray(ends, np.int64) // 3 - PHRASE + 1] = True
    return found


def automata_of(answers: list[np.ndarray]) -> list:
    items = np.concatenate(answers) if answers else np.zeros((0, 2), np.uint64)
    order, new = B.equal_rows(items)
    return list(compile_shards(items[order[new]]))


def candidates(w: Words, automata: list) -> tuple[np.ndarray, np.ndarray]:
    """The windows anchored at an occurrence the automata located: first words and 128-bit hashes."""
    anchor = w.anchors()
    starts = w.starts[located(w, automata)[anchor]] if len(anchor) else w.starts
    if not len(starts):
        return starts, np.zeros((0, 2), np.uint64)
    second = T.range_hash(w.buf, w.first, w.end, 1)
    return starts, np.stack([T.windows(w.hash, w.window)[starts], T.windows(second, w.window, 1)[starts]], axis=1)


def among(items: np.ndarray, sorted_items: np.ndarray) -> np.ndarray:
    """Whether each row of items is a row of sorted_items (sorted by the first column, then the second)."""
    lo, hi = np.searchsorted(sorted_items[:, 0], items[:, 0], "left"), np.searchsorted(sorted_items[:, 0], items[:, 0], "right")
    hit = np.zeros(len(items), bool)
    while (lo < hi).any():
        live = lo < hi
        hit[live] |= sorted_items[lo[live], 1] == items[live, 1]
        lo = lo + 1
    return hit


def deduplicate(docs: DataFrame, keep: list[str], window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """keep columns, n_words, n_removed, kept_sha256 of every row. with_text: also kept_text, the text itself where nothing goes."""
    table, n_buckets, _ = B.write_blocks(docs, keep, "substring")

    def phrases(batches):
        for batch in batches:
            ids = batch.column(1).to_numpy()
            cut = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, int)
            for a, b in zip(cut, np.r_[cut[1:], len(ids)]):
                found = []
                for _, _, buf, offs in T.slices(batch.column(0).slice(a, b - a)):
                    w = Words(buf, offs, window)
                    at = T.distinct(w.anchors())
                    found.append(np.stack([w.k1[at], w.k2[at]], axis=1))
                items = B.at_most_twice(np.concatenate(found))
                yield from B.packed(B.bucket_of(items[:, 0] ^ T.mix(items[:, 1]), n_buckets), n_buckets, int(ids[a]), items[:, 0], items[:, 1])

    def ask(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = np.zeros((0, 2), np.uint64)
        if len(answers) and len(texts):
            automata = automata_of(B.unpack(answers["data"], 2))
            keys = B.at_most_twice(np.concatenate([candidates(Words(buf, offs, window), automata)[1] for _, _, buf, offs in T.slices(texts["text"])]))
        block = texts["_block"][0].as_py() if len(texts) else 0
        got = list(B.packed(B.bucket_of(keys[:, 0], n_buckets), n_buckets, block, keys[:, 0], keys[:, 1]))
        return pa.Table.from_batches(got) if got else pa.table({"_bucket": pa.array([], pa.int32()), "_block": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})

    def strip(texts: pa.Table, answers: pa.Table) -> pa.Table:
        of = lambda kind: B.unpack(answers.filter(pc.equal(answers["kind"], kind))["data"], 2)
        confirmed = of(1)
        again = np.concatenate(confirmed) if confirmed else np.zeros((0, 2), np.uint64)
        again = again[np.lexsort((again[:, 1], again[:, 0]))]
        automata = automata_of(of(0)) if len(again) else []
        n_words, n_removed, digests, kept = [], [], [], []
        for _, _, buf, offs in T.slices(texts["text"]):
            w = Words(buf, offs, window)
            gone = np.zeros(len(w.hash), bool)
            if len(again) and len(w.starts):
                starts, keys = candidates(w, automata)
                hit = starts[among(keys, again)]
                step = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(step, hit, 1)
                np.add.at(step, hit + window, -1)
                gone = np.cumsum(step[:-1]) > 0
            data = buf.tobytes()
            lost = np.r_[0, np.cumsum(gone)]
            for d in range(len(offs) - 1):
                a, b = w.ptr[d], w.ptr[d + 1]
                whole = lost[b] == lost[a]
                ws = data[offs[d] : offs[d + 1]].split()
                if not whole:
                    ws = compress(ws, ~gone[a:b])
                text = b" ".join(ws)
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept.append(data[offs[d] : offs[d + 1]].decode() if whole else text.decode())
            n_words.append(np.diff(w.ptr))
            n_removed.append(lost[w.ptr[1:]] - lost[w.ptr[:-1]])
        cols = {c: texts[c] for c in keep} | {"n_words": pa.array(np.concatenate(n_words), pa.int64()), "n_removed": pa.array(np.concatenate(n_removed), pa.int64()), "kept_sha256": pa.array(digests)}
        return pa.table(cols | ({"kept_text": pa.array(kept, pa.string())} if with_text else {}))

    recurring = materialise(B.answer_repeated(table.select("text", "_block").mapInArrow(phrases, B.MESSAGE), 2), "phrases")
    confirmed = B.answer_repeated(B.with_answers(table.select("text", "_block"), recurring, ask, B.MESSAGE), 2)
    answers = recurring.withColumn("kind", F.lit(0)).unionByName(confirmed.withColumn("kind", F.lit(1)))
    schema = T.schema(table.select(*keep), "n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else ""))
    return B.with_answers(table, answers, strip, schema)
