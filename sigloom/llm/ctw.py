"""Language-model scoring by context-tree weighting over bytes.

A text is its bytes (A-Z in lower case) and one end symbol, 0xFF, which UTF-8 never uses;
contexts before its start are zero bytes. A byte is eight binary decisions down
a tree of 255 nodes. For each context of 0 to DEPTH bytes and each node, the training
corpus gives the counts (a, b) of either bit, the Krichevsky-Trofimov probability P_e of its
decisions, and from the deepest contexts up

    P_w = 1/2 (P_e + product of the longer contexts' P_w).

A node's share of its own estimate is P_e / (2 P_w). The trained tree is then fixed:
a bit's probability mixes (a + 1/2) / (a + b + 1) of every depth with those shares,
ending where training never saw the longer context. Each byte thus has a
distribution over 256 symbols, and a text's score is a proper log10 probability.

Counts are exact and cover the whole training fold. Blocks of documents send the distinct
contexts and words they hold, with training counts, to buckets of the key space: contexts by
their SPLIT latest bytes, so that a bucket has whole subtrees below that depth, which it
weighs. What a bucket's subtrees come to goes up to middle groups by the two latest
bytes, which weigh the depths from SPLIT - 1 to 2, and from there to the two top levels
(at most 256 * 255 + 255 nodes), which the driver adds up and broadcasts. Then the
buckets weigh their subtrees again, now with what is above them, and answer each block.
From more than PART blocks on, a bucket's messages meet in parts of about PART blocks, are merged
as a tree, and each part has its answers in a task of its own, so that even the commonest
context puts only its distinct longer contexts into one task, not one entry for each block.

The unigram baseline is the sum of log10((c + 1) / (N + 1 * (V + 1))) over words and end.

Defined results: null and empty texts have one token, the end; rows without doc_id are
held out; without training texts every bit has probability 1/2 and every count is 0;
repeated rows get a row each and count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import blocks as B
from sigloom.llm import samples as S
from sigloom.llm import textnp as T
from sigloom.session import bucketed, materialise

DEPTH = 7
#: Contexts share a bucket by so many latest bytes.
SPLIT = 4
#: Blocks whose messages to a bucket meet in one task, about.
PART = 1024
#: Middle groups.
MIDDLE = 256
END = 0xFF
#: The end token of the baseline, apart from all words' hashes.
END_TOKEN = T.U64(0xE0D0E0D0E0D0E0D1)
BLOCK = 16 << 20
N_BITS = 8


def codes(low: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A code for each byte and end, latest context byte first and the symbol last, and row pointers."""
    n = len(offs) - 1
    size = np.diff(offs)
    at = offs[:-1] + np.arange(n) * (depth + 1) + depth
    flat = np.zeros(len(low) + n * (depth + 1), np.uint8)
    row = np.repeat(np.arange(n), size)
    flat[np.arange(len(low)) + (row + 1) * depth + row] = low
    flat[at + size] = END
    ptr = np.r_[0, np.cumsum(size + 1)]
    flat = flat.astype(np.uint64)
    every = flat.copy()
    for j in range(1, depth + 1):
        every[j:] |= flat[: len(flat) - j] << T.U64(8 * (depth - j + 1))
    return every[np.arange(ptr[-1]) + np.repeat(at - ptr[:-1], size + 1)], ptr


def tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, with how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def merge(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Union of two sorted tallies; m None: zeros."""
    both = np.concatenate([a, b])
    counts = np.concatenate([n, np.zeros(len(b), np.int64) if m is None else m])
    order = np.argsort(both, kind="stable")
    both, counts = both[order], counts[order]
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
    return both[first], np.add.reduceat(counts, first) if len(first) else counts


def merge_all(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    return merge(keys, counts, keys[:0], counts[:0])


class Tallies:
    """A growing union that is merged whenever much is pending, so that little is held at once."""

    def __init__(self, pending: int = 1_000_000):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.pending = 0, pending

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > self.pending + len(self.parts[0][0]):
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return merge_all(self.parts) if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def tokens(low: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each row's last word, and row pointers."""
    s, e, p = T.words(low, offs)
    return np.insert(T.range_hash(low, s, e), p[1:], END_TOKEN), p + np.arange(len(p))


def bit_nodes(symbol: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The node that decides bit k of each symbol, and that bit."""
    return (T.U64(1) << T.U64(k)) | (symbol >> T.U64(8 - k)), ((symbol >> T.U64(7 - k)) & T.U64(1)).astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, shifted by three; x > 0."""
    y = x + 3.0
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(x * (x + 1) * (x + 2))


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


_FEW = 128
_KT = _log_kt(*np.meshgrid(np.arange(_FEW, dtype=float), np.arange(_FEW, dtype=float), indexing="ij"))


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log P_e of a zeros and b ones; small counts by table."""
    few = (a < _FEW) & (b < _FEW)
    out = _KT[np.where(few, a, 0).astype(np.int64), np.where(few, b, 0).astype(np.int64)]
    if not few.all():
        out[~few] = _log_kt(a[~few], b[~few])
    return out


def own_share(pe: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """P_e / (P_e + product of the longer contexts' P_w)."""
    return 1 / (1 + np.exp(np.clip(rest - pe, -700, 700)))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(keys, return_inverse=True)
    return u, np.bincount(at, values, len(u))


def shorter(u: np.ndarray) -> np.ndarray:
    """Codes or (context, node) keys with the context's earliest byte left off."""
    return ((u >> T.U64(16)) << T.U64(8)) | (u & T.U64(255))


@dataclass
class Weighed:
    """What depths top to least make of each code and bit: a + b x where the context longer than top was seen and gives x, otherwise c; whether depth least was seen; and sums of log P_w by (context, node) of depth least - 1."""

    a: np.ndarray | None
    b: np.ndarray | None
    c: np.ndarray
    seen: np.ndarray
    keys: np.ndarray
    sums: np.ndarray


def weigh(u: np.ndarray, counts: np.ndarray, top: int, least: int, rest: tuple[np.ndarray, np.ndarray] | None = None) -> Weighed:
    """Depths top to least of the sorted codes u (top context bytes and the symbol). rest: sums of log P_w of the contexts longer than top, by (context, node), or None if there are none (then a and b are None).

    At each depth the distinct codes are sorted by context and symbol, so that the codes of a
    node are neighbours for every bit.
    """
    some = lambda kind=float: np.zeros((len(u), N_BITS), kind)
    a, b, c, seen_all = (some() if rest else None), (some() if rest else None), some(), some(bool)
    codes_, n, to, longer, step, keys, sums = u, counts.astype(np.float64), slice(None), None, None, [], []
    for d in range(top, least - 1, -1):
        if d < top:
            codes_, step = np.unique(shorter(codes_), return_inverse=True)
            n = np.bincount(step, n, len(codes_))
            to = step if isinstance(to, slice) else step[to]
        nodes = []
        for k in range(N_BITS):
            node, bit = bit_nodes(codes_ & T.U64(255), k)
            new = np.ones(len(codes_), bool)
            group = codes_ >> T.U64(8 - k)
            new[1:] = group[1:] != group[:-1]
            first, run = np.flatnonzero(new), np.cumsum(new) - 1
            total = np.add.reduceat(n, first) if len(first) else n
            ones = np.add.reduceat(n * bit, first) if len(first) else n
            pe = log_kt(total - ones, ones)
            e = ((np.where(bit == 1, ones[run], total[run] - ones[run]) + 0.5) / (total[run] + 1))[to]
            seen = (total > 0)[run][to]
            below, pw = None, pe
            if longer is not None:
                below = np.bincount(run[step[longer[k][0]]], longer[k][1], len(first))
            elif rest is not None:
                below = rest[1][np.searchsorted(rest[0], ((codes_ >> T.U64(8)) << T.U64(8) | node)[first])]
            if below is None:
                c[:, k] = e
            else:
                share = own_share(pe, below)[run][to]
                pw = np.logaddexp(pe, below) - np.log(2)
                if longer is None:
                    a[:, k], b[:, k], c[:, k] = share * e, 1 - share, e
                else:
                    was = seen_all[:, k]
                    c[:, k] = np.where(was, share * e + (1 - share) * c[:, k], e)
                    if rest:
                        a[:, k] = np.where(was, share * e + (1 - share) * a[:, k], e)
                        b[:, k] = np.where(was, (1 - share) * b[:, k], 0)
            seen_all[:, k] = seen
            nodes.append((first, pw))
            if d == least:
                key, value = summed(shorter(((codes_ >> T.U64(8)) << T.U64(8) | node)[first]), pw)
                keys.append(key)
                sums.append(value)
        longer = nodes
    keys, sums = np.concatenate(keys), np.concatenate(sums)
    order = np.argsort(keys)
    return Weighed(a, b, c, seen_all, keys[order], sums[order])


class Top:
    """The nodes of depth 0 and 1: counts by (latest byte, symbol) and sums of log P_w over the contexts of depth 2."""

    def __init__(self, pair_codes: np.ndarray, pair_counts: np.ndarray, keys: np.ndarray, sums: np.ndarray):
        n = np.zeros((256, 256))
        np.add.at(n, ((pair_codes >> 8).astype(np.int64), (pair_codes & 255).astype(np.int64)), pair_counts)
        counts = np.zeros((256, 256, 2))  # latest byte, node, bit
        every = np.arange(256).astype(np.uint64)
        for k in range(N_BITS):
            node, bit = bit_nodes(every, k)
            np.add.at(counts, (slice(None), node.astype(np.int64), bit), n)
        rest = np.zeros((256, 256))
        np.add.at(rest, ((keys >> 8).astype(np.int64), (keys & 255).astype(np.int64)), sums)
        pe = log_kt(counts[..., 0], counts[..., 1])
        self.share1, self.counts1 = own_share(pe, rest), counts
        pw1 = np.logaddexp(pe, rest) - np.log(2)
        self.counts0 = counts.sum(axis=0)
        self.share0 = own_share(log_kt(self.counts0[:, 0], self.counts0[:, 1]), pw1.sum(axis=0))

    def log10(self, u: np.ndarray, below: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of each code's symbol."""
        symbol, latest = u & T.U64(255), (u >> T.U64(8 * depth)).astype(np.int64)
        product = np.ones(len(u))
        for k in range(N_BITS):
            node, bit = bit_nodes(symbol, k)
            node = node.astype(np.int64)
            n1, n0 = self.counts1[latest, node].sum(axis=1), self.counts0[node].sum(axis=1)
            e1 = (self.counts1[latest, node, bit] + 0.5) / (n1 + 1)
            e0 = (self.counts0[node, bit] + 0.5) / (n0 + 1)
            s1, s0 = self.share1[latest, node], self.share0[node]
            p = np.where(known[:, k], s1 * e1 + (1 - s1) * below[:, k], e1)
            p = np.where(n1 > 0, s0 * e0 + (1 - s0) * p, e0)
            product *= p
        return np.log10(product)


def lower_slices(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Small pieces: each byte takes some hundred bytes of arrays while its piece is worked on."""
    for a, b, buf, offs in T.slices(column, 1 << 20):
        yield a, b, T.LOWER[buf], offs


ENTRY, PARTIAL, MESSAGE, TOP = range(4)


def code_bucket(u: np.ndarray, depth: int, n: int) -> np.ndarray:
    """Buckets of contexts, 0 to n - 1."""
    return B.bucket_of(u >> T.U64(8 * (depth + 1 - min(SPLIT, depth))), n)


def word_bucket(words: np.ndarray, n: int) -> np.ndarray:
    """Buckets of words, -n to -1."""
    return B.bucket_of(words, n) - n


def pack(x: np.ndarray, drop: int = 0) -> bytes:
    """An array's bytes by significance, the least `drop` left out, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T[drop:].tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, kind, drop: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    part = np.frombuffer(raw, np.uint8).reshape(size - drop, -1)
    out = np.zeros((part.shape[1], size), np.uint8)
    out[:, drop:] = part.T
    return out.view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(data: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def by_bucket(buckets: np.ndarray):
    """(bucket, positions) of each bucket that occurs."""
    order = np.argsort(buckets, kind="stable")
    b = buckets[order]
    at = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    for first, end in zip(at.tolist(), np.r_[at[1:], len(b)].tolist()):
        yield int(b[first]), order[first:end]


def block_tally(texts: pa.Table, make) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct codes or tokens, and how often each occurs in training."""
    held = texts["held_out"].to_numpy(zero_copy_only=False)
    u = distinct(make(low, offs)[0] for _, _, low, offs in lower_slices(texts["text"]))
    n = np.zeros(len(u), np.int64)
    for a, b, low, offs in lower_slices(texts["text"]):
        values, ptr = make(low, offs)
        seen, counts = tally(values[np.repeat(~held[a:b], np.diff(ptr))])
        n[np.searchsorted(u, seen)] += counts
    return u, n


def distinct(pieces: Iterator[np.ndarray], pending: int = 1_000_000) -> np.ndarray:
    """The sorted distinct values of all pieces, of which little is held at once."""
    whole, parts, size = np.zeros(0, np.uint64), [], 0
    for piece in pieces:
        parts.append(T.distinct(piece))
        size += len(parts[-1])
        if size > pending + len(whole):
            whole, parts, size = T.distinct(np.concatenate([whole, *parts])), [], 0
    return T.distinct(np.concatenate([whole, *parts])) if parts else whole


def tally_of(keys, counts) -> tuple[np.ndarray, np.ndarray]:
    """The merged tallies of a group of packed ones."""
    out = Tallies()
    for k, n in zip(keys, counts):
        out.add(unpack_sorted(k.as_py()), unpack(n.as_py(), np.int64))
    return out.total()


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def rows_of(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], ARROW[kind]) for i, (name, kind) in enumerate(fields)})


def score(docs: DataFrame, keep: list[str], depth: int = DEPTH, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """keep columns, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of docs (doc_id, text). depth: 3 to 7."""
    split = min(SPLIT, depth)
    marked = docs.select("text", *keep, S.fold(F.col("doc_id"), modulus, remainder).alias("held_out"))
    table, buckets, blocks = B.write_blocks(marked, [*keep, "held_out"], "ctw", BLOCK)
    buckets *= 2  # a code takes more room than a word
    parts, middles = -(-blocks // PART), min(MIDDLE, buckets)
    message = "_bucket int, _part int, _block long, a binary, b binary"
    fact = "kind int, _bucket int, _part int, _block long, n long, v long, a binary, b binary, c binary, d binary"
    reply = "_bucket int, _block long, data binary"

    def ask(t: pa.Table) -> pa.Table:
        block = t["_block"][0].as_py()
        part, rows = int(T.mix(np.asarray([block], np.uint64))[0] % T.U64(parts)), []
        for make, bucket in ((lambda x, o: codes(x, o, depth), lambda u: code_bucket(u, depth, buckets)), (tokens, lambda u: word_bucket(u, buckets))):
            keys, counts = block_tally(t, make)
            rows += [(g, part, block, pack_sorted(keys[at]), pack(counts[at])) for g, at in by_bucket(bucket(keys))]
        return rows_of(message, rows)

    def gather(t: pa.Table) -> pa.Table:
        """A part's tally, and where in it each block's keys are."""
        bucket, part = t["_bucket"][0].as_py(), t["_part"][0].as_py()
        u, n = tally_of(t["a"], t["b"])
        entries = [(ENTRY, bucket, part, block, None, None, pack_sorted(np.searchsorted(u, unpack_sorted(a.as_py())).astype(np.int32)), None, None, None) for block, a in zip(t["_block"].to_pylist(), t["a"])]
        return rows_of(fact, [*entries, (PARTIAL, bucket, part, None, int(n.sum()), None, pack_sorted(u), pack(n), None, None)])

    def combine(t: pa.Table) -> pa.Table:
        u, n = tally_of(t["a"], t["b"])
        return rows_of(fact, [(PARTIAL, t["_bucket"][0].as_py(), t["_part"][0].as_py() // PART, None, int(n.sum()), None, pack_sorted(u), pack(n), None, None)])

    def learn(t: pa.Table) -> pa.Table:
        """What a bucket has to say to the depths above: (context, symbol) with counts, (context, node) with sums. Of words: their numbers."""
        bucket = t["_bucket"][0].as_py()
        u, n = tally_of(t["a"], t["b"])
        if bucket < 0:
            return rows_of(fact, [(TOP, bucket, None, None, int(n.sum()), int(np.count_nonzero(n)), None, None, None, None)])
        w = weigh(u, n, depth, split)
        pair, at = np.unique(above(u), return_inverse=True)
        count = np.bincount(at, n, len(pair)).astype(np.int64)
        latest = lambda x: B.bucket_of(x >> T.U64(8 * (split - 2)), middles)
        sums, rows = dict(by_bucket(latest(w.keys))), []
        for g, i in by_bucket(latest(pair)):
            rows.append((MESSAGE, bucket, g, None, None, None, pack_sorted(pair[i]), pack(count[i]), pack_sorted(w.keys[sums[g]]), pack(w.sums[sums[g]])))
        return rows_of(fact, rows)

    def above(u: np.ndarray) -> np.ndarray:
        """(context of split - 1 bytes, symbol) of codes."""
        return ((u >> T.U64(8 * (depth - split + 2))) << T.U64(8)) | (u & T.U64(255))

    def middle(t: pa.Table) -> pa.Table:
        pairs = [unpack_sorted(x.as_py()) for x in t["a"]]
        u, n = merge_all([(p, unpack(c.as_py(), np.int64)) for p, c in zip(pairs, t["b"])])
        rest = summed(np.concatenate([unpack_sorted(x.as_py()) for x in t["c"]]), np.concatenate([unpack(x.as_py(), np.float64) for x in t["d"]]))
        w = weigh(u, n, split - 1, 2, rest)
        rows = []
        for bucket, mine in zip(t["_bucket"].to_pylist(), pairs):
            at = np.searchsorted(u, mine)
            abc = np.stack([w.a[at], w.b[at], w.c[at]]).astype(np.float32)
            rows.append((MESSAGE, bucket, None, None, None, None, pack_sorted(mine), pack(abc.ravel()), np.packbits(w.seen[at], axis=1).tobytes(), None))
        top, at = np.unique(((u >> T.U64(8 * (split - 1))) << T.U64(8)) | (u & T.U64(255)), return_inverse=True)
        rows.append((TOP, 0, None, None, None, None, top.tobytes(), np.bincount(at, n, len(top)).astype(np.float64).tobytes(), w.keys.tobytes(), w.sums.tobytes()))
        return rows_of(fact, rows)

    n_files = max(8, buckets)
    asked = table.groupBy("_block").applyInArrow(ask, message)
    facts = bucketed(asked.groupBy("_bucket", "_part").applyInArrow(gather, fact), ["_bucket"], n_files, "facts")
    totals, left = facts.where(F.col("kind") == PARTIAL), parts
    while left > 1:
        totals, left = totals.groupBy("_bucket", F.floor(F.col("_part") / PART).alias("_up")).applyInArrow(combine, fact), -(-left // PART)
    if parts > 1:
        totals = bucketed(totals, ["_bucket"], n_files, "totals")
    learned = materialise(totals.groupBy("_bucket").applyInArrow(learn, fact), "learned")
    weighed = materialise(learned.where(F.col("kind") == MESSAGE).groupBy("_part").applyInArrow(middle, fact), "middle")
    words = learned.where(F.col("kind") == TOP).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    train_tokens, vocabulary = int(words["n"] or 0), int(words["v"] or 0)
    pairs, tops = np.zeros(65536), np.zeros(65536)
    for r in weighed.where(F.col("kind") == TOP).select("a", "b", "c", "d").toLocalIterator():
        for into, k, x in ((pairs, r["a"], r["b"]), (tops, r["c"], r["d"])):
            np.add.at(into, np.frombuffer(bytes(k), np.uint64).astype(np.int64), np.frombuffer(bytes(x), np.float64))
    every = np.arange(65536).astype(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(Top(every, pairs, every, tops))
    base_total = float(train_tokens + 1 * (vocabulary + 1))

    def settled(t: pa.Table, up: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """A bucket's codes with their log10 probabilities, or words with their counts."""
        partial = t.filter(pc.equal(t["kind"], PARTIAL))
        u, n = tally_of(partial["a"], partial["b"])
        if t["_bucket"][0].as_py() < 0:
            return u, n.astype(np.float64)
        w = weigh(u, n, depth, split)
        pair = np.concatenate([unpack_sorted(x.as_py()) for x in up["a"]])
        abc = np.concatenate([unpack(x.as_py(), np.float32).reshape(3, -1, N_BITS) for x in up["b"]], axis=1)
        seen = np.unpackbits(np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in up["c"]])[:, None], axis=1).astype(bool)
        order = np.argsort(pair)
        at = order[np.searchsorted(pair[order], above(u))]
        for k in range(N_BITS):
            w.c[:, k] = np.where(w.seen[:, k], abc[0, at, k] + abc[1, at, k] * w.c[:, k], abc[2, at, k])
        return u, sent.value.log10(u, w.c, seen[at], depth)

    def replies(t: pa.Table, values: np.ndarray) -> pa.Table:
        entry = t.filter(pc.equal(t["kind"], ENTRY))
        return rows_of(reply, [(t["_bucket"][0].as_py(), block, pack(values[unpack_sorted(a.as_py(), np.int32)], 2)) for block, a in zip(entry["_block"].to_pylist(), entry["a"])])

    def answer(t: pa.Table, up: pa.Table) -> pa.Table:
        return replies(t, settled(t, up)[1])

    def settle(t: pa.Table, up: pa.Table) -> pa.Table:
        u, values = settled(t, up)
        return pa.table({"_bucket": t["_bucket"].slice(0, 1), "keys": pa.array([pack_sorted(u)], pa.binary()), "data": pa.array([pack(values)], pa.binary())})

    def answer_part(t: pa.Table, known: pa.Table) -> pa.Table:
        partial = t.filter(pc.equal(t["kind"], PARTIAL))
        at = np.searchsorted(unpack_sorted(known["keys"][0].as_py()), unpack_sorted(partial["a"][0].as_py()))
        return replies(t, unpack(known["data"][0].as_py(), np.float64)[at])

    up = weighed.where(F.col("kind") == MESSAGE).groupBy("_bucket")
    if parts == 1:
        answers = facts.groupBy("_bucket").cogroup(up).applyInArrow(answer, reply)
    else:
        known = totals.groupBy("_bucket").cogroup(up).applyInArrow(settle, "_bucket int, keys binary, data binary")
        known = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        known = known.join(facts.where(F.col("kind") == PARTIAL).select("_bucket", "_part"), ["_bucket", "_part"], "left_semi")
        answers = facts.groupBy("_bucket", "_part").cogroup(known.groupBy("_bucket", "_part")).applyInArrow(answer_part, reply)

    def finish(t: pa.Table, got: pa.Table) -> pa.Table:
        cu = distinct(codes(low, offs, depth)[0] for _, _, low, offs in lower_slices(t["text"]))
        wu = distinct(tokens(low, offs)[0] for _, _, low, offs in lower_slices(t["text"]))
        logp, count = np.zeros(len(cu)), np.zeros(len(wu))
        data = dict(zip(got["_bucket"].to_pylist(), got["data"]))
        for out, where in ((logp, code_bucket(cu, depth, buckets)), (count, word_bucket(wu, buckets))):
            for g, at in by_bucket(where):
                out[at] = unpack(data[g].as_py(), np.float64, 2)
        base = np.log10((count + 1) / base_total)
        n_tokens, n_known, bases, scores, sizes = [], [], [], [], []
        for _, _, low, offs in lower_slices(t["text"]):
            values, ptr = codes(low, offs, depth)
            some, inverse = np.unique(values, return_inverse=True)
            scores.append(T.segment_sum(logp[np.searchsorted(cu, some)][inverse], ptr))
            sizes.append(np.diff(ptr))
            values, ptr = tokens(low, offs)
            at = np.searchsorted(wu, values)
            bases.append(T.segment_sum(base[at], ptr))
            n_known.append(T.segment_sum((count[at] > 0).astype(float), ptr).astype(np.int64))
            n_tokens.append(np.diff(ptr))
        cat = lambda x, kind: pa.array(np.concatenate(x), kind)
        bits = -np.concatenate(scores) / np.log10(2) / np.concatenate(sizes)
        return pa.table({c: t[c] for c in [*keep, "held_out"]} | {"n_tokens": cat(n_tokens, pa.int64()), "n_known": cat(n_known, pa.int64()), "train_tokens": pa.array(np.full(len(t), train_tokens), pa.int64()), "base_score": cat(bases, pa.float64()), "score": cat(scores, pa.float64()), "bits_per_byte": pa.array(bits)})

    schema = T.schema(table.select(*keep), "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
    return B.with_answers(table, answers, finish, schema)
