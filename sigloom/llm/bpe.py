"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut in halves down to leaves. A leaf is matched by the pre-token
pattern; two neighbours are joined by matching a window over their boundary anew:
the left part gives up the pieces that the pattern decided within LOOK characters
of its end, and the window grows to the right until one of its pieces ends where
a piece of the right part ends, at least LOOK characters before the window's end.
From there on both parts' pieces stand, because the pattern looks only forward and
no further than LOOK characters past a piece.

A piece's bytes are encoded the same way one level below: halves down to LEAF
bytes are merged by rank, and neighbours are joined by re-encoding the last and
first k tokens around the boundary, k growing fourfold until the tokens next to the
window are compatible with it. Two tokens are compatible if their joined bytes
encode to just these two; a sequence is the encoding of its bytes exactly if all
its neighbours are compatible, so nothing outside the window can change any more.

Decoding concatenates bytes up the same tree. Defined results: null and empty texts
have no tokens; texts of any length take a stack of logarithmic depth.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sigloom.llm import textnp

#: The furthest the pre-token pattern looks past the end of a match, with room to spare.
LOOK = 3
TEXT_LEAF = 1024
LEAF = 192
#: Bytes from which a window is merged by a heap.
LONG = 256
#: Pieces remembered in each of two generations; the older goes when the newer is full.
MEMO = 250_000


class Codec:
    """An encoder for one vocabulary file (token in base64 and rank per line) and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.find = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # pieces to tokens

    def merge(self, data: bytes) -> list[int]:
        """Merge by rank, lowest first and leftmost among equals."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > LONG:
            return self.merge_long(data)
        get = ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        far = 1 << 30
        scores = [get(parts[i] + parts[i + 1], far) for i in range(len(parts) - 1)]
        while scores:
            low = min(scores)
            if low == far:
                break
            i = scores.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], far)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], far)
        return [ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same by a heap, for windows that have grown: their time is near to linear."""
        get, n = self.ranks.get, len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or get(parts[i] + parts[j]) != low:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(parts[k] + parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        return [self.ranks[p] for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        k = 1
        while True:
            i, j = max(len(left) - k, 0), min(k, len(right))
            window = self.merge(b"".join([self.tokens[t] for t in left[i:]] + [self.tokens[t] for t in right[:j]]))
            if (i == 0 or self.compatible(left[i - 1], window[0])) and (j == len(right) or self.compatible(window[-1], right[j])):
                return left[:i] + window + right[j:]
            k *= 4

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    # texts to pieces

    def pieces(self, text: str) -> list[str]:
        if len(text) <= TEXT_LEAF:
            return self.find(text)
        half = len(text) // 2
        return self.join_pieces(self.pieces(text[:half]), self.pieces(text[half:]))

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        given, i = 0, len(left)
        while i and given < LOOK + 1:
            i -= 1
            given += len(left[i])
        # the piece before position i ends more than LOOK characters before the left part's end
        tail = "".join(left[i:])
        j = min(4, len(right))
        while True:
            text = tail + "".join(right[:j])
            found = self.find(text)
            if j == len(right):
                last = len(text)
            else:
                last = len(text) - LOOK - 1
            ends, at = {}, len(tail)
            for n in range(j):
                at += len(right[n])
                ends[at] = n + 1
            at = 0
            for n, p in enumerate(found):
                at += len(p)
                if at > last:
                    break
                if at in ends:
                    return left[:i] + found[: n + 1] + right[ends[at] :]
            if j == len(right):
                return left[:i] + found
            j = min(2 * j, len(right))

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo, out = self.memo, []
        for p in self.pieces(text):
            ids = memo.get(p)
            if ids is None:
                ids = self.older.get(p)
                if ids is None:
                    ids = np.asarray(self.piece(p.encode()), "<u4").tobytes()
                if len(p) <= 64:
                    if len(memo) >= MEMO:
                        self.older, self.memo = memo, {}
                        memo = self.memo
                    memo[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= 4 * TEXT_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The worker's codec for a vocabulary; by default the public 50k byte-level one."""
    if path is None or pattern is None:
        import public_tokenizers as P

        path, pattern = path or P.path("byte_bpe_50k.tiktoken"), pattern or P.PATTERN
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, keep: list[str], path: str | None = None, pattern: str | None = None, ids: bool = False) -> DataFrame:
    """keep columns, n_tokens, ids_sha256, decoded_sha256, decoded text; with ids also the ids themselves."""
    kept = docs.select("text", *keep)
    extra = ", token_ids array<int>, decoded string" if ids else ""

    def run(batches):
        c = codec(path, pattern)
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                n, a, b, lists, texts = [], [], [], [], []
                for text in batch.column(0).to_pylist():
                    packed = c.packed(text or "")
                    tokens = np.frombuffer(packed, "<u4")
                    back = c.decode(tokens.tolist())
                    n.append(len(tokens))
                    a.append(hashlib.sha256(packed).hexdigest())
                    b.append(hashlib.sha256(back).hexdigest())
                    if ids:
                        lists.append(tokens.astype(np.int32))
                        texts.append(None if text is None else back.decode("utf-8", "replace"))
                cols = [*batch.columns[1:], pa.array(n, pa.int64()), pa.array(a), pa.array(b)]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols += [pa.array(lists, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                    names += ["token_ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = textnp.schema(kept, "n_tokens long, ids_sha256 string, decoded_sha256 string" + extra, 1)
    return kept.mapInArrow(run, schema)
