"""MinHash near-duplicate detection with odd sketches.

A document's set holds its distinct SHINGLE-word shingles (its whole word sequence
if shorter). Documents are linked whose sets have a Jaccard similarity of `percent`
hundredths or more.

1. Sets of equal hash are one class, named by a hash of that; copies never become pairs.
2. MinHash: BANDS * ROWS samples per class. A band hashes ROWS samples; two sets at
   the limit of 0.8 share none of 32 bands of 4 with probability 5e-8.
3. Odd sketch: the samples are folded into a parity bitmap, bit h(i, sample_i) flipped for
   each i. The population count of two sketches' XOR estimates their similarity,
   most precisely where it is high. Bands that hold two classes or more compare their
   members' sketches in bit-parallel blocks and keep a spanning forest of the pairs
   whose count is under a limit set Z standard deviations beyond the expected count
   at the threshold.
4. Components of these forests are candidate groups. Only for their members are the full
   sets built again from the texts; each group compares all its pairs exactly, as
   bitmaps over the shingles that two or more members have, and keeps a
   spanning forest of the true links. Its components are the result.

Bands and groups of more than HOT members, or PART_BYTES of shingles, are hot. All their members are
first compared with PIVOTS representatives, in tasks of about HOT members. Representatives that
share a linked member are of one component; what is linked to the largest such component
needs no link within it. Only what is not is compared with all members of its group, in
pairs of parts. Groups so take work in proportion to their size where their members
are alike, no task holds more than two parts, and no link is lost; rows of pairs never leave
a task, only forests do.

Defined results: null and empty texts have the empty set, 0 shingles and are linked with
nothing; the component is the least doc_id reachable, so for repeated rows of a doc_id
all those with the same set are kept; rows without doc_id have component null unless
linked with rows that have one, and are not kept. Links are between sets, not between
rows of one doc_id or of none.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm import blocks as B
from sigloom.llm import textnp as T
from sigloom.llm.components import components
from sigloom.session import bucketed, materialise

SHINGLE = 4
BANDS, ROWS = 32, 4
SKETCH_BITS = 1024
HOT = 256
PART_BYTES = 16 << 20
PIVOTS = 4
Z = 5.5
NO_ID = (1 << 63) - 1


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pointers and the sorted distinct shingle hashes of each row."""
    low = T.LOWER[buf]
    s, e, p = T.words(low, offs)
    h = T.range_hash(low, s, e)
    grams = T.windows(h, k)
    out, ptr = [], [0]
    for d in range(len(offs) - 1):
        a, b = p[d], p[d + 1]
        if b - a >= k:
            g = T.distinct(grams[a : b - k + 1])
        elif b > a:
            g = T.windows(h[a:b], b - a)
        else:
            g = np.zeros(0, np.uint64)
        out.append(g)
        ptr.append(ptr[-1] + len(g))
    return np.asarray(ptr), np.concatenate(out) if out else np.zeros(0, np.uint64)


_RNG = np.random.default_rng(2014)
_MULT = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * T.U64(2) + T.U64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def signatures(ptr: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """MinHash samples of each row; rows with empty sets get zeros."""
    n = len(ptr) - 1
    out = np.zeros((n, len(_MULT)), np.uint64)
    full = np.flatnonzero(ptr[1:] > ptr[:-1])
    if len(full):
        for i in range(len(_MULT)):
            x = sets * _MULT[i]
            x += _ADD[i]
            x ^= x >> T.U64(31)
            x *= T.U64(0x9E3779B97F4A7C15)
            out[full, i] = np.minimum.reduceat(x, ptr[:-1][full])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows of SKETCH_BITS / 64 words)."""
    n, k = samples.shape
    bit = (T.mix(samples ^ (np.arange(k).astype(np.uint64) * T.U64(0xC2B2AE3D27D4EB4F))) % T.U64(SKETCH_BITS)).astype(np.int64)
    odd = np.zeros((n, SKETCH_BITS), np.uint8)
    np.add.at(odd, (np.repeat(np.arange(n), k), bit.ravel()), 1)
    return np.packbits(odd & 1, axis=1).view(np.uint64)


def expected_count(similarity: float, k: int = BANDS * ROWS) -> float:
    """Expected population count of the XOR of two sketches."""
    return SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * k * (1 - similarity)))


def count_limit(similarity: float, k: int = BANDS * ROWS) -> int:
    """Counts up to this are candidates: the count expected Z standard deviations of the sample below the threshold, and as many of the folding beyond."""
    low = max(0.0, similarity - Z * np.sqrt(similarity * (1 - similarity) / k))
    return int(np.ceil(expected_count(low, k)))


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def close_pairs(bits: np.ndarray, test, forest: Forest, left: np.ndarray, right: np.ndarray, step: int = 512) -> None:
    """Joins members i of left and j of right for which test(distances of the block i.., j..) holds."""
    for a in range(0, len(left), step):
        i = left[a : a + step]
        for b in range(0, len(right), step):
            j = right[b : b + step]
            rows, cols = np.nonzero(test(bits, i, j))
            if not len(rows):
                continue
            x, y = i[rows], j[cols]
            roots = np.asarray([forest.find(m) for m in range(len(forest.up))])
            for u, v in zip(x[roots[x] != roots[y]].tolist(), y[roots[x] != roots[y]].tolist()):
                forest.join(u, v)


def xor_counts(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros((len(i), len(j)), np.int32)
    for w in range(bits.shape[1]):
        out += np.bitwise_count(bits[i, w][:, None] ^ bits[j, w][None, :])
    return out


def and_counts(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros((len(i), len(j)), np.int32)
    for w in range(bits.shape[1]):
        out += np.bitwise_count(bits[i, w][:, None] & bits[j, w][None, :])
    return out


def star(ids: np.ndarray, forest: Forest) -> list[tuple[int, int]]:
    """Edges from each member to the least id of its tree."""
    roots = np.asarray([forest.find(m) for m in range(len(ids))])
    least: dict[int, int] = {}
    for r, i in zip(roots.tolist(), ids.tolist()):
        least[r] = min(i, least.get(r, i))
    return [(least[r], i) for r, i in zip(roots.tolist(), ids.tolist()) if least[r] != i]


EDGE = "a long, b long"


def edges_table(pairs: list[tuple[int, int]]) -> pa.Table:
    pairs = list(dict.fromkeys(pairs))
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def runs(*keys: np.ndarray):
    """(first, end) of each run of equal keys in sorted order."""
    n = len(keys[0])
    if not n:
        return
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    yield from zip(at.tolist(), np.r_[at[1:], n].tolist())


def row_key() -> list[Column]:
    """By which the text of a class is found again: doc_id, NO_ID for null, and a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_text")]


def set_hashes(ptr: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    n = np.diff(ptr)
    total = lambda x: np.where(n > 0, np.add.reduceat(np.r_[x, T.U64(0)], np.minimum(ptr[:-1], len(x))), T.U64(0))
    return T.mix(total(sets) + n.astype(np.uint64)), total(T.mix(sets ^ T.U64(0x3C6EF372FE94F82B)))


def features(docs: DataFrame, keep: list[str], shingle: int) -> DataFrame:
    """keep columns, _id, text hash, n_shingles, set hash (s1, s2), bands and sketch of every row."""
    kept = docs.select("text", *keep, *row_key())

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                ptr, sets = shingle_sets(buf, offs, shingle)
                n = np.diff(ptr)
                s1, s2 = set_hashes(ptr, sets)
                samples = signatures(ptr, sets)
                bands = T.windows(samples.ravel(), ROWS)[::ROWS].reshape(len(n), BANDS) if len(n) else np.zeros((0, BANDS), np.uint64)
                bands = T.mix(bands ^ (np.arange(BANDS).astype(np.uint64) * T.U64(0xFF51AFD7ED558CCD)))
                sketch = odd_sketch(samples)
                cols = [c.slice(a, b - a) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array([r.tobytes() for r in bands], pa.binary()), pa.array([r.tobytes() for r in sketch], pa.binary())], names=[*keep, "_id", "_text", "n_shingles", "s1", "s2", "bands", "sketch"])

    schema = T.schema(kept, "n_shingles long, s1 long, s2 long, bands binary, sketch binary", 1)
    return kept.mapInArrow(run, schema)


def answer_counts(messages: DataFrame) -> DataFrame:
    """To each block the keys it sent that were sent twice or more, with the number of senders' items."""

    def run(table: pa.Table) -> pa.Table:
        parts = B.unpack(table["data"], 1)
        keys = np.concatenate(parts).ravel()
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        n = counts[inverse]
        owner = np.repeat(table["_block"].to_numpy(), [len(p) for p in parts])
        again = n >= 2
        owner, keys, n = owner[again], keys[again], n[again]
        order = np.lexsort((keys, owner))
        owner, keys, n = owner[order], keys[order], n[order]
        blocks, out = [], []
        for a, b in runs(owner):
            blocks.append(int(owner[a]))
            k, first = np.unique(keys[a:b], return_index=True)
            out.append(np.stack([k, n[a:b][first].astype(np.uint64)], axis=1).tobytes())
        return pa.table({"_block": pa.array(blocks, pa.int64()), "data": pa.array(out, pa.binary())})

    return messages.groupBy("_bucket").applyInArrow(run, B.ANSWER)


#: A member of a key (a band or a candidate group): node and what it is compared by; n members and bytes in all.
MEMBER = "key long, node long, item binary, n long, bytes long"


def parts_of(n: Column, size: Column) -> Column:
    return F.greatest(F.ceil(n / HOT), F.ceil(size / PART_BYTES)).cast("int")


def spread(node: Column, parts: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(seed)), parts).cast("int")


def group_edges(members: DataFrame, forest_of, to_one, groups: int, name: str) -> DataFrame:
    """A forest over the linked members of each key. members: MEMBER, a written table.

    forest_of(items, left, right) links the members at positions left with those at right;
    to_one(item, items) tells which items are linked to item.
    """
    parts = parts_of(F.col("n"), F.col("bytes"))

    def within(t: pa.Table) -> pa.Table:
        key, node = t["key"].to_numpy(), t["node"].to_numpy()
        order, out = np.lexsort((node, key)), []
        key, node, items = key[order], node[order], t["item"].take(pa.array(order)).to_pylist()
        for a, b in runs(key):
            every = np.arange(b - a)
            if b - a > 1:
                out += star(node[a:b], forest_of(items[a:b], every, every))
        return edges_table(out)

    cold = members.where(parts <= 1).withColumn("_g", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(groups))).groupBy("_g").applyInArrow(within, EDGE)
    edges = [materialise(cold, name)]
    hot = members.where(parts > 1).select("key", "node", "item", parts.alias("parts"))
    if hot.isEmpty():
        return edges[0]

    def compare(t: pa.Table, one: pa.Table) -> pa.Table:
        """Which representatives each member is linked to: their nodes, and as bits."""
        items = t["item"].to_pylist()
        nodes = one["node"].to_numpy()
        order = np.argsort(nodes)
        linked = np.stack([to_one(one["item"][int(i)].as_py(), items) for i in order], axis=1) if items and len(one) else np.zeros((len(items), 0), bool)
        return pa.table({"key": t["key"], "node": t["node"], "mask": pa.array(linked @ (1 << np.arange(linked.shape[1])), pa.int32()), "to": pa.array([nodes[order[x]].tolist() for x in linked], pa.list_(pa.int64()))})

    def largest(t: pa.Table) -> pa.Table:
        """Of a group's sets of representatives, with the number of members linked to just these, the component of most members."""
        masks, n = t["mask"].to_pylist(), dict(zip(t["mask"].to_pylist(), t["n"].to_pylist()))
        whole: list[int] = []
        for m in filter(None, masks):
            for x in [x for x in whole if x & m]:
                whole.remove(x)
                m |= x
            whole.append(m)
        best = max(whole, key=lambda m: (sum(c for x, c in n.items() if x & m), -m), default=0)
        return pa.table({"key": t["key"].slice(0, 1), "main": pa.array([best], pa.int32())})

    first = Window.partitionBy("key").orderBy("node")
    one = hot.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= PIVOTS).drop("_n")
    one = one.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    salted = hot.withColumn("part", spread(F.col("node"), F.col("parts"), 1))
    seen = materialise(salted.groupBy("key", "part").cogroup(one.groupBy("key", "part")).applyInArrow(compare, "key long, node long, mask int, to array<long>"), name)
    edges.append(seen.select(F.explode("to").alias("a"), F.col("node").alias("b")))
    main = seen.groupBy("key", "mask").agg(F.count("*").alias("n")).groupBy("key").applyInArrow(largest, "key long, main int")
    apart = seen.join(main, "key").where(F.col("mask").bitwiseAND(F.col("main")) == 0).select("key", "node")
    left = materialise(hot.join(apart, ["key", "node"], "left_semi"), name)
    if not left.isEmpty():
        size = left.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("item")).alias("bytes")).select("key", parts_of(F.col("n"), F.col("bytes")).alias("left_parts"))
        u = spread(F.col("node"), F.col("left_parts"), 1)
        mine = left.join(size, "key").select("key", "node", "item", u.alias("u"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("v"), F.lit(True).alias("left"))
        v = spread(F.col("node"), F.col("parts"), 1)
        others = hot.join(size, "key").select("key", "node", "item", F.explode(F.sequence(F.lit(0), F.col("left_parts") - 1)).alias("u"), v.alias("v"), F.lit(False).alias("left"))

        def across(t: pa.Table) -> pa.Table:
            mine = t["left"].to_numpy(zero_copy_only=False)
            nodes, at = np.unique(t["node"].to_numpy(), return_inverse=True)
            first = np.zeros(len(nodes), np.int64)
            first[at] = np.arange(len(at))
            forest = forest_of(t["item"].take(pa.array(first)).to_pylist(), np.unique(at[mine]), np.unique(at[~mine]))
            return edges_table(star(nodes, forest))

        edges.append(materialise(mine.unionByName(others).groupBy("key", "u", "v").applyInArrow(across, EDGE), name))
    return reduce(DataFrame.unionByName, edges)


def sketch_forest(limit: int):
    def forest_of(items: list[bytes], left: np.ndarray, right: np.ndarray) -> Forest:
        bits, forest = np.frombuffer(b"".join(items), np.uint64).reshape(len(items), -1), Forest(len(items))
        close_pairs(bits, lambda x, i, j: xor_counts(x, i, j) <= limit, forest, left, right)
        return forest

    def to_one(item: bytes, items: list[bytes]) -> np.ndarray:
        bits = np.frombuffer(b"".join(items), np.uint64).reshape(len(items), -1)
        return np.bitwise_count(bits ^ np.frombuffer(item, np.uint64)).sum(axis=1) <= limit

    return forest_of, to_one


def set_forest(percent: int):
    def forest_of(items: list[bytes], left: np.ndarray, right: np.ndarray) -> Forest:
        """Links by intersections of bitmaps over the shingles that two or more members have."""
        own = [np.frombuffer(x, np.uint64) for x in items]
        size = np.asarray([len(x) for x in own])
        _, inverse, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        shared = counts >= 2
        place = np.cumsum(shared) - 1
        bits = np.zeros((len(own), -(-int(shared.sum()) // 64) or 1), np.uint64)
        row = np.repeat(np.arange(len(own)), size)
        ok = shared[inverse]
        p = place[inverse[ok]]
        np.bitwise_or.at(bits, (row[ok], p // 64), T.U64(1) << (p % 64).astype(np.uint64))

        def linked(x, i, j):
            inter = and_counts(x, i, j).astype(np.int64)
            return (100 * inter >= percent * (size[i][:, None] + size[j][None, :] - inter)) & (inter > 0)

        forest = Forest(len(own))
        close_pairs(bits, linked, forest, left, right)
        return forest

    def to_one(item: bytes, items: list[bytes]) -> np.ndarray:
        one, own = np.frombuffer(item, np.uint64), [np.frombuffer(x, np.uint64) for x in items]
        size, every = np.asarray([len(x) for x in own]), np.concatenate(own)
        hit = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
        inter = np.bincount(np.repeat(np.arange(len(own)), size), hit, len(own))
        return 100 * inter >= percent * (size + len(one) - inter)

    return forest_of, to_one


def candidate_edges(classes: DataFrame, n_classes: int, limit: int) -> DataFrame:
    """A forest over the classes whose sketches are near each other within a band."""
    n_blocks = max(4, -(-n_classes // 4096))
    n_buckets = max(4, -(-n_classes * BANDS // 262_144))
    blocked = classes.select(F.pmod(F.xxhash64("_class", F.lit(9)), F.lit(n_blocks)).alias("_block"), "_class", "bands", "sketch")
    table = bucketed(blocked.repartition(n_blocks, "_block"), ["_block"], n_blocks, "sketches")

    def ask(t: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(t["bands"].to_pylist()), np.uint64)
        return pa.Table.from_batches(list(B.packed(B.bucket_of(keys, n_buckets), n_buckets, t["_block"][0].as_py(), keys)))

    def members(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(answers) or not len(t):
            i, keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            known = np.concatenate(B.unpack(answers["data"], 2))
            known = known[np.argsort(known[:, 0])]
            keys = np.frombuffer(b"".join(t["bands"].to_pylist()), np.uint64)
            at = np.minimum(np.searchsorted(known[:, 0], keys), len(known) - 1)
            k = np.flatnonzero(known[at, 0] == keys)
            i, keys, n = k // BANDS, keys[k].view(np.int64), known[at[k], 1].astype(np.int64)
        size = SKETCH_BITS // 8
        return pa.table({"key": pa.array(keys, pa.int64()), "node": t["_class"].take(pa.array(i)), "item": t["sketch"].take(pa.array(i)), "n": pa.array(n, pa.int64()), "bytes": pa.array(n * size, pa.int64())})

    answers = answer_counts(table.select("_block", "bands").groupBy("_block").applyInArrow(ask, B.MESSAGE))
    met = materialise(table.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(members, MEMBER), "members")
    return group_edges(met, *sketch_forest(limit), max(64, n_classes // 1024), "candidates")


def exact_edges(docs: DataFrame, members: DataFrame, shingle: int, percent: int, groups: int) -> DataFrame:
    """A forest over the true links of each candidate group. members: _class, _id, _text, label, s1, s2, n, bytes."""
    texts = docs.select("text", *row_key()).join(members.hint("merge"), ["_id", "_text"]).select("text", "label", "_class", "n", "bytes", "s1", "s2")

    def sets(batches):
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                ptr, hashes = shingle_sets(buf, offs, shingle)
                part = batch.slice(a, b - a)
                # a text of the same row key but another set is left out
                own = np.stack(set_hashes(ptr, hashes)) == np.stack([part.column(i).to_numpy() for i in (5, 6)]).view(np.uint64)
                at = pa.array(np.flatnonzero(own.all(axis=0)))
                items = pa.array([hashes[x:y].tobytes() for x, y in zip(ptr, ptr[1:])], pa.binary())
                cols = [part.column(1), part.column(2), items, part.column(3), part.column(4)]
                yield pa.RecordBatch.from_arrays([c.take(at) for c in cols], names=["key", "node", "item", "n", "bytes"])

    once = texts.mapInArrow(sets, MEMBER).dropDuplicates(["key", "node"])
    return group_edges(materialise(once, "sets"), *set_forest(percent), groups, "links")


def group(docs: DataFrame, keep: list[str], shingle: int = SHINGLE, percent: int = 80) -> DataFrame:
    """keep columns, n_shingles, component_id, kept for every row of docs (which has doc_id and text)."""
    feats = materialise(features(docs, [c for c in keep if c != "doc_id"] + ["doc_id"], shingle), "minhash")
    one = feats.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(F.struct("_id", "_text", "bands", "sketch")).alias("m"), F.min("n_shingles").alias("n_shingles"))
    classes = materialise(one.select(F.xxhash64("s1", "s2").alias("_class"), "s1", "s2", "n_shingles", "m._id", "m._text", "m.bands", "m.sketch"), "classes")
    n = classes.count()
    loose = components(candidate_edges(classes, n, count_limit(percent / 100))).withColumnRenamed("node", "_class")
    loose = materialise(loose.join(classes.select("_class", "_id", "_text", "s1", "s2", "n_shingles"), "_class"), "loose")
    sizes = loose.groupBy("label").agg(F.count("*").alias("n"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    members = materialise(loose.drop("n_shingles").join(sizes, "label"), "members")
    # cold groups share tasks of about PART_BYTES
    size = sizes.where(parts_of(F.col("n"), F.col("bytes")) <= 1).agg(F.sum("bytes").alias("s")).first()["s"] or 0
    final = components(exact_edges(docs, members, shingle, percent, max(64, n // 1024, size // PART_BYTES))).withColumnRenamed("node", "_class")
    least = final.join(classes.select("_class", "_id"), "_class").groupBy("label").agg(F.min("_id").alias("least"))
    known = materialise(classes.select("_class", "_id", "s1", "s2").join(final.join(least, "label").select("_class", "least"), "_class", "left").select("s1", "s2", F.coalesce("least", "_id").alias("component")), "components")
    out = feats.drop("bands", "sketch").join(known, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("_id"))
    out = out.withColumn("component_id", F.when(component != NO_ID, component))
    return out.select(*keep, "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
