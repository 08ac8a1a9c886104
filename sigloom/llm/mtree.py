"""Exact top-k inner products by best-first search in M-trees.

Vectors are quantised to integers, floor(scale * x). Largest inner product becomes
nearest neighbour in a metric space by one more coordinate, sqrt(M^2 - |y|^2) with M
the largest norm of a tree: |q' - y'|^2 = |q|^2 + M^2 - 2 <q, y>, whose right side is
an integer. Rows are dealt by hash into trees of about TREE vectors. A tree's
nodes are pages of entries; an internal entry has a routing object, a covering
radius and the distance to its parent's routing object, a leaf entry has the vector
and that distance. The search keeps a heap of pages by their least possible
distance. An entry whose |d(q, parent) - d(entry, parent)| - radius exceeds the
distance of the k-th best so far is passed over before its own distance is
computed (the triangle inequality on stored distances); scores are integers and
bounds have a margin for rounding, so the result is exact, ties going to the
smaller id. Where integers are too large for doubles to add up exactly, the tree's bounds
get a wider margin and whatever may be among the best is scored in Python integers.

Queries travel in blocks; each pair of a tree and a block is one row of work, and
the best k of each pair meet in a window that cuts to k before its shuffle.

Rows are dealt by their place in a written copy of the table, so that rows of one id
spread over trees and blocks like any others.

Defined results: null vectors, vectors with null or non-finite components (a component that
scaling takes beyond a double included) and null ids take no part; shorter
vectors count as padded by zeros; a query is never its own candidate, nor is another
row of the same id; repeated rows of other ids count as often as they occur, repeated rows of a
query's id share one ranking; scores beyond a long rank by their true value and are
reported as the nearest long; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.session import materialise

TREE = 4096
PAGE = 256
FAN = 6
BLOCK = 256


def quantise(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors and their integers, as doubles that hold them exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs, items = column.offsets.to_numpy().astype(np.int64), column.values
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offs), 0)
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.floor(scale * items.to_numpy(zero_copy_only=False).astype(np.float64))
    bad = np.r_[0, np.cumsum(~np.isfinite(y))]
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (bad[offs[1:]] == bad[offs[:-1]]))
    n = size[rows]
    out = np.zeros((len(rows), int(n.max(initial=0))))
    r = np.repeat(np.arange(len(rows)), n)
    c = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[r, c] = y[np.repeat(offs[:-1][rows], n) + c]
    return rows, out


def small(x: np.ndarray) -> np.ndarray:
    """In the least type that holds the integers."""
    for kind in (np.int8, np.int16, np.int32):
        if not x.size or np.abs(x).max() <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


@dataclass
class Node:
    """A page. Leaves have rows, internal pages have children; near is each entry's distance to this page's routing object."""

    pivot: int
    radius: float
    near: np.ndarray
    rows: np.ndarray | None
    children: list | None
    first: int = 0
    end: int = 0
    radii: np.ndarray | None = None


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        top = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.unit = 2.0 ** -max(0, int(np.frexp(top)[1]) - 256)  # keeps squares of the largest components finite
        self.ids, self.x, self.peak = ids[order], vectors[order].astype(np.float64) * self.unit, top * self.unit
        self.norm2 = (self.x * self.x).sum(axis=1)
        self.top2 = float(self.norm2.max()) if len(ids) else 0.0
        self.last = np.sqrt(np.maximum(self.top2 - self.norm2, 0))
        self.root = self._build(np.arange(len(ids)), 0) if len(ids) else None
        self._settle()

    def _settle(self) -> None:
        """Lays the vectors out in the order of the leaves, so that a page is one slice."""
        leaves, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node.children is None:
                leaves.append(node)
            else:
                stack += node.children
        if not leaves:
            return
        order = np.concatenate([n.rows for n in leaves])
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.ids, self.x, self.norm2, self.last = self.ids[order], np.ascontiguousarray(self.x[order]), self.norm2[order], self.last[order]
        stack = [self.root]
        while stack:
            node = stack.pop()
            node.pivot = int(place[node.pivot])
            stack += node.children or []
        at = 0
        for n in leaves:
            n.first, n.end = at, at + len(n.rows)
            n.rows, at = None, n.end

    def _distance(self, a: int, rows: np.ndarray) -> np.ndarray:
        d2 = self.norm2[a] + self.norm2[rows] - 2 * (self.x[rows] @ self.x[a]) + (self.last[rows] - self.last[a]) ** 2
        return np.sqrt(np.maximum(d2, 0))

    def _build(self, rows: np.ndarray, pivot: int, near: np.ndarray | None = None) -> Node:
        if near is None:
            pivot = int(rows[0])
            near = self._distance(pivot, rows)
        radius = float(near.max())
        if len(rows) <= PAGE:
            return Node(pivot, radius, near, rows, None)
        # routing objects: rows evenly spaced by id that differ from those before
        pivots, owner, best = [pivot], np.zeros(len(rows), np.int64), near.copy()
        spaced = rows[np.linspace(0, len(rows) - 1, FAN + 1).astype(np.int64)[1:]]
        for p in spaced.tolist() if best.max() > 0 else []:
            d = self._distance(p, rows)
            closer = d < best
            if closer.any():
                owner[closer], best[closer] = len(pivots), d[closer]
                pivots.append(p)
        if len(pivots) == 1 and best.max() > 0:
            p = int(rows[int(best.argmax())])
            d = self._distance(p, rows)
            closer = d < best
            owner[closer], best[closer] = 1, d[closer]
            pivots.append(p)
        if len(pivots) == 1:  # one point over and over: cut by position
            parts = [(pivot, part, near[:0]) for part in np.array_split(np.arange(len(rows)), -(-len(rows) // PAGE))]
        else:
            parts = [(p, np.flatnonzero(owner == k), None) for k, p in enumerate(pivots)]
        children, dist = [], []
        for p, part, _ in parts:
            if len(part):
                children.append(self._build(rows[part], p, best[part] if len(pivots) > 1 else near[part]))
                dist.append(float(self._distance(pivot, np.asarray([p]))[0]))
        return Node(pivot, radius, np.asarray(dist), None, children, radii=np.asarray([c.radius for c in children]))

    def packed(self) -> bytes:
        """Without the vectors' width: whole numbers in their least type."""
        x, self.x = self.x, small(self.x) if self.unit == 1 else self.x
        out = pickle.dumps(self)
        self.x = x
        return out

    @staticmethod
    def unpacked(data: bytes) -> MTree:
        tree = pickle.loads(data)
        tree.x = tree.x.astype(np.float64)
        return tree

    def exact(self, q: np.ndarray) -> bool:
        """Whether inner products with q are exact in doubles."""
        top = max(self.peak, float(np.abs(q).max(initial=0)))
        return self.unit == 1 and top * top * max(self.x.shape[1], len(q), 1) * 4 < 2**53

    def search(self, qid: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), best first."""
        if self.root is None:
            return []
        dims = max(self.x.shape[1], len(q))
        x = self.x if self.x.shape[1] == dims else np.pad(self.x, ((0, 0), (0, dims - self.x.shape[1])))
        q = np.pad(q.astype(np.float64), (0, dims - len(q)))
        exact = self.exact(q)
        whole = [int(v) for v in q] if not exact else []
        q = q * 2.0 ** -max(0, int(np.frexp(np.abs(q).max(initial=0))[1]) - 256)
        base = float(q @ q) + self.top2
        # of a double's rounding in distances, and in scores where these aren't exact
        margin = 1e-6 * np.sqrt(base + 1) * (1 if exact else np.sqrt(dims + 1))
        slack = 0.0 if exact else 1e-14 * (dims + 1) * base
        best: list[tuple[int, int, float]] = []
        limit, floor = np.inf, -np.inf
        to = lambda rows: np.sqrt(np.maximum(base - 2 * (x[rows] @ q), 0))
        d0 = float(to(np.asarray([self.root.pivot]))[0])
        heap = [(max(d0 - self.root.radius, 0.0), 0, d0, self.root)]
        n = 0
        while heap:
            bound, _, d, node = heapq.heappop(heap)
            if bound > limit + margin:
                break
            if node.children is None:
                open_ = np.abs(node.near - d) <= limit + margin
                n_open = np.count_nonzero(open_)
                if not n_open:
                    continue
                if 4 * n_open < len(open_):
                    rows = node.first + np.flatnonzero(open_)
                    s = x[rows] @ q
                else:
                    rows = np.arange(node.first, node.end)
                    s = x[node.first : node.end] @ q
                ok = self.ids[rows] != qid
                if len(best) == k:
                    ok &= s >= floor - slack
                rows, s = rows[ok], s[ok]
                if len(rows) > 4 * k:
                    ok = s >= np.partition(s, len(s) - k)[len(s) - k] - 2 * slack
                    rows, s = rows[ok], s[ok]
                if not len(rows):
                    continue
                ids = self.ids[rows].tolist()
                scores = map(int, s) if exact else (sum(a * int(v) for a, v in zip(whole, y)) for y in (x[rows] / self.unit))
                best = sorted([*best, *zip(scores, ids, s.tolist())], key=lambda b: (-b[0], b[1]))[:k]
                if len(best) == k:
                    floor = min(b[2] for b in best) - slack
                    limit = float(np.sqrt(max(base - 2 * floor, 0)))
                continue
            radii = node.radii
            live = np.flatnonzero(np.abs(d - node.near) - radii <= limit + margin)
            if len(live):
                far = to(np.asarray([node.children[i].pivot for i in live]))
                for i, e in zip(live, far):
                    low = max(float(e) - radii[i], bound, 0.0)
                    if low <= limit + margin:
                        n += 1
                        heapq.heappush(heap, (low, n, float(e), node.children[i]))
        return [b[:2] for b in best]


#: Pairs of a tree and a group of blocks there should be at least, so that all cores have work.
PAIRS = 64


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k best among all other rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = materialise(rows, "vectors").withColumn("at", F.xxhash64(F.monotonically_increasing_id()))
    is_query = F.col("vec_id") % every == 0
    n = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    trees, blocks = max(1, -(-n["n"] // TREE)), max(1, -(-n["q"] // BLOCK))
    groups = min(blocks, max(-(-blocks // 64), -(-PAIRS // trees)))

    def pack(table: pa.Table) -> pa.Table:
        at, x = quantise(table["v"], scale)
        ids = table["vec_id"].to_numpy()[at]
        return pa.table({"key": table["key"].slice(0, 1), "blob": pa.array([pickle.dumps((ids, small(x)))], pa.binary())})

    def plant(table: pa.Table) -> pa.Table:
        at, x = quantise(table["v"], scale)
        return pa.table({"key": table["key"].slice(0, 1), "blob": pa.array([MTree(table["vec_id"].to_numpy()[at], x).packed()], pa.binary())})

    def blobs(df: DataFrame, make, parts: int) -> DataFrame:
        return df.withColumn("key", F.pmod("at", F.lit(parts)).cast("int")).groupBy("key").applyInArrow(make, "key int, blob binary")

    def seek(batches):
        for batch in batches:
            for t, b in zip(batch.column(0), batch.column(1)):
                tree, (qids, qs) = MTree.unpacked(t.as_py()), pickle.loads(b.as_py())
                got = [(i, v, s) for i, q in zip(qids.tolist(), qs) for s, v in tree.search(i, q, k)]
                got = [(i, v, s, max(-(1 << 63), min((1 << 63) - 1, s)), str(s) if abs(s) >= 1 << 63 else None) for i, v, s in got]
                yield pa.RecordBatch.from_arrays([pa.array([g[j] for g in got], pa.int64()) for j in (0, 1, 3)] + [pa.array([g[4] for g in got], pa.string())], names=["query_id", "vec_id", "score", "beyond"])

    # both sides are dealt by number, which keeps small rows of heavy work apart
    deal = lambda df: df.repartition(max(8, trees * groups), "tree", "g")
    forest = blobs(rows, plant, trees).select(F.col("key").alias("tree"), F.col("blob").alias("forest"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    asked = blobs(rows.where(is_query), pack, blocks).select(F.col("blob").alias("block"), F.pmod(F.col("key"), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    found = deal(forest).hint("merge").join(deal(asked), ["tree", "g"]).select("forest", "block").mapInArrow(seek, "query_id long, vec_id long, score long, beyond string")
    # scores beyond a long, by sign, number of digits and digits
    size = F.coalesce(F.length("beyond"), F.lit(0))
    far = F.when(F.col("score") < 0, -size).otherwise(size)
    digits = F.when(F.col("score") < 0, F.translate("beyond", "0123456789", "9876543210")).otherwise(F.col("beyond"))
    turn = Window.partitionBy("query_id").orderBy(far.desc(), digits.desc(), F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
