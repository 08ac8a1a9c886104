"""Nearest neighbours by largest inner product, as a block matrix join of int8 tiles.

Rows are dealt by number into groups: queries into row groups, candidates into column
groups, and each pair of groups meets in one task, to which candidates come in Arrow batches. A vector
x is scale * code + rest, its codes rounded to int8. The product of a tile of query codes
with one of candidate codes is an exact integer matrix (in single precision as far as that
holds all integers), and

    |q.x - sq sx (codes of q . codes of x)| <= |q'| |rest of x| + |rest of q| |x|

with the norms of what was really rounded. A query's limit is its k-th best score so far,
or the k-th largest lower bound of the tile at hand if that is more; pairs whose upper bound is below it
are done. The surviving pairs are computed anew from the original vectors in double precision,
component after component, and pushed on the query's heap of k. A last window over the heaps of all column
groups cuts to k before its shuffle. The bound is strict, so the result is exact: recall is 1.

Of equal vectors only those can be among k nearest that belong to the k + 1 least ids, each at
most k times; the others of a batch leave it before they are dealt out, so a hot vector costs
a query a few pairs a batch and not one for each copy.

Defined results: null vectors, zero vectors and vectors with null or non-finite components take no part,
nor do null ids; shorter vectors count as padded by zeros; a query is never its own candidate, nor is
another row of the same id; repeated rows of a query's id share one ranking, repeated rows of other
ids count as often as they occur; a score beyond a double is infinite; -0 is 0; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.session import materialise

#: Queries that a task holds, and candidates that it streams past them.
QUERY_GROUP, CANDIDATE_GROUP = 8192, 1 << 18
#: Pairs of groups there should be at least, if their sides have LEAST rows then.
PAIRS, LEAST = 24, 512
#: Rows of a tile: queries, candidates.
TILE = (1024, 2048)
#: Numbers of the original vectors that are gathered at a time.
GATHER = 1 << 22


def vectors_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors and the vectors, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs, items = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    bad, ink = np.r_[0, np.cumsum(~np.isfinite(items))], np.r_[0, np.cumsum(items != 0)]
    at = np.flatnonzero(valid & (bad[offs[1:]] == bad[offs[:-1]]) & (ink[offs[1:]] > ink[offs[:-1]]))
    n = np.diff(offs)[at]
    out = np.zeros((len(at), int(n.max(initial=0))))
    col = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(np.arange(len(at)), n), col] = items[np.repeat(offs[:-1][at], n) + col]
    return at, out


def in_ranking(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among k nearest: of equal vectors those of the k + 1 least ids, each id k times at most."""
    _, vector = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((ids, vector))
    v, i = vector[order], ids[order]
    new_vector = np.r_[True, v[1:] != v[:-1]]
    new_id = new_vector | np.r_[True, i[1:] != i[:-1]]
    place = np.arange(len(order))
    distinct = np.cumsum(new_id)
    nth_id = distinct - distinct[np.maximum.accumulate(np.where(new_vector, place, 0))]
    nth_row = place - np.maximum.accumulate(np.where(new_id, place, 0))
    return np.sort(order[(nth_id <= k) & (nth_row < k)])


class Coded:
    """Vectors with their int8 codes, and the norms that bound the error of products of codes."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        top = np.abs(x).max(axis=1, initial=0)
        self.unit = np.maximum(top, np.finfo(np.float64).tiny) / 127
        codes = np.rint(x / self.unit[:, None])
        near = codes * self.unit[:, None]
        self.codes = codes.astype(np.int8)
        self.near, self.rest = self._norm(near), self._norm(x - near)

    @staticmethod
    def _norm(x: np.ndarray) -> np.ndarray:
        top = np.maximum(np.abs(x).max(axis=1, initial=0), np.finfo(np.float64).tiny)
        return np.sqrt(((x / top[:, None]) ** 2).sum(axis=1)) * top * (1 + 1e-12)

    def padded(self, dims: int) -> Coded:
        if dims > self.x.shape[1]:
            self.x = np.pad(self.x, ((0, 0), (0, dims - self.x.shape[1])))
            self.codes = np.pad(self.codes, ((0, 0), (0, dims - self.codes.shape[1])))
        return self


def bounds(q: Coded, a: slice, c: Coded, b: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of a tile."""
    exact = np.float32 if q.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q.codes[a].astype(exact) @ c.codes[b].astype(exact).T).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        middle = product * q.unit[a][:, None] * c.unit[b]
        whole = c.near[b] + c.rest[b]
        error = q.near[a][:, None] * c.rest[b] + q.rest[a][:, None] * whole
        error += 1e-13 * (len(q.codes[0]) + 8) * (q.near[a] + q.rest[a])[:, None] * whole + np.finfo(np.float64).tiny  # of rounding
        low, high = middle - error, middle + error
    low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
    return low, high


def products(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of q with rows j of c, added up from the first component to the last."""
    out, step = np.zeros(len(i)), max(1, GATHER // max(q.shape[1], 1))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(i), step):
            x, y = q[i[at : at + step]], c[j[at : at + step]]
            for d in range(q.shape[1]):
                out[at : at + step] += x[:, d] * y[:, d]
    return np.where(np.isnan(out), -np.inf, out) + 0.0


class Nearest:
    """The k best candidates of each query of a group, in heaps whose top is the worst."""

    def __init__(self, queries: Coded, k: int):
        self.q, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.limit = np.full(len(queries.ids), -np.inf)

    def meet(self, candidates: Coded) -> None:
        dims = max(self.q.x.shape[1], candidates.x.shape[1])
        q, c, k = self.q.padded(dims), candidates.padded(dims), self.k
        for first in range(0, len(q.ids), TILE[0]):
            a = slice(first, first + TILE[0])
            for other in range(0, len(c.ids), TILE[1]):
                b = slice(other, other + TILE[1])
                low, high = bounds(q, a, c, b)
                own = q.ids[a][:, None] == c.ids[b]
                low[own], high[own] = -np.inf, -np.inf
                limit = self.limit[a]
                open_ = np.flatnonzero(limit == -np.inf)
                if len(open_) and low.shape[1] > k:
                    limit = limit.copy()
                    limit[open_] = np.partition(low[open_], low.shape[1] - k, axis=1)[:, low.shape[1] - k]
                i, j = np.nonzero((high >= limit[:, None]) & ~own)
                self.push(i + first, c.ids[j + other], products(q.x, c.x, i + first, j + other))

    def push(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        heaps, k = self.heaps, self.k
        for i, v, s in zip(rows.tolist(), ids.tolist(), scores.tolist()):
            heap = heaps[i]
            if len(heap) < k:
                heapq.heappush(heap, (s, -v))
            elif (s, -v) > heap[0]:
                heapq.heapreplace(heap, (s, -v))
        for i in np.unique(rows).tolist():
            if len(heaps[i]) == k:
                self.limit[i] = heaps[i][0][0]

    def rows(self) -> pa.RecordBatch:
        got = [(i, -v, s) for i, heap in zip(self.q.ids.tolist(), self.heaps) for s, v in heap]
        return pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k nearest of all other rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    is_query = F.col("id") % every == 0

    def able(batches):
        for batch in batches:
            at, x = vectors_of(batch.column(1))
            if len(at):
                at = at[in_ranking(batch.column(0).to_numpy()[at], x, k)]
            yield batch.take(pa.array(at))

    def usable(batches):
        for batch in batches:
            yield batch.take(pa.array(vectors_of(batch.column(1))[0]))

    asked = rows.where(is_query).mapInArrow(usable, rows.schema).withColumn("kind", F.lit(0))
    given = rows.mapInArrow(able, rows.schema).withColumn("kind", F.lit(1))
    both = materialise(asked.unionByName(given), "vectors")
    size = {r["kind"]: r["count"] for r in both.groupBy("kind").count().collect()}
    n_queries, n_candidates = size.get(0, 0), size.get(1, 0)
    down = max(1, -(-n_queries // QUERY_GROUP))
    across = max(1, -(-n_candidates // CANDIDATE_GROUP), min(-(-PAIRS // down), n_candidates // LEAST))

    def seek(batches):
        at, held, found = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                pair, kind = tuple(keys[a, :2].tolist()), keys[a, 2]
                if pair != at:
                    if found is not None:
                        yield found.rows()
                    at, held, found = pair, [], None
                part = batch.slice(a, b - a)
                if kind == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if found is None:
                    t = pa.Table.from_batches(held)
                    found = Nearest(Coded(t["id"].to_numpy(), vectors_of(t["v"])[1]), k)
                found.meet(Coded(part.column(3).to_numpy(), vectors_of(part.column(4))[1]))
        if found is not None:
            yield found.rows()

    # dealt by their place in the written table, so that rows of one id spread like any others
    place = F.xxhash64(F.monotonically_increasing_id())
    placed = both.withColumn("place", place)
    mine = placed.where("kind = 0").withColumn("r", F.pmod("place", F.lit(down)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    theirs = placed.where("kind = 1").withColumn("c", F.pmod("place", F.lit(across)).cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    pairs = mine.unionByName(theirs).select("r", "c", "kind", "id", "v").repartition(max(8, down * across), "r", "c").sortWithinPartitions("r", "c", "kind")
    met = pairs.mapInArrow(seek, "query_id long, vec_id long, score double")
    turn = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
