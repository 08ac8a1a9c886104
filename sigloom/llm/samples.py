"""Bounded labelled samples for the classifiers that are fitted on the driver.

A classifier may be fitted on a bounded sample; the bound is a parameter of
each operator. Rows are taken in the order of a hash of doc_id, so the sample
does not depend on how the tables are laid out, and only as many as hold SAMPLE_BYTES
of text together (a first one always), so that the driver's memory is bounded too.
Exact repeats of a row count once in a sample. Scores are computed for every row, with whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sigloom.llm import textnp as T

#: Bytes of text of a sample.
SAMPLE_BYTES = 256 << 20

#: (buf, offs) -> row pointers, feature ids, weights
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def fold(column, modulus: int = 5, remainder: int = 0):
    """True where crc32 of doc_id as text leaves the remainder. A null doc_id counts as held out."""
    return F.coalesce(F.crc32(column.cast("string")) % modulus == remainder, F.lit(True))


def order_key(column):
    return F.xxhash64(column.cast("string"), F.lit(20))


def labelled_ids(labels: DataFrame, label: str, bound: int, extra=None) -> DataFrame:
    """At most bound rows (doc_id, label) of the training folds. Of repeated doc_ids the largest label counts; null labels don't."""
    rows = labels.select(F.col("doc_id"), F.col(label).cast("double").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~fold(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    if extra is not None:
        rows = rows.where(extra)
    return rows.orderBy(order_key(F.col("doc_id")), "doc_id").limit(bound)


def sample(docs: DataFrame, ids: DataFrame, keep: list[str], per: int, by: str | None = None, total: int = SAMPLE_BYTES) -> DataFrame:
    """text and keep columns of at most per distinct rows (of each value of `by`) of docs that join ids, in the order of doc_id's hash, within total bytes of text.

    ids has a stated bound, so it is broadcast. A partition's keys are cut to per before they
    are shuffled; the running sum of bytes is over at most per keys (of each value of by).
    """
    on = [c for c in ids.columns if c in docs.columns]
    rows = docs.join(F.broadcast(ids), on).withColumn("_t", F.xxhash64("text"))
    group = [by] if by else []
    order = ["_k", "doc_id", "_t"]
    keys = rows.select("doc_id", "_t", *group, order_key(F.col("doc_id")).alias("_k"), F.octet_length("text").alias("_size"))

    def cut(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            t = t.group_by(t.column_names).aggregate([]).sort_by([(c, "ascending") for c in [*group, *order]])
            if group and len(t):
                code = t[by].combine_chunks().dictionary_encode().indices.to_numpy()
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                place = np.arange(len(code)) - np.repeat(first, np.diff(np.r_[first, len(code)]))
                held = t.filter(pa.array(place < per))
            else:
                held = t.slice(0, per)
        if held is not None:
            yield from held.to_batches()

    keys = keys.mapInArrow(cut, keys.schema).distinct()
    least = lambda df, parts: df.withColumn("_n", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).where(F.col("_n") <= per).drop("_n")
    turn = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order)
    keys = least(keys, group or [F.lit(0)]).withColumn("_sum", F.sum(F.coalesce("_size", F.lit(0)) + 1).over(turn)).withColumn("_first", F.row_number().over(turn) == 1)
    chosen = keys.where(F.col("_first") | (F.col("_sum") <= total)).select("doc_id", "_t", *group)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("doc_id", "_t", *group)]
    match = same[0]
    for more in same[1:]:
        match = match & more
    found = rows.alias("r").join(F.broadcast(chosen).alias("c"), match).select(*[F.col(f"r.{c}").alias(c) for c in dict.fromkeys(["text", "_t", "doc_id", *keep])])
    once = Window.partitionBy("doc_id", "_t", *group).orderBy("_t")
    return found.withColumn("_n", F.row_number().over(once)).where("_n = 1").select(*dict.fromkeys(["text", *keep, "doc_id", "_t"]))


def collect_bags(rows: DataFrame, features: Features, keep: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, list]]:
    """Sparse features of a sample's rows: row pointers, ids, weights and the kept columns.

    Features are computed on the executors; what comes to the driver is bounded as
    the sample's text is.
    """
    columns, keep = keep, [*keep, "_t"]
    kept = rows.select("text", *keep)

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                ptr, ids, w = features(buf, offs)
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays([lists(ids.astype(np.int32), pa.int32()), lists(w.astype(np.float32), pa.float32()), *[batch.column(1 + i).slice(a, b - a) for i in range(len(keep))]], names=["ids", "w", *keep])

    schema = StructType([*StructType.fromDDL("ids array<int>, w array<float>").fields, *kept.schema.fields[1:]])
    got = kept.mapInArrow(run, schema).orderBy(order_key(F.col("doc_id")), "doc_id", "_t").toArrow()
    ids, w = got["ids"].combine_chunks(), got["w"].combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids, w = (pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in (ids, w))
    ptr = np.r_[0, np.cumsum(np.asarray([len(x) for x in ids], np.int64))].astype(np.int64) if len(ids) else np.zeros(1, np.int64)
    return ptr, ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), w.flatten().to_numpy(zero_copy_only=False).astype(np.float64), {k: got[k].to_pylist() for k in columns}


def map_scores(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], dict[str, pa.Array]], inputs: list[str], fields: str, with_text: bool = False) -> DataFrame:
    """docs' rows with score columns: mapInArrow over (text, *inputs); rows keep their place, nothing is shuffled. with_text: the text comes first."""

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                out = score(buf, offs, batch.slice(a, b - a))
                cols = ({"text": batch.column(0).slice(a, b - a)} if with_text else {}) | {inputs[i]: batch.column(1 + i).slice(a, b - a) for i in range(len(inputs))} | out
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    kept = docs.select("text", *inputs)
    return kept.mapInArrow(run, T.schema(kept, fields, 0 if with_text else 1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def gather_batch(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of the given rows, and their new row pointers."""
    n = np.diff(ptr)[rows]
    new = np.r_[0, np.cumsum(n)]
    at = np.arange(new[-1]) - np.repeat(new[:-1], n) + np.repeat(ptr[:-1][rows], n)
    return at, new
