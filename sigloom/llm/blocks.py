"""Blocks of documents that look up corpus-wide facts.

A table of texts is written once to the shared folder in blocks of about BLOCK bytes of
neighbouring rows, bucketed by block, so that a block is read again without a shuffle of
texts. A block asks about keys (hashes of phrases, windows, words) by
sending each bucket of the key space one packed array of its distinct keys; the
bucket's group counts what all blocks sent and answers each block with one packed
array. However often a key occurs, a block sends it once (twice where it occurs
twice or more and only that matters), so hot keys never meet in one task as
rows, and answers return to the block by a co-group. Blocks have a bounded size, buckets
grow from LEAST_BUCKET to MOST_BUCKET bytes of text with the table, then in number alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import textnp as T
from sigloom.session import bucketed

BLOCK = 8 << 20
LEAST_BUCKET, MOST_BUCKET = 4 << 20, 64 << 20


def write_blocks(docs: DataFrame, keep: list[str], name: str, block_bytes: int = BLOCK) -> tuple[DataFrame, int, int]:
    """(text, keep..., _block) as a written table, and the numbers of key buckets and (about) of blocks for its size."""
    kept = docs.select("text", *keep)
    total = kept.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0

    def run(batches):
        first, seq, size = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batches:
            for a, b, buf, _ in T.slices(batch.column(0)):
                if size and size + len(buf) > block_bytes:
                    seq, size = seq + 1, 0
                size += len(buf)
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns], pa.array(np.full(b - a, first + seq), pa.int64())], names=["text", *keep, "_block"])

    blocks = max(4, -(-total // block_bytes))
    table = bucketed(kept.mapInArrow(run, T.schema(kept, "_block long")), ["_block"], blocks, name)
    return table, max(4, -(-total // min(MOST_BUCKET, max(LEAST_BUCKET, total >> 14)))), blocks


def packed(buckets: np.ndarray, n: int, block: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One message per bucket: rows (bucket, block, data) with the arrays' items side by side, 8 bytes each."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    data = np.stack([a[order].view(np.int64) for a in arrays], axis=1)
    at = np.searchsorted(buckets[order], np.arange(n + 1))
    full = np.flatnonzero(np.diff(at))
    yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.full(len(full), block), pa.int64()), pa.array([data[at[g] : at[g + 1]].tobytes() for g in full], pa.binary())], names=["_bucket", "_block", "data"])


MESSAGE = "_bucket int, _block long, data binary"
ANSWER = "_block long, data binary"


def unpack(column, width: int) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64).reshape(-1, width) for x in column]


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (T.mix(keys ^ T.U64(0x5851F42D4C957F2D)) % T.U64(n)).astype(np.int64)


def equal_rows(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal rows of items together, and where in it a new row begins."""
    order = np.lexsort(items.T) if items.shape[1] > 1 else np.argsort(items[:, 0], kind="stable")
    x = items[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]).any(axis=1)
    return order, new


def answer_repeated(messages: DataFrame, width: int) -> DataFrame:
    """To each block, once, the items it sent that were sent twice or more, by whomever."""

    def run(table: pa.Table) -> pa.Table:
        parts = unpack(table["data"], width)
        items = np.concatenate(parts)
        owner = np.repeat(table["_block"].to_numpy(), [len(p) for p in parts])
        order, new = equal_rows(items)
        group = np.cumsum(new) - 1
        again = np.bincount(group)[group] >= 2 if len(group) else new
        order, group = order[again], group[again]
        owner = owner[order]
        place = np.lexsort((group, owner))
        order, group, owner = order[place], group[place], owner[place]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (group[1:] != group[:-1])
        items, owner = items[order[fresh]], owner[fresh]
        at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        out = [items[a:b].tobytes() for a, b in zip(at, np.r_[at[1:], len(owner)])]
        return pa.table({"_block": pa.array(owner[at], pa.int64()), "data": pa.array(out, pa.binary())})

    return messages.groupBy("_bucket").applyInArrow(run, ANSWER)


def at_most_twice(items: np.ndarray) -> np.ndarray:
    """Each distinct row of items, twice if it occurs more than once."""
    order, new = equal_rows(items)
    third = np.zeros(len(order), bool)
    third[2:] = ~new[2:] & ~new[1:-1]
    return items[order[~third]]


def with_answers(table: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """run(texts of a block, its answers) for every block."""
    return table.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(run, schema)
