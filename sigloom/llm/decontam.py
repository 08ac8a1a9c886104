"""Benchmark decontamination by template canonicalisation.

Words are stripped of surrounding signs and folded to lower case; numbers (in digits or words), units after
a number and names (capitalised words inside a sentence) become typed placeholders,
whose values are the slots. A run of names, or of number words, is one placeholder. A capitalised word that begins a
sentence may be a name or not, so its windows are taken both ways; before a name it may be that name's first part, so that
the whole text is then read a second time with it taken in. Windows of WINDOW template words, at least LITERAL of them no
placeholders, and all windows of the folded words themselves are hash-joined between
documents and benchmark items; a shorter item is one window. Where slots are denser, a window reaches on until it
has its literal words, to RUN words at most; an item that ends before is one window, with two literal words at least. So verbatim
copies are found whatever their slots. Hits
of a document and an item on one diagonal (the same offset between them) are taken
together: the item is in the document if they cover RUN of its words, or `share`
of a shorter item, and if the slots are consistent, that is, each value of the item
stands for one value of the document all along. So questions with other numbers, names
or units are found too, while texts that merely have the same shape are not.

The windows of the benchmark are a table with the words' values and slots; those of the documents
that a bitmap of the benchmark's keys lets pass are another, dealt to groups of documents. The bitmap is made on the executors and has
FILTER_BITS at most, whatever the benchmark's size: it only saves shuffling windows that can't match. Spark hash-joins each
group's distinct keys with the benchmark's windows, so that a template that many documents and many
items have is a row for each group and item, not for each place, and the group's hits are weighed where they meet,
HITS at a time: by documents, a single document's by items.

Defined results: null and empty texts and items match nothing, nor do items
without words; repeated rows of a document or an item each give their rows; of several places
where an item occurs in a document the one that covers most counts, ties going to the one with
most changed slots. Texts and items of any length are taken whole; what the bitmap lets pass of one document meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import textnp as T
from sigloom.session import materialise

WINDOW = 5
LITERAL = 3
RUN = 13
SHARE = 0.8
#: Hits that are weighed at a time, and windows of documents in a group.
HITS, GROUP = 1 << 20, 400_000
#: Bits of the bitmap of the benchmark's keys: 32 for each window, within these bounds.
LEAST_BITS, FILTER_BITS = 1 << 20, 1 << 28
#: Bytes of one row of the bitmap's table.
CHUNK = 1 << 13
#: Common units of measure and money.
UNITS = "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kph hz khz mhz ghz w kw watt watts v volt volts j joule joules n newton newtons pa k c f degree degrees percent dollar dollars cent cents euro euros usd eur gbp".split()

#: Number words. One is left out, which mostly is no number.
SMALL = "two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBER_WORDS = [*SMALL, *"zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen dozen hundred thousand million billion".split(), *TENS, *(f"{t}-{x}" for t in TENS for x in ["one", *SMALL])]

NUMBER, NAME, UNIT = (T.U64(x) for x in (0xA1, 0xA2, 0xA3))
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_INK = ~T.PLAIN
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def fold_case(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case (ASCII, Latin-1 and basic Cyrillic letters) and where a capital begins."""
    low = T.LOWER[buf]
    capital = _UPPER[buf]
    lead = np.r_[0, buf[:-1]] if len(buf) else buf
    latin = (lead == 0xC3) & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
    low = np.where(latin, low + 0x20, low)
    early, late = (lead == 0xD0) & (buf >= 0x90) & (buf <= 0x9F), (lead == 0xD0) & (buf >= 0xA0) & (buf <= 0xAF)
    low = np.where(early, low + 0x20, np.where(late, low - 0x20, low)).astype(np.uint8)
    low[np.flatnonzero(late) - 1] = 0xD1
    capital = capital.copy()
    capital[np.flatnonzero(latin | early | late) - 1] = True
    return low, capital


def _hashes(words: list[str]) -> np.ndarray:
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = T.words(buf, np.asarray([0, len(buf)]))
    return np.unique(T.range_hash(buf, s, e))


UNIT_HASHES, NUMBER_HASHES = _hashes(UNITS), _hashes(NUMBER_WORDS)


@dataclass
class Reading:
    """Texts as template words: row pointers, words with their placeholders, slot values, whether a word is a slot and whether it may be a name that begins a sentence."""

    ptr: np.ndarray
    word: np.ndarray
    value: np.ndarray
    slot: np.ndarray
    opens: np.ndarray
    #: Rows that read otherwise than in the first reading.
    rows: np.ndarray


def read_words(n_rows: int, row: np.ndarray, value: np.ndarray, begins: np.ndarray, digits: np.ndarray, spelt: np.ndarray, unit: np.ndarray, name: np.ndarray, opens: np.ndarray) -> Reading:
    """Runs of names and of number words become one word each, whose value is that of the run."""
    inside = np.zeros(len(row), bool)
    inside[1:] = (row[1:] == row[:-1]) & ~begins[1:] & ((name[1:] & name[:-1]) | (spelt[1:] & spelt[:-1]))
    first = np.flatnonzero(~inside)
    length = np.diff(np.r_[first, len(row)])
    merged = value[first].copy()
    for k in range(1, int(length.max(initial=1))):
        more = np.flatnonzero(length > k)
        merged[more] = T.mix(merged[more] * T.U64(0x9E3779B97F4A7C15) + value[first[more] + k])
    number = (digits | spelt)[first]
    word = np.where(number, NUMBER, np.where(unit[first], UNIT, np.where(name[first], NAME, merged)))
    return Reading(np.searchsorted(row[first], np.arange(n_rows + 1)), word, merged, number | unit[first] | name[first], opens[first], np.ones(n_rows, bool))


def readings(buf: np.ndarray, offs: np.ndarray) -> list[Reading]:
    """The texts as they stand, and, if any has one, with capitalised words that begin a sentence taken into the names after them."""
    n_rows = len(offs) - 1
    s, e, p = T.words(buf, offs)
    if not len(s):
        return []
    ink = _INK[buf]
    at = np.arange(len(buf))
    last = np.maximum.accumulate(np.where(ink, at, -1))
    first = np.minimum.accumulate(np.where(ink, at, len(buf))[::-1])[::-1]
    s2, e2 = first[s], last[e - 1] + 1
    ok = (s2 < e) & (e2 > s)
    # a sentence ends with a word whose trailing signs hold a stop, or with a line
    stop = np.r_[0, np.cumsum((buf == 46) | (buf == 33) | (buf == 63) | (buf == 58) | (buf == 10) | (buf == 34))]
    row = T.owners(p)
    row, s, s2, e2 = row[ok], s[ok], s2[ok], e2[ok]
    if not len(s):
        return []
    begins = np.ones(len(s), bool)
    begins[1:] = (row[1:] != row[:-1]) | (stop[s2[1:]] > stop[e2[:-1]])
    low, capital = fold_case(buf)
    value = T.range_hash(low, s2, e2)
    digits = np.r_[0, np.cumsum(_DIGIT[buf])]
    figure = _DIGIT[buf[s2]] & (2 * (digits[e2] - digits[s2]) >= np.minimum(e2 - s2, 4))
    spelt = np.isin(value, NUMBER_HASHES)
    upper = np.r_[0, np.cumsum(capital)]
    title = capital[s2] & (upper[e2] - upper[s2] == 1) & (e2 - s2 >= np.where(buf[s2] < 0x80, 2, 3)) & ~spelt
    name = title & ~begins
    after = np.zeros(len(s), bool)
    after[1:] = (figure | spelt)[:-1] & (row[1:] == row[:-1])
    unit = after & np.isin(value, UNIT_HASHES)
    opens = title & begins & ~figure & ~unit
    out = [read_words(n_rows, row, value, begins, figure, spelt, unit, name, opens)]
    taken = np.zeros(len(s), bool)
    taken[:-1] = opens[:-1] & name[1:] & (row[1:] == row[:-1])
    if taken.any():
        again = read_words(n_rows, row, value, begins, figure, spelt, unit, name | taken, opens & ~taken)
        again.rows = np.zeros(n_rows, bool)
        again.rows[row[taken]] = True
        out.append(again)
    return out


def all_windows(r: Reading, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows of k words that lie within a row, whole: of items, of which a shorter one than WINDOW is a window.

    Up to WINDOW words: the words themselves, and the templates with enough literal words, names that begin a sentence taken both ways. Beyond: templates
    that have their LITERAL literal words with the last one, or one less after RUN words or as a whole item; of documents, which don't know where an item ends, all with one less.
    """
    size = np.diff(r.ptr)
    n = np.where(r.rows, np.maximum(size - k + 1, 0), 0)
    if whole and k < WINDOW:
        n = np.where(size == k, n, 0)
    at = np.repeat(r.ptr[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    slots, names = np.r_[0, np.cumsum(r.slot)], np.r_[0, np.cumsum(r.opens)]
    count = lambda c, m: c[at + m] - c[at]
    places, keys = ([at], [T.windows(r.value, k)[at]]) if k <= WINDOW else ([], [])
    named = np.where(r.opens, NAME, r.word)
    # a template equal to the words, or to the other template, is left out
    for some, template, opened in ((count(slots, k) > 0, r.word, 0), (count(names, k) > 0, named, 1)):
        literal = k - count(slots, k) - opened * count(names, k)
        if k <= WINDOW:
            some = some & (literal >= min(LITERAL, k))
        else:
            before = k - 1 - count(slots, k - 1) - opened * count(names, k - 1)
            short = (k == RUN) | (np.repeat(size, n) == k) if whole else True
            some = some & (before < LITERAL) & ((literal == LITERAL) | ((literal == LITERAL - 1) & short))
        some = at[some]
        places.append(some)
        keys.append(T.windows(template, k)[some])
    return np.concatenate(places), np.concatenate(keys)


ITEM = "item long, item_id long, length int, k int, pos int, key long, value binary, slot int"
HIT = "doc long, at int, k int, key long, value2 binary, slot2 int"


def packed_windows(at: np.ndarray, k: int, value: np.ndarray, slot: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Values of the k words from each position, and which of them are slots, as bits."""
    every = at[:, None] + np.arange(k)
    values = np.ascontiguousarray(value[every]).reshape(-1)
    offsets = pa.py_buffer((np.arange(len(at) + 1) * 8 * k).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(values.tobytes())]), pa.array(slot[every] @ (1 << np.arange(k)), pa.int32())


def item_windows(benchmark: DataFrame, id_col: str) -> DataFrame:
    """ITEM: every window of every reading (the item's lowest bit) of every item."""
    items = benchmark.select("text", F.col(id_col).cast("long").alias("item_id"), (2 * F.monotonically_increasing_id()).alias("item"))

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                for second, r in enumerate(readings(buf, offs)):
                    size = np.diff(r.ptr)
                    for width in range(1, RUN + 1):
                        at, key = all_windows(r, width, True)
                        if len(at):
                            row = np.searchsorted(r.ptr, at, "right") - 1
                            values, slots = packed_windows(at, width, r.value, r.slot)
                            item, item_id = (batch.column(i).slice(a, b - a).take(pa.array(row)) for i in (2, 1))
                            item = pa.array(item.to_numpy() + second)
                            yield pa.RecordBatch.from_arrays([item, item_id, pa.array(size[row], pa.int32()), pa.array(np.full(len(at), width), pa.int32()), pa.array(at - r.ptr[row], pa.int32()), pa.array(key.view(np.int64)), values, slots], names=["item", "item_id", "length", "k", "pos", "key", "value", "slot"])

    return items.mapInArrow(run, ITEM)


def bit_of(key: np.ndarray, n_bits: int) -> np.ndarray:
    return (T.mix(key.view(np.uint64) ^ T.U64(0x2545F4914F6CDD1D)) % T.U64(n_bits)).astype(np.int64)


def key_bitmap(windows: DataFrame, n: int) -> np.ndarray:
    """A bitmap of the windows' keys, made in chunks on the executors."""
    n_bits = LEAST_BITS
    while n_bits < min(32 * n, FILTER_BITS):
        n_bits *= 2

    def places(batches):
        for batch in batches:
            bits = T.distinct(bit_of(batch.column(0).to_numpy(), n_bits))
            yield pa.RecordBatch.from_arrays([pa.array(bits // (8 * CHUNK), pa.int64()), pa.array(bits % (8 * CHUNK), pa.int64())], names=["chunk", "bit"])

    def fill(t: pa.Table) -> pa.Table:
        bits = np.zeros(8 * CHUNK, bool)
        bits[t["bit"].to_numpy()] = True
        return pa.table({"chunk": t["chunk"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    out = np.zeros((-(-n_bits // (8 * CHUNK)), CHUNK), np.uint8)
    chunks = windows.select("key").mapInArrow(places, "chunk long, bit long").distinct().groupBy("chunk").applyInArrow(fill, "chunk long, bits binary")
    for r in chunks.toLocalIterator():
        out[r["chunk"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def doc_windows(rows: DataFrame, bitmap: np.ndarray, widths: list[int]) -> DataFrame:
    """HIT: the windows of the documents (text, _n) that the bitmap lets pass; doc is twice _n, and one more in the second reading."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = sent.value
        for batch in batches:
            for a, b, buf, offs in T.slices(batch.column(0)):
                ids = 2 * batch.column(1).slice(a, b - a).to_numpy()
                for second, r in enumerate(readings(buf, offs)):
                    for width in widths:
                        at, key = all_windows(r, width, False)
                        bit = bit_of(key, 8 * len(bits))
                        mine = np.flatnonzero(bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
                        if len(mine):
                            at, key = at[mine], key[mine]
                            row = np.searchsorted(r.ptr, at, "right") - 1
                            yield pa.RecordBatch.from_arrays([pa.array(ids[row] + second), pa.array(at - r.ptr[row], pa.int32()), pa.array(np.full(len(at), width), pa.int32()), pa.array(key.view(np.int64)), *packed_windows(at, width, r.value, r.slot)], names=["doc", "at", "k", "key", "value2", "slot2"])

    return rows.select("text", "_n").mapInArrow(run, HIT)


FOUND = "doc long, item long, item_id long, covered int, item_words int, changed_slots int"


class Meeting:
    """A group's windows of documents, by document, and the benchmark's windows of their keys, by key."""

    def __init__(self, docs: pa.Table, items: pa.Table, run: int, share: float):
        self.docs, self.items = docs.take(pa.array(np.argsort(docs["doc"].to_numpy(), kind="stable"))), items.take(pa.array(np.argsort(items["key"].to_numpy(), kind="stable")))
        self.key, self.item = self.items["key"].to_numpy(), self.items["item"].to_numpy()
        self.own_key, self.doc = self.docs["key"].to_numpy(), self.docs["doc"].to_numpy()
        self.run, self.share = run, share
        self.out: list[pa.Table] = []

    def meet(self, d: np.ndarray, i: np.ndarray) -> None:
        """Weighs windows d of the documents against windows i of the items (both in order), in parts of HITS at most."""
        low, high = np.searchsorted(self.key[i], self.own_key[d], "left"), np.searchsorted(self.key[i], self.own_key[d], "right")
        n = high - low
        if n.sum() > HITS:
            docs, items = np.unique(self.doc[d] >> 1), np.unique(self.item[i])
            if len(docs) > 1:
                early = self.doc[d] >> 1 < docs[len(docs) // 2]
                self.meet(d[early], i)
                return self.meet(d[~early], i)
            if len(items) > 1:
                early = self.item[i] < items[len(items) // 2]
                self.meet(d, i[early])
                return self.meet(d, i[~early])
        if n.any():
            at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            self.out.append(weigh(self.docs, self.items, np.repeat(d, n), i[at], self.run, self.share))

    def best(self) -> pa.Table:
        """A row for each document and item, of its readings the one that covers most."""
        t = pa.concat_tables(self.out) if self.out else weigh(self.docs, self.items, np.zeros(0, np.int64), np.zeros(0, np.int64), self.run, self.share)
        doc, item, covered, changed = (t[c].to_numpy() for c in ("doc", "item", "covered", "changed_slots"))
        doc, item = doc >> 1, item >> 1
        order = np.lexsort((-changed, -covered, item, doc))
        first = np.ones(len(order), bool)
        first[1:] = (doc[order][1:] != doc[order][:-1]) | (item[order][1:] != item[order][:-1])
        t = t.take(pa.array(order[first]))
        return t.set_column(0, "doc", pa.array(doc[order[first]])).set_column(1, "item", pa.array(item[order[first]]))


def weigh(docs: pa.Table, items: pa.Table, d: np.ndarray, i: np.ndarray, run: int, share: float) -> pa.Table:
    """FOUND of the hits of windows d of the documents with windows i of the items: a row for each document, item and place that covers enough."""
    of = lambda t, c, at: t[c].to_numpy()[at].astype(np.int64)
    # equal keys of unlike widths are no hits
    same = of(docs, "k", d) == of(items, "k", i)
    d, i = d[same], i[same]
    order = np.lexsort((of(items, "pos", i), of(docs, "at", d) - of(items, "pos", i), of(items, "item", i), of(docs, "doc", d)))
    d, i = d[order], i[order]
    doc, item, pos, k, length = of(docs, "doc", d), of(items, "item", i), of(items, "pos", i), of(items, "k", i), of(items, "length", i)
    diagonal = of(docs, "at", d) - pos
    new = np.ones(len(d), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])
    group = np.cumsum(new) - 1
    # words that a window covers beyond all windows of its diagonal before it
    far = (1 << 32) * group
    reached = np.r_[0, np.maximum.accumulate(far + pos + k)[:-1]] - far if len(d) else far
    gain = np.maximum(pos + k - np.maximum(reached, pos), 0)
    first = np.flatnonzero(new)
    covered = np.add.reduceat(gain, first) if len(first) else gain
    enough = (covered >= run) | (covered >= share * length[first])
    # values of the words that are slots on both sides, by diagonal
    hits = np.flatnonzero(enough[group])
    word = np.repeat(hits, k[hits])
    nth = np.arange(len(word)) - np.repeat(np.cumsum(k[hits]) - k[hits], k[hits])
    values = lambda t, c, at: np.frombuffer(b"".join(t[c].take(pa.array(at[hits])).to_pylist()), np.uint64)
    both = ((of(items, "slot", i) & of(docs, "slot2", d))[word] >> nth & 1).astype(bool)
    pairs = np.unique(np.stack([group[word].astype(np.uint64), values(items, "value", i), values(docs, "value2", d)], axis=1)[both], axis=0)
    which = pairs[:, 0].astype(np.int64)
    twice = which[1:][(which[1:] == which[:-1]) & (pairs[1:, 1] == pairs[:-1, 1])]
    changed = np.bincount(which[pairs[:, 1] != pairs[:, 2]], minlength=len(first))
    enough[twice] = False
    g = np.flatnonzero(enough)
    at = first[g]
    return pa.table({"doc": pa.array(doc[at]), "item": pa.array(item[at]), "item_id": items["item_id"].take(pa.array(i[at])), "covered": pa.array(covered[g], pa.int32()), "item_words": pa.array(length[at], pa.int32()), "changed_slots": pa.array(changed[g], pa.int32())})


def found(rows: DataFrame, benchmark: DataFrame, run: int, share: float, id_col: str) -> DataFrame:
    """The items found in the documents (text, _n, a written table), by _n as `doc`."""
    windows = materialise(item_windows(benchmark, id_col), "items")
    shape = windows.agg(F.count("*").alias("n"), F.collect_set("k").alias("k")).first()
    docs = materialise(doc_windows(rows, key_bitmap(windows, shape["n"]), sorted(shape["k"])), "windows")
    groups = max(64, docs.count() // GROUP)
    docs = docs.withColumn("_g", F.pmod(F.xxhash64(F.shiftright("doc", 1)), F.lit(groups)))
    keys = docs.select(F.col("_g").alias("_h"), F.col("key").alias("_k")).distinct()
    asked = keys.join(windows.hint("shuffle_hash"), F.col("_k") == F.col("key")).drop("_k")

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        m = Meeting(mine, theirs, run, share)
        m.meet(np.arange(len(mine)), np.arange(len(theirs)))
        return m.best()

    return docs.groupBy("_g").cogroup(asked.groupBy("_h")).applyInArrow(meet, FOUND)


def numbered(docs: DataFrame, keep: list[str]) -> DataFrame:
    return materialise(docs.select("text", F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.monotonically_increasing_id().alias("_n")), "numbered")


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, run: int = RUN, share: float = SHARE, id_col: str = "item_id") -> DataFrame:
    """keep columns (doc_id), item_id, covered, item_words, changed_slots: a row for each item found in each document."""
    keep = keep or ["doc_id"]
    rows = numbered(docs, keep)
    out = found(rows, benchmark, run, share, id_col).join(rows.select("_row", F.col("_n").alias("doc")), "doc")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in keep], "item_id", "covered", "item_words", "changed_slots")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN, share: float = SHARE, id_col: str = "item_id") -> DataFrame:
    """The rows of docs in which no benchmark item was found, unchanged."""
    rows = numbered(docs, [c for c in docs.columns if c != "text"])
    bad = found(rows, benchmark, run, share, id_col).select(F.col("doc").alias("_n"))
    left = rows.join(bad, "_n", "left_anti")
    return left.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])
