"""Benchmark decontamination: CGK embedding, repeated sampling, exact edit check.

A document is contaminated by an item if a part of it lies within
``edits(length)`` edits of the item (UTF-8 bytes, ASCII case and the kinds of
white space aside): ``RATE * length``, but 2 for items of 30 and 31 bytes, as
three edits there may leave no shared string of Q bytes.

Windows.  A part within k edits of an item of n bytes shares at least
``n - Q + 1 - k * Q`` of its Q-byte strings with it, at places that differ by k
at most.  So a window is laid wherever enough of an item's strings fall on nearby
diagonals, wide enough for each part that they may belong to; no window that
could match is left out.  Of an item's strings the most frequent may be ignored
if that many more hits are asked of the rest, which changes the work and not the
windows that can match.

Embedding.  A CGK walk reads a string by a random coin a (step, byte): it stays on
a byte or moves to the next, and writes the byte it stands on, so that few edits
become few differing places.  Each item and each item-sized part of a window, at
offsets ``k`` apart, is walked ``WALKS`` times.

Sampling.  A key is the bytes at a few random places of a walk.  A window that
has a key in common with its item is checked at once.  The number of keys follows
from the agreement that simulated pairs of the item's length show at the edit
limit, for replaced, inserted and deleted bytes, so that ``RECALL`` of them share
a key (measured by a test at each length and kind).

The rest.  Windows without a common key are checked if the item has not been
found in that text, in full as the others.  So sampling decides what is
checked first and nothing is lost to it.

The items are written once to the shared folder.  A task reads them from there in
blocks of at most ``BLOCK_BYTES`` (one longer item alone), one after another for
each ``GROUP_BYTES`` of documents, so it holds one block's strings at a time and
what it holds does not grow with either table, but with its longest item.

Defined results: a null text or item is empty; items below ``LEAST`` bytes
name nothing and are not searched; repeated items are reported each, repeated
documents alike; an empty table on either side gives no item for any document;
all columns of the documents are kept and the added one takes an unused name.
"""
from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from barsmith.llm.common import fresh, ragged, written

#: edits allowed as a share of an item's bytes, and the shortest item searched
RATE, LEAST = 0.1, 24
Q = 8
#: hits asked for at least, once frequent strings are ignored
HITS = 8
BLOCK_BYTES, CHUNK = 8 << 20, 1 << 20
#: bytes of documents searched for all blocks at once, where there are several
GROUP_BYTES = 32 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def edits(n: int) -> int:
    """Edits allowed in an item of n bytes: no more than leave a shared string."""
    return min(int(RATE * n), (n - Q) // Q)


#: walks a string; share of pairs at the limit that should have a key in common, and pairs
#: simulated for each kind of edit; places that a key reads, the first number of these
#: for which ``KEYS`` keys do, else the last one with as many keys as it takes
WALKS, RECALL, TRIALS = 2, 0.98, 24
PLACES, KEYS = (4, 3, 2), 900
#: steps of a walk a byte of the item, by when half of all walks have read it; what a walk
#: writes past the end of an item and of a part, which so never agree there
STEPS, PAST = 2, (0, 1)
#: bytes of walks held at once, a single window's aside
WALK_BYTES = 4 << 20


def coins(walk: np.ndarray, step: int, byte: np.ndarray) -> np.ndarray:
    """0 or 1, a hash of (walk, step, byte): no table to hold."""
    x = (walk.astype(np.uint64) << np.uint64(40)) + np.uint64(step << 8) + byte.astype(np.uint64)
    x = (x + np.uint64(1)) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(1)).astype(np.int64)


def walked(raw: np.ndarray, start: np.ndarray, end: np.ndarray, steps: int, past: int) -> np.ndarray:
    """What each walk writes in ``steps`` steps over each ``raw[start:end]``:
    strings x WALKS x steps."""
    at, stop = (np.repeat(x, WALKS) for x in (start, end))
    walk = np.tile(np.arange(WALKS), len(start))
    out = np.zeros((len(at), steps), np.uint8)
    last = max(len(raw) - 1, 0)
    for j in range(steps if len(raw) else 0):
        inside = at < stop
        byte = np.where(inside, raw[np.minimum(at, last)], past)
        out[:, j] = byte
        at = at + (coins(walk, j, byte) & inside)
    return out.reshape(len(start), WALKS, steps)


def size_class(n: int) -> int:
    """Lengths that share their keys: powers of the root of two, rounded up."""
    return math.ceil(2 ** (math.ceil(2 * math.log2(n)) / 2))


@functools.cache
def places(size: int) -> np.ndarray:
    """Places (keys x places a key) of a walk of items of this class: as many keys
    as simulated pairs at the edit limit ask for."""
    rnd = np.random.default_rng(size)
    k, steps = edits(size), STEPS * size
    agree = []
    for kind in range(3):
        pairs = []
        for _ in range(TRIALS):
            x = rnd.integers(97, 123, size)
            where = np.sort(rnd.choice(size, k, replace=False))
            y = x.copy()
            if kind == 0:
                y[where] = rnd.integers(97, 123, k)
            else:
                y = np.insert(x, where, rnd.integers(97, 123, k)) if kind == 1 else np.delete(x, where)
            pairs += [x, y]
        ends = np.cumsum([len(p) for p in pairs])
        raw, starts = np.concatenate(pairs).astype(np.uint8), ends - np.array([len(p) for p in pairs])
        x, y = (walked(raw, starts[i::2], ends[i::2], steps, PAST[i]) for i in (0, 1))
        # a pair needs one walk that agrees; the worst pairs of each kind count
        agree.append(np.quantile((x == y).mean(axis=2).max(axis=1), 0.15))
    p = min(0.9, max(0.05, min(agree)))
    asked = [(math.ceil(math.log(1 - RECALL) / math.log(1 - p ** m)), m) for m in PLACES]
    return rnd.integers(0, steps, next((x for x in asked if x[0] <= KEYS), asked[-1]))


def agreeing(raw: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray, items: "Items") -> np.ndarray:
    """Which windows [start, end) have a part with a key in common with their item."""
    out = np.zeros(len(item), bool)
    classes = items.size_class[item]
    for size in np.unique(classes):
        own = np.flatnonzero(classes == size)
        at = places(int(size))
        # some five parts a window, a walk of STEPS * size bytes each
        group = max(1, min(512, WALK_BYTES // (5 * WALKS * STEPS * int(size))))
        for lo in range(0, len(own), group):
            w = own[lo:lo + group]
            n, k = items.size[item[w]], items.k[item[w]]
            # item-sized parts of the window, so near each other that one starts within k / 2 of a match
            apart = np.maximum(1, k)
            count = np.maximum(0, end[w] - start[w] - n + k) // apart + 1
            of = np.repeat(np.arange(len(w)), count)
            first = start[w][of] + ragged(np.zeros(len(w), np.int64), count) * apart[of]
            made = walked(raw, first, np.minimum(first + n[of] + k[of], end[w][of]), STEPS * int(size), PAST[1])
            held = np.stack([items.walk(int(i), int(size)) for i in item[w]])
            same = made[:, :, at.reshape(-1)] == held[of][:, :, at.reshape(-1)]
            hit = same.reshape(len(of), WALKS, *at.shape).all(axis=3).any(axis=(1, 2))
            out[w[of[hit]]] = True
    return out


def distance(pattern: bytes, text: bytes) -> int:
    """Least edit distance of ``pattern`` to any part of ``text``; each column
    of the table is held as bits of two numbers."""
    n = len(pattern)
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, n
    for c in text:
        eq = at.get(c, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | x
        right, left = down | ~(d | up) & full, up & d
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = right << 1 & full, left << 1 & full
        up, down = left | ~(d | right) & full, right & d
        best = min(best, score)
    return best


class Items:
    """The strings of a block of items."""

    def __init__(self, items: list[bytes]):
        self.items, self.learnt, self.walks = items, False, {}
        self.size = np.array([len(x) for x in items], np.int64)
        self.size_class = np.array([size_class(len(x)) for x in items], np.int64)
        self.k = np.array([edits(len(x)) for x in items], np.int64)
        self.need = self.size - Q + 1 - self.k * Q
        raw = np.frombuffer(b"".join(items), np.uint8)
        starts = np.cumsum(self.size) - self.size
        n = self.size - Q + 1
        self.of = np.repeat(np.arange(len(items)), n)
        self.off = ragged(np.zeros(len(items), np.int64), n)
        self.gram = grams(raw)[ragged(starts, n)]
        order = np.argsort(self.gram, kind="stable")
        self.of, self.off, self.gram = self.of[order], self.off[order], self.gram[order]
        self.least = self.need.copy()
        self.index(np.ones(len(self.gram), bool))

    def walk(self, i: int, size: int) -> np.ndarray:
        """The walks of an item, made when it first comes up."""
        if i not in self.walks:
            raw = np.frombuffer(self.items[i], np.uint8)
            self.walks[i] = walked(raw, np.array([0]), np.array([len(raw)]), STEPS * size, PAST[0])[0]
        return self.walks[i]

    def index(self, used: np.ndarray) -> None:
        self.g, first, count = np.unique(self.gram[used], return_index=True, return_counts=True)
        self.first, self.count = first, count
        self.u_of, self.u_off = self.of[used], self.off[used]
        self.bits = np.uint64(64 - max(10, int(len(self.g) * 16).bit_length()))
        self.table = np.zeros(1 << int(64 - self.bits), bool)
        self.table[(self.g * MIX) >> self.bits] = True

    def ignore_frequent(self, seen: np.ndarray) -> None:
        """``seen``: the strings of some text.  Each item forgets its most
        frequent strings and asks for as many hits less."""
        at = np.searchsorted(seen, self.gram, side="right") - np.searchsorted(seen, self.gram)
        order = np.lexsort((self.off, -at, self.of))
        place = np.empty(len(order), np.int64)
        per = np.bincount(self.of, minlength=len(self.items))
        place[order] = ragged(np.zeros(len(per), np.int64), per)
        drop = np.maximum(self.need - HITS, 0)
        self.least = np.maximum(self.need - drop, 1)
        self.index(place >= drop[self.of])

    def windows(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, end) of the windows of this piece of text."""
        g = grams(text)
        hit = np.flatnonzero(self.table[(g * MIX) >> self.bits])
        at = np.minimum(np.searchsorted(self.g, g[hit]), len(self.g) - 1)
        same = self.g[at] == g[hit]
        hit, at = hit[same], at[same]
        n = self.count[at]
        place = ragged(self.first[at], n)
        item, diag = self.u_of[place], np.repeat(hit, n) - self.u_off[place]
        # hits of one match lie on 2k + 1 diagonals: in one cell or two adjacent ones
        width = 2 * self.k[item] + 1
        cells = len(text) + int(self.size.max()) + 2
        key = item * cells + (diag + int(self.size.max())) // width
        order = np.argsort(key, kind="stable")
        key, item = key[order], item[order]
        cell, first, count = np.unique(key, return_index=True, return_counts=True)
        after = np.append(np.where(cell[1:] == cell[:-1] + 1, count[1:], 0), 0)[:len(cell)]
        enough = np.flatnonzero(count + after >= self.least[item[first]])
        # a match's start lies k above the least of its diagonals and below the greatest, of
        # which those without hits may lie before the two cells
        item, cell = item[first[enough]], cell[enough]
        k, width = self.k[item], 2 * self.k[item] + 1
        start = (cell - item * cells) * width - int(self.size.max())
        return item, start - k - 1, start + 2 * width + self.size[item]


def grams(raw: np.ndarray) -> np.ndarray:
    """Each Q-byte string as a number."""
    if len(raw) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(raw) - Q + 1,), "<u8", np.ascontiguousarray(raw).data, 0, (1,)).astype(np.uint64)


def searched(batch: pa.RecordBatch, column: int, items: Items) -> Iterator[tuple[int, int]]:
    """(row, item) of the items found in a batch."""
    overlap = 2 * int((items.size + 2 * items.k).max()) + Q
    col = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    whole = col.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]].translate(FOLD) if len(col) and col.buffers()[2] else b""
    offsets = offsets - offsets[0]
    raw = np.frombuffer(whole, np.uint8)
    pairs: set[tuple[int, int]] = set()
    for lo in range(0, len(raw), CHUNK):
        piece = raw[lo:lo + CHUNK + overlap]
        if not items.learnt:
            items.ignore_frequent(np.sort(grams(piece)))
            items.learnt = True
        item, start, end = items.windows(piece)
        start, end = np.maximum(0, start + lo), np.minimum(len(raw), end + lo)
        # a window may hang over the border of its text: one for each text it touches
        d0, d1 = np.searchsorted(offsets, start, side="right") - 1, np.searchsorted(offsets, end)
        which = np.repeat(np.arange(len(item)), np.maximum(0, d1 - d0))
        doc = ragged(d0, np.maximum(0, d1 - d0))
        item, start, end = item[which], np.maximum(offsets[doc], start[which]), np.minimum(offsets[doc + 1], end[which])
        fits = end - start >= items.size[item] - items.k[item]
        doc, item, start, end = (x[fits] for x in (doc, item, start, end))
        # those with a key in common first, then the rest
        first = agreeing(raw, item, start, end, items)
        order = np.argsort(~first, kind="stable")
        for d, i, a, b in zip(*(x[order].tolist() for x in (doc, item, start, end))):
            if (d, i) not in pairs and distance(items.items[i], whole[a:b]) <= items.k[i]:
                pairs.add((d, i))
    yield from pairs


def blocks(files: list[str]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(ids, texts) of the written items, in runs of at most BLOCK_BYTES."""
    ids, texts, total = [], [], 0
    for file in files:
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=256, columns=["id", "text"]):
                for i, t in zip(*(c.to_pylist() for c in batch.columns)):
                    raw = t.encode().translate(FOLD)
                    if texts and total + len(raw) > BLOCK_BYTES:
                        yield ids, texts
                        ids, texts, total = [], [], 0
                    ids.append(i)
                    texts.append(raw)
                    total += len(raw)
    if texts:
        yield ids, texts


def grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def tagged(batches: Iterator[pa.RecordBatch], column: int, name: str, files: list[str], kind: pa.DataType | None = None) -> Iterator[pa.RecordBatch]:
    """The batches with the ids of the items found in each text."""
    first = blocks(files)
    next(first, None)
    several, only = next(first, None) is not None, None
    first.close()
    for group in grouped(batches, GROUP_BYTES if several else 0):
        hits: list[list[list[int | None]]] = [[[] for _ in range(len(b))] for b in group]
        for ids, items in (only,) if only else ((ids, Items(texts)) for ids, texts in blocks(files)):
            for own, batch in zip(hits, group):
                for d, i in searched(batch, column, items):
                    own[d].append(ids[i])
            if not several:
                only = ids, items
        for own, batch in zip(hits, group):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(kind or pa.int64()))], names=[*batch.schema.names, name])


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", name: str = "items") -> DataFrame:
    """``docs`` with the ids of the items found in each text, sorted."""
    held = written(items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where(F.octet_length("text") >= LEAST), "items")
    files = sorted(held.inputFiles())
    column, name = docs.columns.index(text), fresh(docs, name)
    own = items.schema[item_id].dataType  # an id keeps its type
    kind = to_arrow_type(own)
    out = docs.mapInArrow(lambda b: tagged(b, column, name, files, kind), T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(own))]))
    return out.withColumn(name, F.sort_array(name))


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with their columns."""
    name = fresh(docs, "items")
    return contaminated(docs, items, text, name=name).where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.size("items").cast("long").alias("n_items"), F.array_join(F.col("items").cast("array<string>"), ",", "null").alias("items"),
                        (F.size("items") > 0).alias("contaminated"))
