"""Exact repeated passages across documents, by enhanced suffix arrays.

A byte is removed if a ``LEAST``-byte string that covers it also starts in a
document of smaller id; strings are judged on the input.  Texts are UTF-8 bytes
and matches never cross documents.

Dealing out.  Each LEAST-byte window has an anchor: of its ``GRAM``-byte strings
the one of least hash, the leftmost of equals.  Equal windows have equal
anchors, so repeats can be looked for anchor by anchor.  Consecutive windows of
one anchor form a stretch of at most 2 * LEAST - GRAM bytes.

1. Texts are packed into chunks, which are written once.
2. Each chunk sends its distinct anchor hashes, dealt out by hash; one bit
   comes back for each: whether another document has it.
3. Each chunk sends its distinct stretches of such anchors, dealt out alike,
   with the least and the greatest document of each.
4. A bucket's distinct stretches are suffix-sorted, the array of common
   prefixes is scanned with a stack, and the intervals of at least LEAST bytes
   whose occurrences differ in the byte to the left (or lie at a stretch's
   start) are the maximal repeat groups, each with all its occurrences.  Where
   a group's least document is below another's, the passage goes back.
5. Each chunk removes the passages from the documents above the group's least.

A hash, stretch or passage crosses once a chunk, however often the chunk's
documents have it, so a hot passage costs a bucket one entry a chunk.

Defined results: a null text is empty; a null id counts as above all others;
rows of equal id do not remove each other's bytes; repeated rows are answered
each; a text below LEAST bytes keeps everything; an empty table gives an empty
table.  Only the id and the text are read, so other columns cannot clash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import pieces, ragged, written

LEAST, GRAM = 50, 24
WIDTH = LEAST - GRAM + 1
#: bytes of text in a chunk, positions worked on at once, chunk bytes a bucket
CHUNK, BLOCK, BUCKET = 2 << 20, 1 << 17, 8 << 20
#: stands for a null id
LAST = np.iinfo(np.int64).max
C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
CHUNKS = "chunk long, ids array<long>, sizes array<int>, blob binary"


def packed(data: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes())


def unpacked(data: bytes, kind: str | None = None):
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return raw if kind is None else np.frombuffer(raw, kind)


def to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> chunks, named by partition and place."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [(t or "").encode() for t in batch.column(1).to_pylist()]
        for lo, hi in pieces([len(t) for t in texts], CHUNK):
            sizes = [len(t) for t in texts[lo:hi]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n]), pa.array([ids[lo:hi]], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([packed(b"".join(texts[lo:hi]))], pa.binary())], names=["chunk", "ids", "sizes", "blob"])
            n += 1


def words(raw: np.ndarray) -> np.ndarray:
    """The number in the eight bytes from each place."""
    return np.ndarray((len(raw) - 7,), "<u8", raw.data, 0, (1,))


def gram_hash(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place."""
    w = words(raw)
    n = len(raw) - GRAM + 1
    h = w[:n] * C[0]
    for k in range(1, GRAM // 8):
        h ^= h >> np.uint64(29)
        h += w[8 * k:8 * k + n]
        h *= C[k]
    h ^= h >> np.uint64(32)
    return h


class Chunk:
    """Stretches of a chunk: start, windows, document and anchor hash of each."""

    def __init__(self, sizes: list[int], blob: bytes):
        self.raw = np.frombuffer(unpacked(blob), np.uint8)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        n = len(self.raw) - LEAST + 1
        anchor = np.zeros(max(n, 0), np.uint32)
        for lo in range(0, n, BLOCK):
            part = np.ascontiguousarray(self.raw[lo:lo + BLOCK + LEAST - 1])
            h = gram_hash(part)
            # hash above, place below: the least is the leftmost of least hash
            m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
            wide = 1
            while wide * 2 <= WIDTH:
                m = np.minimum(m[:-wide], m[wide:])
                wide *= 2
            if wide < WIDTH:
                m = np.minimum(m[:len(m) - (WIDTH - wide)], m[WIDTH - wide:])
            anchor[lo:lo + len(m)] = (m & np.uint64(0xFFFFFFFF)).astype(np.uint32) + np.uint32(lo)
        # windows that lie in one document
        count = np.maximum(self.sizes - LEAST + 1, 0)
        at = ragged(self.starts, count)
        doc = np.repeat(np.arange(len(sizes)), count)
        a = anchor[at]
        new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (doc[1:] != doc[:-1]))) if len(a) else np.zeros(0, np.int64)
        self.start, self.doc = at[new], doc[new]
        self.count = np.diff(np.append(new, len(a)))
        where = a[new].astype(np.int64)
        self.key = np.zeros(len(new), np.uint64)
        for lo in range(0, len(where), BLOCK):  # the hashes again, at the anchors only
            p = where[lo:lo + BLOCK]
            h = None
            for k in range(GRAM // 8):
                w = words(self.raw)[p + 8 * k]
                h = w * C[0] if h is None else ((h ^ (h >> np.uint64(29))) + w) * C[k]
            self.key[lo:lo + BLOCK] = h ^ (h >> np.uint64(32))

    def keys(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchor hashes, sorted, and whether documents of
        different order have each."""
        keys, back = np.unique(self.key, return_inverse=True)
        low, high = np.full(len(keys), LAST), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, back, order[self.doc])
        np.maximum.at(high, back, order[self.doc])
        self.back = back
        return keys, low != high

    def stretches(self, chosen: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Number of the distinct stretch of each chosen run (-1: not chosen),
        and these stretches."""
        number, seen = np.full(len(self.start), -1), {}
        data = self.raw.tobytes()
        runs = np.flatnonzero(chosen)
        ends = (self.start[runs] + self.count[runs] + LEAST - 1).tolist()
        number[runs] = [seen.setdefault(data[s:e], len(seen)) for s, e in zip(self.start[runs].tolist(), ends)]
        return number, list(seen)


def order_of(ids: list[int | None]) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], np.int64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def send_keys(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            chunk = Chunk(row["sizes"], row["blob"])
            keys, several = chunk.keys(order_of(row["ids"]))
            dealt = bucket_of(keys, buckets)
            by = np.argsort(dealt, kind="stable")
            used, first = np.unique(dealt[by], return_index=True)
            rows = [(int(b), row["chunk"], keys[part].tobytes(), np.packbits(several[part]).tobytes())
                    for b, part in zip(used, np.split(by, first[1:]))]
            yield table(rows, ["bucket", "chunk", "keys", "several"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])


def answer_keys(group: pa.Table) -> pa.Table:
    """Which keys of each chunk another document has; a bit for each."""
    keys = [np.frombuffer(k.as_py(), np.uint64) for k in group.column("keys")]
    flags = [np.unpackbits(np.frombuffer(s.as_py(), np.uint8))[:len(k)].astype(bool) for s, k in zip(group.column("several"), keys)]
    every = np.concatenate(keys)
    order = np.argsort(every)
    s = every[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[order] = np.append(same, False) | np.append(False, same)
    twice |= np.concatenate(flags)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                     "flags": pa.array([np.packbits(f).tobytes() for f in np.split(twice, cuts)], pa.binary())})


def chosen_runs(chunk: Chunk, ids: list[int | None], flags: list[dict] | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the documents, and which runs have an anchor that repeats."""
    order = order_of(ids)
    keys, _ = chunk.keys(order)
    repeated = np.zeros(len(keys), bool)
    dealt = bucket_of(keys, buckets)
    by = np.argsort(dealt, kind="stable")
    used, first = np.unique(dealt[by], return_index=True)
    parts = dict(zip(used.tolist(), np.split(by, first[1:]))) if len(by) else {}
    for f in flags or []:
        part = parts[f["bucket"]]
        repeated[part] = np.unpackbits(np.frombuffer(f["flags"], np.uint8))[:len(part)].astype(bool)
    return order, repeated[chunk.back] if len(keys) else np.zeros(0, bool)


def send_stretches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            chunk = Chunk(row["sizes"], row["blob"])
            order, chosen = chosen_runs(chunk, row["ids"], row["flags"], buckets)
            number, seqs = chunk.stretches(chosen)
            if not seqs:
                continue
            runs = np.flatnonzero(number >= 0)
            of, docs = number[runs], order[chunk.doc[runs]]
            low, high = np.full(len(seqs), LAST), np.full(len(seqs), np.iinfo(np.int64).min)
            np.minimum.at(low, of, docs)
            np.maximum.at(high, of, docs)
            dealt = np.zeros(len(seqs), np.int64)
            dealt[of] = bucket_of(chunk.key[runs], buckets)
            by = np.lexsort((np.arange(len(seqs)), dealt))
            used, first = np.unique(dealt[by], return_index=True)
            rows = []
            for b, part in zip(used, np.split(by, first[1:])):
                own = [seqs[i] for i in part.tolist()]
                rows.append((int(b), row["chunk"], packed(part.astype(np.int32)), packed(np.array([len(x) for x in own], np.uint8)),
                             packed(b"".join(own)), packed(low[part]), packed(high[part])))
            yield table(rows, STRETCHES, [pa.int64(), pa.int64(), *[pa.binary()] * 5])


STRETCHES = ["bucket", "chunk", "number", "length", "bytes", "low", "high"]
#: a passage of a stretch that goes back: its documents above ``low`` lose it
MARK = np.dtype([("number", "<i4"), ("off", "<u1"), ("size", "<u1"), ("low", "<i8")])


def maximal_repeats(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Maximal repeat groups of at least LEAST bytes among distinct sequences:
    (length, places of all occurrences), places in ``raw``."""
    n = sizes - LEAST + 1
    at = ragged(starts, n)
    end = np.repeat(starts + sizes, n)
    head = np.repeat(starts, n) == at
    # windows that occur once cannot repeat: leave them out before sorting
    w = words(np.append(raw, np.zeros(8, np.uint8)))
    h = w[at] * C[0]
    for k in (8, 16, 24, 32, 40, LEAST - 8):
        h = ((h ^ (h >> np.uint64(29))) + w[at + k]) * C[k // 8 % 3]
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[back] > 1)
    at, end, head = at[again], end[again], head[again]
    if not len(at):
        return []
    # the suffix array: sort by eight bytes at a time, big end first; ends are 0
    most = 2 * LEAST - GRAM
    size = np.minimum(end - at, most)
    wide = -(-most // 8) * 8
    view = np.append(raw, np.zeros(wide, np.uint8))
    text = view[at[:, None] + np.arange(wide)[None]]
    text[np.arange(wide)[None] >= size[:, None]] = 0
    order = np.lexsort((size, *text.view(">u8").astype(np.uint64).T[::-1]))
    at, size, head, text = at[order], size[order], head[order], text[order]
    equal = text[1:] == text[:-1]
    lcp = np.where(equal.all(axis=1), wide, equal.argmin(axis=1))
    lcp = np.minimum(lcp, np.minimum(size[1:], size[:-1]))
    left = np.where(head, -1, view[at - 1].astype(np.int16))
    groups: list[tuple[int, np.ndarray]] = []

    def offer(lo: int, hi: int, length: int) -> None:
        own = left[lo:hi]
        if (own < 0).any() or (own != own[0]).any():  # else the group one byte to the left says more
            groups.append((length, at[lo:hi]))

    long = lcp >= LEAST
    edge = np.flatnonzero(np.diff(np.concatenate([[0], long.astype(np.int8), [0]])))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
        own = lcp[lo:hi]
        if hi - lo == 1 or (own == own[0]).all():
            offer(lo, hi + 1, int(own[0]))
            continue
        # open intervals: (common prefix, first suffix); a smaller prefix closes them
        stack: list[tuple[int, int]] = []
        for i, v in enumerate([*own.tolist(), 0]):
            first = i
            while stack and stack[-1][0] > v:
                length, first = stack.pop()
                offer(lo + first, lo + i + 1, length)
            if v and (not stack or stack[-1][0] < v):
                stack.append((v, first))
    return groups


def answer_stretches(group: pa.Table) -> pa.Table:
    """For each chunk the passages of its stretches that a smaller document has."""
    chunks = group.column("chunk").to_pylist()
    number, length, low, high = ([unpacked(x.as_py(), t) for x in group.column(c)] for c, t in (("number", "<i4"), ("length", "<u1"), ("low", "<i8"), ("high", "<i8")))
    seen: dict[bytes, int] = {}
    own = []
    for n, b in zip(length, (unpacked(x.as_py()) for x in group.column("bytes"))):
        ends = np.cumsum(n.astype(np.int64))
        own += [seen.setdefault(b[e - k:e], len(seen)) for e, k in zip(ends.tolist(), n.tolist())]
    own = np.array(own, np.int64)
    row = np.repeat(np.arange(len(chunks)), [len(n) for n in number])
    number, low, high = map(np.concatenate, (number, low, high))
    seqs = list(seen)
    sizes = np.array([len(s) for s in seqs], np.int64)
    starts = np.cumsum(sizes) - sizes
    least, most = np.full(len(seqs), LAST), np.full(len(seqs), np.iinfo(np.int64).min)
    np.minimum.at(least, own, low)
    np.maximum.at(most, own, high)
    # a stretch that several documents have is a repeat as a whole
    whole = np.flatnonzero(least < most)
    of, off, size, bound = [whole], [np.zeros(len(whole), np.int64)], [sizes[whole]], [least[whole]]
    seq_at = np.repeat(np.arange(len(seqs)), sizes)
    for n, places in maximal_repeats(np.frombuffer(b"".join(seqs), np.uint8), starts, sizes):
        s = seq_at[places]
        first = least[s].min()
        s, p = s[most[s] > first], places[most[s] > first]
        of.append(s)
        off.append(p - starts[s])
        size.append(np.full(len(s), n))
        bound.append(np.full(len(s), first))
    of, off, size, bound = map(np.concatenate, (of, off, size, bound))
    # to the stretches' chunks
    by = np.argsort(own, kind="stable")
    begin = np.searchsorted(own[by], of)
    times = np.searchsorted(own[by], of, side="right") - begin
    entry = by[ragged(begin, times)]
    mark = np.repeat(np.arange(len(of)), times)
    above = high[entry] > bound[mark]
    entry, mark = entry[above], mark[above]
    out = np.zeros(len(entry), MARK)
    out["number"], out["off"], out["size"], out["low"] = number[entry], off[mark], size[mark], bound[mark]
    by = np.argsort(row[entry], kind="stable")
    used, first = np.unique(row[entry][by], return_index=True)
    parts = np.split(by, first[1:]) if len(by) else []
    return pa.table({"chunk": pa.array([chunks[r] for r in used.tolist()], pa.int64()),
                     "marks": pa.array([packed(out[p]) for p in parts], pa.binary())})


RESULT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def remove(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            chunk = Chunk(row["sizes"], row["blob"])
            gone = np.zeros(len(chunk.raw) + 1, np.int64)
            if row["marks"]:
                order, chosen = chosen_runs(chunk, row["ids"], row["flags"], buckets)
                number, _ = chunk.stretches(chosen)
                marks = np.concatenate([unpacked(m, MARK) for m in row["marks"]])
                by = np.argsort(number, kind="stable")
                begin = np.searchsorted(number[by], marks["number"])
                times = np.searchsorted(number[by], marks["number"], side="right") - begin
                run, mark = by[ragged(begin, times)], np.repeat(np.arange(len(marks)), times)
                above = order[chunk.doc[run]] > marks["low"][mark]
                run, mark = run[above], mark[above]
                s = chunk.start[run] + marks["off"][mark]
                np.add.at(gone, s, 1)
                np.add.at(gone, s + marks["size"][mark], -1)
            lost = np.cumsum(gone)[:-1] > 0
            kept = chunk.raw[~lost].tobytes()
            # a removed run begins where the byte before is kept or of another text
            fresh_text = np.zeros(len(lost), bool)
            fresh_text[chunk.starts[chunk.sizes > 0]] = True
            begins = np.flatnonzero(lost & (fresh_text | ~np.append(False, lost[:-1])))
            last = np.append(fresh_text[1:], True) | ~np.append(lost[1:], False)
            ends = np.flatnonzero(lost & last) + 1
            doc = np.searchsorted(chunk.ends, begins, side="right")
            offsets = np.append(0, np.cumsum(np.bincount(doc, minlength=len(row["ids"]))))
            left = np.append(0, np.cumsum(~lost))
            cuts = np.append(left[chunk.starts], len(kept)).tolist()
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(begins - chunk.starts[doc]), pa.array(ends - chunk.starts[doc])], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(chunk.sizes), spans, pa.array([kept[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, the removed ``spans`` and the bytes ``kept`` of each text."""
    chunks = written(df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(to_chunks, CHUNKS), "chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(16, total // BUCKET)
    keys = chunks.mapInArrow(lambda b: send_keys(b, buckets), "bucket long, chunk long, keys binary, several binary")
    flags = keys.groupBy("bucket").applyInArrow(answer_keys, "chunk long, bucket long, flags binary")
    flags = written(flags, "flags").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags"))
    told = written(chunks.join(flags, "chunk", "left").select("chunk", "ids", "sizes", "blob", "flags"), "told")
    schema = "bucket long, chunk long, number binary, length binary, bytes binary, low binary, high binary"
    marks = (told.mapInArrow(lambda b: send_stretches(b, buckets), schema)
             .groupBy("bucket").applyInArrow(answer_stretches, "chunk long, marks binary"))
    marks = written(marks, "marks").groupBy("chunk").agg(F.collect_list("marks").alias("marks"))
    return told.join(marks, "chunk", "left").select("chunk", "ids", "sizes", "blob", "flags", "marks").mapInArrow(lambda b: remove(b, buckets), RESULT)


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL_REPEATS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cuts AS (SELECT doc_id, h, unnest(range(0, length(h) // 2, 500)) AS base FROM texts),
parts AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 549) AS p FROM cuts),
starts AS (SELECT doc_id, base, p, unnest(range(0, length(p) // 2 - 49)) AS j FROM parts),
windows AS (SELECT doc_id, base + j AS i, substr(p, 2 * j + 1, 100) AS w FROM starts),
covered AS (
  SELECT doc_id, i FROM windows JOIN (SELECT w, min(doc_id) AS earliest FROM windows GROUP BY w) USING (w) WHERE earliest < doc_id
),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS begins FROM covered),
numbered AS (SELECT doc_id, i, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY 1, 2),
gaps AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS a FROM runs),
kept AS (
  SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last, string_agg(h[2 * a + 1:2 * b], '' ORDER BY b) AS k
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, '') || h[2 * coalesce(last, 0) + 1:])) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
