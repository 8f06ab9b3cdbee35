"""Near duplicates by BagMinHash: weighted Jaccard of the multisets of five-word
shingles, 0.8 or more.

Signatures.  Each level below a shingle's weight is a Poisson process of points
that go to a register each; two texts share a register's first point with
probability equal to their weighted Jaccard similarity.  Levels lie in a
hierarchy of ranges, [0, 1), [1, 2), [2, 4), [4, 8), ..., halved down to single
levels.  A range knows the time of its first point only, and is halved only
while that time is not past the latest register, so heavy shingles and long
texts take few points.  What a level emits does not depend on the weight.

Candidates.  Registers are banded; a band's bucket is searched without listing
its pairs.  The member that shares most buckets, weighed by their size, lies
nearest to its group and leads a bucket.  Each text is first held against one
leader, the nearest of those of its buckets.  Then components are joined, and
only buckets that still hold several go on.  Each of their members has a lot, a
hash of its text.  In each round the members whose lot is low enough (``HEADS`` of a
bucket, then ``STEP`` times as many) are held against those of higher lot, until
all of a bucket have been.  So no member is numbered within its bucket, a pair comes up once, in
the first bucket that both share, and texts that a round joins leave the next.  A
group that its leaders join costs a few tests a member.

Bounds.  Similar multisets of a and b shingles differ in at most a share
``APART`` of a + b.  They differ in |a - b| at least, and in as many as the bits
that differ between their parities (of the shingles that fall on a bit, even or
odd), as one more shingle flips one bit.  With 2,048 bits that comes close to the
difference itself for texts of some hundred shingles.  Pairs that these bounds
rule out are not tested, all others across components are: no link that shares a
bucket is lost.

Check.  A pair is a link if the exact multisets say so; links are joined to
classes.  Equal texts are one node from the start.

Defined results: a null text is an empty one; a text without words is a class
of its own; a text of fewer than five words is one shingle; repeated rows are in
one class; the class id is the least id in it (null if all are null); an empty
table gives an empty table; all columns are kept and added ones take unused
names.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import forget, fresh, pieces, written

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 28, 5
REGISTERS = BANDS * ROWS
#: numbers that hold the parities of a text's shingles, followed by one that counts
#: them; and the share of both texts' shingles that similar ones may differ in
PARITIES, APART = 32, (1 - SIMILAR) / (1 + SIMILAR)
SKETCH = PARITIES + 1
BATCH_CHARS, MOST_WORDS = 1 << 19, 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(seed: np.ndarray, count: np.ndarray, use: int) -> np.ndarray:
    return mix(seed + np.uint64(0x9E3779B97F4A7C15) * (count.astype(np.uint64) * np.uint64(4) + np.uint64(use)))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)) + np.uint64(1)).astype(np.float64) / 2.0 ** 53


def node_seed(element: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(element ^ mix(low.astype(np.uint64) * np.uint64(2) + np.uint64(1)) ^ (mix(size.astype(np.uint64)) << np.uint64(1)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """Registers (docs x REGISTERS) of the weighted elements, which come by doc:
    a number that names the first point of each register."""
    first, name = np.full(docs * REGISTERS, np.inf), np.zeros(docs * REGISTERS, np.uint64)
    # the doubling ranges that begin below each weight, each with its first point
    owner, low, size = [np.arange(len(doc))], [np.zeros(len(doc), np.int64)], [np.ones(len(doc), np.int64)]
    start = 1
    while len(more := np.flatnonzero(weight > start)):
        owner.append(more)
        low.append(np.full(len(more), start))
        size.append(np.full(len(more), start))
        start *= 2
    owner, low, size = map(np.concatenate, (owner, low, size))
    d, e, w = doc[owner], element[owner], weight[owner]
    seed, count = node_seed(e, low, size), np.zeros(len(d), np.int64)
    time = -np.log(unit(draw(seed, count, 0))) / (size * REGISTERS)
    while len(d):
        # a level emits points; a text of few levels takes several of each at once
        one = size == 1
        of = np.bincount(d[one], minlength=docs)
        times = np.maximum(1, 2 * REGISTERS // np.maximum(of[d[one]], 1))
        at = np.repeat(np.flatnonzero(one), times)
        ends = np.cumsum(times)
        if len(at):
            nth = np.arange(len(at)) - np.repeat(ends - times, times)
            c = count[at] + nth
            wait = -np.log(unit(draw(seed[at], c + 1, 0))) / REGISTERS
            run = np.cumsum(wait)
            before = run - wait
            # the point at hand is ``time``; waits lead from it to the next ones
            point = time[at] + before - np.repeat(before[ends - times], times)
            ident = draw(seed[at], c, 3)
            place = d[at] * REGISTERS + (ident % np.uint64(REGISTERS)).astype(np.int64)
            np.minimum.at(first, place, point)
            wins = point == first[place]
            name[place[wins]] = ident[wins]
            time[one] = point[ends - 1] + wait[ends - 1]
            count[one] += times
        latest = first.reshape(docs, REGISTERS).max(axis=1)
        live = time <= latest[d]
        d, e, w, low, size, seed, time, count = (x[live] for x in (d, e, w, low, size, seed, time, count))
        # a range whose first point may matter is halved: one half has that point,
        # by a coin, the other's first point is its own waiting time later
        cut = size > 1
        if cut.any():
            parts = [[x[~cut] for x in (d, e, w, low, size, seed, time, count)]]
            half, coin = size[cut] // 2, (draw(seed[cut], np.zeros(int(cut.sum()), np.int64), 1) & np.uint64(1)) == 0
            for right in (False, True):
                lo = low[cut] + half * right
                s = node_seed(e[cut], lo, half)
                t = np.where(coin != right, time[cut], time[cut] - np.log(unit(draw(s, np.zeros(len(s), np.int64), 2))) / (half * REGISTERS))
                below = lo < w[cut]
                parts.append([x[below] for x in (d[cut], e[cut], w[cut], lo, half, s, t, count[cut])])
            d, e, w, low, size, seed, time, count = map(np.concatenate, zip(*parts))
    return name.reshape(docs, REGISTERS)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def bands_of(words: list[list[bytes]], hashes: Hashes) -> np.ndarray:
    """Band keys (texts x BANDS) of texts that each have a word, followed by
    SKETCH numbers: the parities and the number of its shingles."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(flat))  # words from here to the end
    element = np.zeros(len(flat), np.uint64)
    for k in range(WORDS):
        there = np.append(flat[k:], np.zeros(min(k, len(flat)), np.uint64))[:len(flat)]
        there = np.where(left > k, there, np.uint64(0))
        element = mix(element + there + np.uint64(k + 1))
    # a window begins where five words follow, or at the start of a shorter text
    begins = (left >= WORDS) | ((left == np.repeat(sizes, sizes)) & (left < WORDS))
    doc, element = doc[begins], element[begins]
    order = np.lexsort((element, doc))
    doc, element = doc[order], element[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])))
    weight = np.diff(np.append(first, len(doc)))
    bits = signatures(doc[first], element[first], weight, len(words))
    keys = np.zeros((len(words), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix(keys + bits[:, r::ROWS] + np.uint64(r + 1))
    # the bits that an odd number of shingles fall on
    odd, width = first[weight % 2 == 1], np.uint64(64 * PARITIES)
    parity = np.zeros(len(words) * PARITIES, np.uint64)
    np.bitwise_xor.at(parity, doc[odd] * PARITIES + (element[odd] % width // np.uint64(64)).astype(np.int64), np.uint64(1) << element[odd] % np.uint64(64))
    return np.hstack([mix(keys + np.arange(BANDS, dtype=np.uint64)[None]).view(np.int64), parity.reshape(-1, PARITIES).view(np.int64),
                      np.bincount(doc, minlength=len(words))[:, None]])


def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, text) -> (key, id, bands); a text without words has none."""
    hashes = Hashes()
    for batch in batches:
        texts = batch.column(2)
        for lo, hi in pieces(pc.binary_length(texts).fill_null(0).to_pylist(), BATCH_CHARS):
            if len(hashes) > MOST_WORDS:
                hashes = Hashes()
            words = [(t or "").encode().split() for t in texts.slice(lo, hi - lo).to_pylist()]  # at ASCII white space
            own = [w for w in words if w]
            keys = bands_of(own, hashes) if own else np.zeros((0, BANDS + SKETCH), np.int64)
            counts = np.array([BANDS + SKETCH if w else 0 for w in words])
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))],
                                             names=["key", "id", "bands"])


def shingles(text: str) -> Counter:
    w = text.encode().split()
    if len(w) < WORDS:
        return Counter([tuple(w)]) if w else Counter()
    return Counter(zip(*(w[k:] for k in range(WORDS))))


def similar(a: Counter, b: Counter) -> bool:
    na, nb = a.total(), b.total()
    if min(na, nb) < SIMILAR * max(na, nb):
        return False
    if len(a) > len(b):
        a, b = b, a
    get = b.get
    both = sum(min(n, get(s, 0)) for s, n in a.items())
    return both >= SIMILAR * (na + nb - both) - 1e-9


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> (a, b) of similar pairs."""
    held: tuple[str, Counter] | None = None
    for batch in batches:
        keep = []
        for x, y in zip(*((t.as_py() for t in batch.column(i)) for i in (2, 3))):  # a pair at a time
            if held is None or held[0] != x:
                held = (x, shingles(x))
            keep.append(similar(held[1], shingles(y)))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def key_of(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds for the tables written meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: bytes of a batch of rows on its way to Python: pairs carry two whole texts each
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


#: a partition of fewer rows costs more to begin than to work on, and one of a bucket
#: of fewer members more to split than to leave whole
TASK_ROWS, SPLIT = 2_000, 4_096


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, made of so many rows, in no more partitions than hold TASK_ROWS of them
    each, but four for each core."""
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of written ``pairs`` whose texts are similar, written."""
    rows = pairs.count()
    both = gathered(pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"), rows)
    both = gathered(both.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a"), rows)
    with setting(pairs.sparkSession, *ARROW_BYTES):
        return written(both.select("a", "b", "text_a", "text_b").mapInArrow(verified, pairs.select("a", "b").schema), "links")


def components(edges: DataFrame) -> DataFrame:
    """Written (a, b) -> (key, comp): the least key that each key is joined with.  Each
    round takes the least label around a key, then the label of that label."""
    rows = 2 * edges.count()
    both = edges.select(F.col("a").alias("key"), F.col("b").alias("to")).union(edges.select("b", "a"))
    held = labels = written(gathered(both.groupBy("key").agg(F.least(F.min("to"), F.col("key")).alias("comp")), rows), "labels")
    while True:
        near = gathered(both.join(labels.select(F.col("key").alias("to"), "comp"), "to"), rows).groupBy("key").agg(F.min("comp").alias("near"))
        step = gathered(labels.join(near, "key").select("key", F.least("comp", "near").alias("next"), F.col("comp").alias("was")), rows)
        jump = (step.join(labels.select(F.col("key").alias("next"), F.col("comp").alias("far")), "next", "left")
                .select("key", F.least("next", F.coalesce("far", "next")).alias("comp"), "was"))
        jump = written(gathered(jump, rows), "labels")
        forget(held)
        held, labels = jump, jump.select("key", "comp")
        if jump.where("comp <> was").isEmpty():
            labels.held = held  # what to delete with it
            return labels


def named(key: str, doc_id: Column) -> Column:
    """An id that joins a null with a null."""
    return F.coalesce(doc_id.cast("string"), F.lit("")).alias(key)


#: lots are below this; the first round asks for so many members of each bucket, each
#: other for so many times those of the last one
LOTS, HEADS, STEP = 1 << 30, 16, 1024


def classes(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, id, bands) -> (key, comp) of the texts that have a link.

    ``rows`` holds (key, id, text); only the first copy of a text that is in a
    bucket with another one is read for checking.
    """
    members = nodes.select("key", F.explode(F.slice("bands", 1, BANDS)).alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(sizes, "band").select("band", "n", "key"), "shared")
    # the text nearest to the others of its group shares most buckets with them
    near = shared.groupBy("key").agg(F.sum("n").alias("near"))
    entries = shared.count()
    buckets = written(gathered(shared.join(near, "key"), entries), "buckets")
    forget(shared)
    first = nodes.join(buckets.select("key").distinct(), "key", "left_semi").select("key", named("own", F.col("id")))
    texts = rows.select("key", named("own", F.col("id")), "text").join(first, ["key", "own"], "left_semi")
    texts = written(texts.groupBy("key").agg(F.first("text").alias("text")), "texts")
    leaders = buckets.groupBy("band").agg(F.max(F.struct("near", "key")).alias("lead"))
    best = (gathered(buckets.join(leaders, "band"), entries).groupBy("key").agg(F.max("lead").alias("lead"))
            .select(F.col("lead.key").alias("a"), F.col("key").alias("b")).where("a <> b"))
    led = written(gathered(best, entries), "pairs")
    labels = components(links(led, texts))
    held, heads, open_ = buckets, HEADS, buckets.select("band", "n", "key")
    while True:
        # components only grow, so a bucket that is one of them stays out
        placed = gathered(open_.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key")), entries)
        split = placed.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("band")
        placed = written(gathered(placed.join(split, "band", "left_semi"), entries), "split")
        forget(held)
        held, open_ = placed, placed.select("band", "n", "key")
        largest, entries = placed.agg(F.max("n"), F.count("*")).first()
        if largest is None:
            break
        if heads == HEADS:
            # what the bounds need of the texts that are left; later rounds ask for fewer
            sketches = nodes.select("key", *[F.col("bands")[i].alias(f"k{i}") for i in range(BANDS)],
                                    *[F.col("bands")[BANDS + i].alias(f"p{i}") for i in range(PARITIES)], F.col("bands")[BANDS + PARITIES].alias("total"))
            sketches = written(gathered(sketches.join(placed.select("key").distinct(), "key", "left_semi"), entries), "sketches")
        pairs = untested(placed, sketches, led, heads, largest, entries)
        if not pairs.isEmpty():
            labels = joined(labels, links(pairs, texts))
        forget(pairs)
        if heads >= largest:
            break
        heads *= STEP
    forget(held, texts, led)
    return labels


def untested(placed: DataFrame, sketches: DataFrame, led: DataFrame, heads: int, largest: int, rows: int) -> DataFrame:
    """The pairs of this round: one of the two is among the ``heads`` expected of
    its bucket by lot, but was not in the round before, the other has a higher
    lot, they are in different components, no earlier bucket holds both, no bound
    shows them to be less similar, and they are not a leader's pair."""
    lots = F.pmod(F.xxhash64("key"), F.lit(LOTS))
    # Spark splits a hot bucket of a join if it deals out both sides for it, so both are stored
    # a component's 16 bytes as two numbers: these compare without a copy for each pair
    halves = [F.conv(F.hex(F.substring("comp", 1 + 8 * i, 8)), 16, -10).cast("long").alias(f"c{i}") for i in range(2)]
    all_ = written(gathered(placed.select("band", "n", "key", *halves, lots.alias("lot")).join(sketches, "key"), rows), "sketched")
    drawn = lambda k: F.col("lot") * F.col("n") < F.lit(LOTS * k)
    now = drawn(heads) if heads == HEADS else drawn(heads) & ~drawn(heads // STEP)
    columns = ["key", "c0", "c1", "lot", "total", *[f"k{i}" for i in range(BANDS)], *[f"p{i}" for i in range(PARITIES)]]
    one = all_.where(now).select("band", *columns)
    other = all_.select("band", *[F.col(c).alias(f"{c}_b") for c in columns])
    most = APART * (F.col("total") + F.col("total_b")) + 1e-6
    flips = reduce(Column.__add__, [F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}_b"))) for i in range(PARITIES)])
    higher = (F.col("lot_b") > F.col("lot")) | ((F.col("lot_b") == F.col("lot")) & (F.col("key_b") > F.col("key")))
    # the first bucket that both are in, of those in the order of the bands
    shared = F.lit(None).cast("long")
    for i in reversed(range(BANDS)):
        shared = F.when(F.col(f"k{i}") == F.col(f"k{i}_b"), F.col(f"k{i}")).otherwise(shared)
    apart = (F.col("c0") != F.col("c0_b")) | (F.col("c1") != F.col("c1_b"))
    pairs = (one.join(other, "band").where(higher & apart & (F.abs(F.col("total") - F.col("total_b")) <= most)
                                           & (F.col("band") == shared) & (flips <= most))
             .select(F.least("key", "key_b").alias("a"), F.greatest("key", "key_b").alias("b")))
    old = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # as one method the condition is past the size that HotSpot compiles, and would run interpreted
    with (setting(placed.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"),
          setting(placed.sparkSession, "spark.sql.adaptive.skewJoin.enabled", str(largest > SPLIT).lower())):
        out = written(gathered(gathered(pairs, rows).join(old, ["a", "b"], "left_anti"), rows), "open")
    forget(all_)
    return out


def joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The labels after more links; only components are looked at again."""
    a, b = (labels.select(F.col("key").alias(k), F.col("comp").alias(f"comp_{k}")) for k in ("a", "b"))
    rows = found.count()
    edges = gathered(found.join(a, "a", "left"), rows).join(b, "b", "left").select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    edges = written(gathered(gathered(edges, rows).where("a <> b").distinct(), rows), "edges")
    up = components(edges)
    new = up.select("key").join(labels, "key", "left_anti").select("key", F.col("key").alias("comp"))
    higher = up.select(F.col("key").alias("comp"), F.col("comp").alias("up"))
    out = written(labels.union(new).join(higher, "comp", "left").select("key", F.coalesce("up", "comp").alias("comp")), "labels")
    forget(found, edges, up.held, labels.held if hasattr(labels, "held") else labels)
    return out


def class_table(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row for each distinct text: key, id (the least of its copies), comp,
    class (the least id of its class), blank (it has no word)."""
    rows = df.select(key_of(text).alias("key"), F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bands = rows.mapInArrow(banded, T.StructType([T.StructField("key", T.BinaryType()), T.StructField("id", df.schema[doc_id].dataType),
                                                  T.StructField("bands", T.ArrayType(T.LongType()))]))
    # copies become one node before anything is dealt out by content
    with setting(df.sparkSession, *ARROW_BYTES):
        nodes = written(bands.groupBy("key").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "nodes")
    comps = classes(nodes.where(F.size("bands") > 0), rows)
    placed = (nodes.select("key", "id", (F.size("bands") == 0).alias("blank")).join(comps, "key", "left")
              .withColumn("comp", F.coalesce("comp", "key")))
    least = placed.groupBy("comp").agg(F.min("id").alias("class"))
    return written(placed.join(least, "comp").select("key", "id", "comp", "class", "blank"), "classes")


def classified(df: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "class_id") -> DataFrame:
    """``df`` with the id of each row's class."""
    table, key, cls, blank = class_table(df, doc_id, text), *(fresh(df, c) for c in ("key", "class", "blank"))
    table = table.select(F.col("key").alias(key), F.col("class").alias(cls), F.col("blank").alias(blank))
    out = df.withColumn(key, key_of(text)).join(table, key)
    return out.withColumn(name, F.when(F.col(blank), F.col(doc_id)).otherwise(F.col(cls))).drop(key, cls, blank)


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the least id, with the columns of ``df``.
    Of several such rows those of the least key remain, and one of those."""
    table, key, own = class_table(df, doc_id, text), fresh(df, "key"), fresh(df, "own")
    firsts = table.where(F.col("id").eqNullSafe(F.col("class")) & ~F.col("blank")).groupBy("comp").agg(F.min_by(F.struct("key", "id"), "key").alias("f"))
    firsts = written(firsts.select(F.col("f.key").alias(key), named(own, F.col("f.id"))), "firsts")
    rows = df.withColumn(key, key_of(text)).withColumn(own, named(own, F.col(doc_id)))
    blank = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    repeated = written(rows.where(~blank).groupBy(key, own).count().where("count > 1").drop("count"), "repeated")
    # copies differ by id, so this join does not gather them; a null id is no key of skew either, as the text's key goes with it
    kept = rows.where(~blank).join(firsts, [key, own], "left_semi")
    if not repeated.isEmpty():
        kept = kept.join(repeated, [key, own], "left_anti").union(kept.join(repeated, [key, own], "left_semi").dropDuplicates([key]))
    return rows.where(blank).union(kept.select(*rows.columns)).select(*[F.col(f"`{c}`") for c in df.columns])


def q_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classified(docs).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
