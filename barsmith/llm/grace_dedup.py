"""Exact duplicates by Grace hashing.

Texts are equal when they are the same after each run of ASCII white space has
become one space; a null text is an empty one.

Combining.  Each task folds the rows that it reads into an open-addressing
table, which compares complete contents, and empties it whenever it is full.  So
a text that a third of all rows hold leaves a task once, not once a row.

Partitioning.  What is left is dealt out by its hash, in as many buckets as
``TABLE_BYTES`` asks for.  A bucket's table takes contents until it is full.
From then on it only counts copies of what it holds; all other records go to
spill files in the shared folder, and the next level deals those out again by
another mix of the hash, until no table has anything to spill.  Whatever a
table holds has met all its copies, since a content that came too late never
enters.  A task holds one table and never a group of rows.

Telling the rows.  Only groups of two rows or more are joined back, by hash;
where several contents have one hash (``shared``) their digests decide.

Defined results: a null id is larger than any other, so it stays only where all
ids of its group are null; of rows that are equal in text and tie for the least
id, one stays; an empty table gives an empty table.  Only the id and the text are
read, other columns go along whatever their names; ``table_bytes`` bounds the
contents a task holds, one longer text is held alone.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import fresh, written

#: bytes of the contents in one task's table
TABLE_BYTES = 32 << 20
#: bytes of a batch of rows that leaves a table
BATCH_BYTES = 4 << 20
#: buckets of one level; what a table can't hold goes to the next level
MOST_BUCKETS = 1 << 14
#: bytes that an entry takes besides its content
ENTRY = 200


class Table:
    """An open-addressing table (linear probing) of whole contents.  It takes
    records (hash, text, least id, rows at that id, rows, whether the hash is
    shared) until one has no room left among ``room`` bytes (a first, longer one
    always has), and none after that."""

    def __init__(self, room: int):
        self.room, self.used, self.full = room, 0, False
        self.slots, self.mask = [-1] * 1024, 1023
        self.columns: tuple[list, ...] = ([], [], [], [], [], [])

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, h: int, text: bytes, least, ties: int, n: int, shared: bool) -> bool | None:
        """Whether the record found its content or room for it; None if it found
        neither but another content of its hash."""
        slots, mask = self.slots, self.mask
        hashes, texts, leasts, tied, counts, share = self.columns
        at, refused = h & mask, False
        while (e := slots[at]) >= 0:
            if hashes[e] == h:
                if texts[e] == text:
                    counts[e] += n
                    old = leasts[e]
                    if old == least:
                        tied[e] += ties
                    elif old is None or (least is not None and least < old):
                        leasts[e], tied[e] = least, ties
                    return True
                shared = share[e] = True
                refused = None
            at = (at + 1) & mask
        self.full |= bool(texts) and self.used + len(text) > self.room
        if self.full:
            return refused
        slots[at] = len(texts)
        self.used += len(text) + ENTRY
        for column, value in zip(self.columns, (h, text, least, ties, n, shared)):
            column.append(value)
        if 3 * len(texts) > 2 * mask:
            self.grow()
        return True

    def grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = slots = [-1] * (self.mask + 1)
        for e, h in enumerate(self.columns[0]):
            at = h & self.mask
            while slots[at] >= 0:
                at = (at + 1) & self.mask
            slots[at] = e


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def schema_of(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("h", pa.int64()), ("text", pa.binary()), ("least", id_type), ("ties", pa.int64()), ("n", pa.int64()), ("shared", pa.bool_())])


def packed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(h, text, ...) rows as batches of about ``BATCH_BYTES``."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += len(row[1] or b"") + ENTRY
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def combined(batches: Iterator[pa.RecordBatch], room: int) -> Iterator[pa.RecordBatch]:
    """(h, text, id) -> records; copies that meet in one filling of the table
    are one record."""
    table, schema = Table(room), None
    for batch in batches:
        schema = schema or schema_of(batch.schema.types[2])
        for h, text, own in rows_of(batch):
            if not table.add(h, text, own, 1, 1, False):
                yield from packed(zip(*table.columns), schema)
                table = Table(room)
                table.add(h, text, own, 1, 1, False)
    if len(table):
        yield from packed(zip(*table.columns), schema)


def settled(batches: Iterator[pa.RecordBatch], room: int) -> Iterator[pa.RecordBatch]:
    """Records of a bucket -> its groups, and with n below 0 the records that its
    table had no room for.  Groups leave without their content; a text of one row
    whose hash is its own does not leave at all."""
    table, schema = Table(room), None
    for batch in batches:
        schema = schema or schema_of(batch.schema.types[2])

        def late(batch: pa.RecordBatch = batch) -> Iterator[tuple]:
            for h, text, least, ties, n, shared in rows_of(batch):
                if not (taken := table.add(h, text, least, ties, n, shared)):
                    yield h, text, least, ties, -n, shared or taken is None

        yield from packed(late(), schema)
    if len(table):
        yield from packed(((h, sha256(t).hexdigest().encode() if shared else None, least, ties, n, shared)
                           for h, t, least, ties, n, shared in zip(*table.columns) if n > 1 or shared), schema)


def normal(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def hashed(text: Column) -> Column:
    return F.xxhash64(text)


def groups(df: DataFrame, doc_id: str, text: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(h, digest, least, ties, n, shared): a row for each group of equal texts,
    but for texts of one row whose hash is their own; ``digest`` is there if
    the hash is shared.  Written."""
    spark, own = df.sparkSession, df.schema[doc_id].dataType
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("text", T.BinaryType()), T.StructField("least", own),
                           T.StructField("ties", T.LongType()), T.StructField("n", T.LongType()), T.StructField("shared", T.BooleanType())])
    rows = df.select(normal(text).alias("text"), F.col(f"`{doc_id}`").alias("id"))
    rows = rows.select(hashed(F.col("text")).alias("h"), F.col("text").cast("binary").alias("text"), "id")
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    left, found, level = rows.mapInArrow(lambda b: combined(b, table_bytes), schema), [], 0
    while True:
        buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // table_bytes)))
        # each level mixes the hash anew, or all that a bucket spilled would meet again
        dealt = left.repartition(buckets, F.xxhash64("h", F.lit(level)))
        out = written(dealt.mapInArrow(lambda b: settled(b, table_bytes), schema), f"grace-{level}")
        found.append(out.where("n > 0").withColumnRenamed("text", "digest"))
        left = out.where("n < 0").withColumn("n", -F.col("n"))
        size, records = left.agg(F.sum(F.octet_length("text").cast("long")), F.count("*")).first()
        if not records:
            return reduce(DataFrame.unionByName, found)
        level += 1


def grouped(df: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES, keep_text: bool = True) -> DataFrame:
    """``df`` with the id of the row that stays for each row's text (``keep_id``),
    the number of rows with that text (``group_size``), whether this row stays
    (``kept``) and the digest of the text (``text_sha256``)."""
    found = groups(df, doc_id, text, table_bytes)
    h, keep, size, kept, sha = (fresh(df, c) for c in ("h", "keep_id", "group_size", "kept", "text_sha256"))
    ties, digest, place, first = (fresh(df, c) for c in ("ties", "digest", "place", "first"))
    rows = df.withColumn(sha, normal(text)).withColumn(h, hashed(F.col(sha))).withColumn(sha, F.sha2(sha, 256))
    rows = rows if keep_text else rows.drop(text)
    known = found.select(F.col("h").alias(h), F.col("least").alias(keep), F.col("n").alias(size), F.col("ties").alias(ties), F.col("digest").cast("string").alias(digest), "shared")
    alone = known.where("not shared").drop("shared", digest)
    shared = known.where("shared").drop("shared").withColumnRenamed(digest, sha)
    if shared.isEmpty():
        out = rows.join(alone, h, "left")
    else:
        which = shared.select(h).distinct()
        out = rows.join(which, h, "left_anti").join(alone, h, "left").unionByName(rows.join(shared, [h, sha]))
    mine = F.col(f"`{doc_id}`")
    # a text that no group names has one row
    out = out.withColumn(keep, F.when(F.col(size).isNull(), mine).otherwise(F.col(keep))).withColumn(size, F.coalesce(size, F.lit(1)))
    out = out.withColumn(kept, mine.eqNullSafe(F.col(keep)))
    if not found.where("ties > 1").isEmpty():
        # rows that tie for the least id: the first one as written stays
        out = written(out.withColumn(place, F.monotonically_increasing_id()), "tied")
        firsts = out.where(F.col(kept) & (F.col(ties) > 1)).groupBy(h, sha).agg(F.min(place).alias(first)).select(F.col(first).alias(place), F.lit(True).alias(first))
        out = out.join(firsts, place, "left").withColumn(kept, F.col(kept) & ((F.coalesce(ties, F.lit(1)) == 1) | F.coalesce(first, F.lit(False)))).drop(place, first)
    return out.select(*[F.col(f"`{c}`") for c in df.columns if keep_text or c != text], keep, size, kept, sha)


def distinct(df: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row of each text, with the columns of ``df``."""
    kept = fresh(df, "kept")
    return grouped(df, doc_id, text, table_bytes).where(kept).select(*[F.col(f"`{c}`") for c in df.columns])


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return grouped(docs, keep_text=False).select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


SQL_EXACT_DEDUP = r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
),
texts AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN texts USING (text_sha256)
"""
