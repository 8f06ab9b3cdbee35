"""Sharding by extendible hashing.

A row's address is the bits of a 60-bit hash.  The directory starts with one
bucket; a bucket that holds more than ``limit`` bytes is split on its next bit,
others are not, until every bucket fits.  A bucket is named by its prefix, so
two runs over the same rows name the same shards whatever the partitioning.

The splits are found by aggregation: each round sums the bytes of the open
buckets at several more bits at once, and only rows of buckets that are still
too large go on.  Nothing but the directory's open buckets is ever grouped, a
row is read as (address, bytes), and no list of rows or shards reaches the
driver.

Defined results: rows that equal each other in key and text share an address,
which no bit can divide; when such a bucket is too large at the last bit, its
rows are laid one after another into overflow shards (``prefix-0``,
``prefix-1``, ...), each below the limit; they are numbered in runs of at most
``2 ** RUN`` rows, so a hot address is dealt over many tasks.  A single row above
the limit is a shard of its own.  Null keys and texts hash as a value of their own and a null
text counts 0 bytes; an empty table gives an empty table.  All columns of the
input are kept and ``shard``, ``shard_bytes`` and ``n_bytes`` added; if a name is
in use, the added column takes it with underscores in front.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.llm.common import fresh, written

BITS = 60
#: bits that one round of splitting looks ahead
STEP = 10
#: rows of one address that are numbered together, as a power of two
RUN = 12


def address(*values: Column) -> Column:
    """60 hash bits as text of 0 and 1."""
    key = F.concat_ws(":", *[F.coalesce(v.cast("string"), F.lit("\\N")) for v in values])
    return F.lpad(F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 2), BITS, "0")


def leaves(rows: DataFrame, limit: int) -> DataFrame:
    """(addr, size) -> the directory's buckets (prefix, bytes, rows).

    Buckets of every depth below a round's start are summed at once (an
    aggregate of at most STEP rows an address group), and the shallowest that
    fits with an oversized parent is a leaf.
    """
    cells = rows.groupBy("addr").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    open_, found, depth = cells.withColumn("root", F.lit("")), [], 0
    while depth <= BITS:
        last = min(depth + STEP, BITS)
        # sums at the deepest prefix first: the shallower ones add those up
        deep = open_.groupBy(F.substring("addr", 1, last).alias("deep")).agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
        sums = (deep.select(F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth"), "deep", "size", "n")
                .groupBy("depth", F.expr("substr(deep, 1, depth)").alias("prefix"))
                .agg(F.sum("size").alias("bytes"), F.sum("n").alias("rows")))
        sums = written(sums, "directory")
        large = sums.where((F.col("bytes") > limit) & (F.col("rows") > 1))
        parents = large.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fit = sums.where((F.col("bytes") <= limit) | (F.col("rows") <= 1))
        first = fit.where((F.col("depth") == depth) & F.lit(depth == 0))
        below = (fit.where(F.col("depth") > depth).withColumn("parent", F.expr("substr(prefix, 1, depth - 1)"))
                 .join(parents, ["depth", "parent"], "left_semi"))
        names = ["prefix", "bytes", "rows"]
        found += [first.select(*names), below.select(*names)]
        rest = large.where(F.col("depth") == last).select(F.col("prefix").alias("root"))
        if last == BITS:
            found.append(large.where(F.col("depth") == BITS).select(*names))
            break
        if rest.isEmpty():
            break
        open_ = cells.withColumn("root", F.substring("addr", 1, last)).join(rest, "root", "left_semi")
        depth = last
    return reduce(DataFrame.unionByName, found)


def shard(df: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """``df`` with the name and size of every row's shard."""
    addr, size, name, total = (fresh(df, c) for c in ("addr", "n_bytes", "shard", "shard_bytes"))
    rows = df.withColumn(addr, address(F.col(key), F.col(text))).withColumn(
        size, F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    buckets = written(leaves(written(rows.select(F.col(addr).alias("addr"), F.col(size).alias("size")), "addresses"), limit), "buckets")
    low, high, hot = buckets.agg(F.min(F.length("prefix")), F.max(F.length("prefix")), F.max((F.col("bytes") > limit) & (F.col("rows") > 1))).first()
    if low is None:
        return rows.drop(addr).withColumn(name, F.lit("")).withColumn(total, F.lit(0).cast("long"))
    depth, prefix, count = (fresh(rows, c) for c in ("depth", "prefix", "shard_rows"))
    named = buckets.select(F.col("prefix").alias(prefix), F.col("bytes").alias(total), F.col("rows").alias(count))
    # a row has one prefix of each depth in use and one of them is its bucket
    placed = (rows.withColumn(depth, F.explode(F.sequence(F.lit(low), F.lit(high))))
              .withColumn(prefix, F.expr(f"substr(`{addr}`, 1, `{depth}`)")).join(named, prefix).drop(depth))
    over = (F.col(total) > limit) & (F.col(count) > 1)
    plain = placed.where(~over).withColumn(name, F.col(prefix))
    if not hot:
        return plain.drop(addr, prefix, count)
    # rows of one address are alike, so each overflow shard takes the same number of them
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col(size), F.lit(1))))
    # each run is numbered by itself, after the rows of the address in the runs before it
    turn, salt, start = (fresh(placed, c) for c in ("turn", "salt", "start"))
    laid = written(placed.where(over).withColumn(turn, F.monotonically_increasing_id()).withColumn(salt, F.shiftright(turn, RUN)), "overflow")
    before = F.sum(start).over(Window.partitionBy(prefix).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1))
    starts = laid.groupBy(prefix, salt).agg(F.count("*").alias(start)).withColumn(start, F.coalesce(before, F.lit(0)))
    number = F.col(start) + F.row_number().over(Window.partitionBy(prefix, salt).orderBy(turn)) - 1
    laid = laid.join(starts, [prefix, salt]).withColumn(name, F.concat_ws("-", prefix, F.floor(number / each).cast("string")))
    laid = laid.withColumn(total, F.sum(size).over(Window.partitionBy(name)))
    return plain.unionByName(laid.select(*plain.columns)).drop(addr, prefix, count)


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 256 << 20) -> None:
    """One folder of Parquet files a shard."""
    placed = shard(df, key, text, limit)
    name = next(c for c in placed.columns if c not in df.columns and c.lstrip("_") == "shard")
    placed.repartition(name).write.partitionBy(name).parquet(path)


#: bytes of text in one shard of the registered query
LIMIT = 4 << 20


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs, "doc_id", "text", LIMIT).select("doc_id", "n_bytes", "shard", "shard_bytes")


SQL_SHARDING = f"""
WITH rows AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    lpad((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '\\N') || ':' || coalesce(text, '\\N')), 1, 15))::BIGINT)::BIT::VARCHAR, 64, '0')[5:] AS addr
  FROM documents
),
sums AS (
  SELECT d AS depth, substr(addr, 1, d::BIGINT) AS prefix, sum(n_bytes)::BIGINT AS bytes, count(*) AS n
  FROM rows, range(0, 25) AS r(d) GROUP BY 1, 2
),
buckets AS (
  SELECT s.* FROM sums s LEFT JOIN sums p ON p.depth = s.depth - 1 AND p.prefix = substr(s.prefix, 1, s.depth - 1)
  WHERE (s.bytes <= {LIMIT} OR s.n <= 1) AND (s.depth = 0 OR (p.bytes > {LIMIT} AND p.n > 1))
)
SELECT doc_id, n_bytes, b.prefix AS shard, b.bytes AS shard_bytes
FROM rows JOIN buckets b ON substr(addr, 1, b.depth::BIGINT) = b.prefix
"""
