"""Deterministic sharded WARC writer and reader.

Records are ordered by page id, payload digest and a hash of the url and cut into shards of
``SHARD_BYTES`` of payload.  The borders are keys of that order at whose running
sum of bytes a shard is full; the sum is taken in ranges, with a row a range to
join them, so the borders are exact and depend on the rows alone.  A shard holds
less than its limit and one record more, however the ids lie.  Repeated rows that
are equal in all three and pass the limit together get shards of their own and are
dealt out over them.  A border takes 73 bytes; they reach tasks as one array
(120 MB at 100 TB).

Each shard goes to a task by its number (above ``MOST_TASKS`` shards several that
follow each other).  The task writes it record by record as gzip members, each
file after a ``warcinfo`` record, and starts another file when one has reached its
compressed size.  Headers, record ids, digests and dates derive from the rows: two
runs write the same files, byte for byte (shards of such repeated rows aside: the
scan's order says which holds how many).  A file is written under a temporary name
that holds the attempt, then moved to its final name.  The manifest is a folder of
parts that Spark commits, a line a file with its size and digest, and a root that
names the folder, written last and moved too; only files listed there are read.  A
task that runs twice moves equal files.  No list of files reaches the driver.

Of records with equal payloads of at least ``REVISIT_FROM`` bytes the one with
the largest page id is a response, others are revisits of it.

Defined results: a null payload is empty; a null url is empty; a null page id
sorts first, is the smallest and is kept as null; of repeated rows with the
largest id all are responses, and revisits name the one of the greatest url; an
empty table writes a manifest without files.
Line breaks in a url are percent-coded in its header.  Only the named columns
are read, so others cannot clash.
"""
from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.llm.common import forget, scratch, written

REVISIT_FROM = 1000
#: compressed bytes after which a file is closed; payload bytes of one shard
FILE_BYTES, SHARD_BYTES = 32 << 20, 64 << 20
#: tasks that shards are dealt to at most, payload bytes that a reader holds at once
MOST_TASKS, READ_BYTES = 1 << 15, 8 << 20
DATE = "2024-01-01T00:00:00Z"
#: name space of the record ids
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
WRITTEN = "file string, shard int, records long, bytes long, sha256 string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, place (text in the order of id, digest
    and a hash of the url) and turn (a number drawn for the row where it is read)."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
                        F.xxhash64(F.monotonically_increasing_id()).alias("turn")).withColumn("digest", F.sha1("payload"))
    # with the sign bit turned, hex digits are in the order of the ids
    digits = F.lpad(F.hex(F.col("page_id").cast("long").bitwiseXOR(F.lit(-1 << 63))), 16, "0")
    return rows.withColumn("place", F.concat(F.coalesce(F.concat(F.lit("1"), digits), F.lit("0" * 17)), "digest",
                                           F.lpad(F.hex(F.xxhash64("url")), 16, "0")))


def copies(keys: DataFrame) -> DataFrame:
    """(page_id, url, digest, bytes) -> the digests of several records, with the
    largest page id of each as ``refers_to`` and that record's ``refers_url``."""
    return (keys.where(F.col("bytes") >= REVISIT_FROM).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
            .where("n > 1").select("digest", F.col("last.page_id").alias("refers_to"), F.col("last.url").alias("refers_url")))


def borders(keys: DataFrame, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, bytes) -> the first place of each run of shards, and the number of
    its first shard, followed by the number of all shards.  A run is one shard, or
    those that one place needs whose rows pass the limit together."""
    cells = keys.groupBy("place").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    cells = written(cells.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "cells")
    inside, across = Window.partitionBy("part").orderBy("place"), Window.orderBy("part")  # a row a range is ordered across
    run = F.coalesce(F.sum("bytes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells_run = cells.withColumn("run", run).withColumn("last", F.lag("run").over(inside))
    starts = (cells_run.groupBy("part").agg(F.sum("bytes").alias("all"), F.max("run").alias("tail"))
              .withColumn("start", F.coalesce(F.sum("all").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("part", "start", F.lag(F.col("start") + F.col("tail")).over(across).alias("end")))
    # where a place begins, and where the one before it began, in the range before if it is the first of its own
    placed = (cells_run.join(starts, "part").withColumn("at", F.expr(f"(start + run) div {shard_bytes}"))
              .withColumn("was", F.coalesce(F.expr(f"coalesce(start + last, end) div {shard_bytes}"), F.lit(-1))))
    hot = (F.col("n") > 1) & (F.col("bytes") > shard_bytes)
    ways = F.when(hot, F.expr(f"(bytes + {shard_bytes - 1}) div {shard_bytes}")).otherwise(F.lit(1))
    first = placed.where(hot | (F.col("at") != F.col("was"))).select("place", ways.alias("ways")).toPandas().sort_values("place")
    forget(cells)
    return first["place"].to_numpy("S73"), np.append(0, np.cumsum(first["ways"].to_numpy(np.int64)))


def shard_of(places: np.ndarray, numbers: np.ndarray) -> Column:
    """Shard number of a row with ``place`` and ``turn``; the first run also takes
    what lies before its place."""
    @F.pandas_udf("int")
    def number(place: pd.Series, turn: pd.Series) -> pd.Series:
        run = np.maximum(np.searchsorted(places, place.to_numpy("S73"), side="right") - 1, 0)
        return pd.Series(numbers[run] + turn.to_numpy() % (numbers[run + 1] - numbers[run]))

    return number("place", "turn")


def coded(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record_id(page_id: int | None, url: str, digest: str) -> str:
    named = "null" if page_id is None else str(page_id)
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{named} {coded(url)} {digest}')}>"


def framed(headers: list[tuple[str, str]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def info(name: str) -> bytes:
    """The record that a file begins with."""
    return framed([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"), ("WARC-Date", DATE),
                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One record with its headers, before compression."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", DATE), ("WARC-Target-URI", coded(url)), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", "null" if page_id is None else str(page_id)),
    ]
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", record_id(refers_to, refers_url or "", digest)),
                    ("WARC-Refers-To-Target-URI", coded(refers_url or "")), ("WARC-Refers-To-Date", DATE), ("X-Refers-To-Page-Id", str(refers_to))]
    return framed(headers, http if revisit else http + payload)


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class File:
    """An archive that gets its name when it is whole."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, number: int):
        self.store, self.shard = store, shard
        self.name = f"shard-{shard:06d}-{number:05d}.warc.gz"
        self.final = posixpath.join(folder, self.name)
        self.temporary = posixpath.join(folder, f".{self.name}.{uuid.uuid4().hex}")
        self.out, self.records, self.bytes, self.hash = store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        self.put(member(info(self.name)))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self.put(data)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.store.move(self.temporary, self.final)
        return self.name, self.shard, self.records, self.bytes, self.hash.hexdigest()


def write_files(batches: Iterator[pa.RecordBatch], uri: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    store, folder = fs.FileSystem.from_uri(uri)
    done, file, number = [], None, 0
    for batch in batches:
        for shard, page_id, url, payload, digest, refers_to, refers_url in zip(*(c.to_pylist() for c in batch.columns)):
            if file is not None and (file.shard != shard or file.bytes >= file_bytes):
                done.append(file.close())
                number = number + 1 if file.shard == shard else 0
                file = None
            if file is None:
                file = File(store, folder, shard, number)
            file.add(member(record(page_id, url, payload, digest, refers_to, refers_url)))
    if file is not None:
        done.append(file.close())
    names = ["file", "shard", "records", "bytes", "sha256"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 5, [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()])], names=names)


def write_warc(pages: DataFrame, uri: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES) -> None:
    """(page_id, url, html) -> archives, parts of the manifest and its root
    ``manifest.json`` in the folder ``uri``."""
    spark, rows = pages.sparkSession, payloads(pages)
    # what is decided over all records is decided on their keys; a payload moves once, to its shard
    keys = written(rows.select("page_id", "url", "digest", "place", F.octet_length("payload").cast("long").alias("bytes")), "keys")
    first = written(copies(keys), "copies")
    places, numbers = borders(keys, shard_bytes)
    if not len(places):
        places, numbers = np.zeros(1, "S73"), np.array([0, 1])
    shards = int(numbers[-1])
    tasks = min(shards, MOST_TASKS)
    revisit = F.col("page_id").isNull() | (F.col("page_id") != F.col("last"))
    rows = (rows.join(first.withColumnRenamed("refers_to", "last"), "digest", "left")
            .withColumn("refers_to", F.when(revisit, F.col("last"))).withColumn("shard", shard_of(places, numbers)))
    dealt = (rows.repartitionById(tasks, F.expr(f"cast(cast(shard as long) * {tasks} div {shards} as int)")).sortWithinPartitions("shard", "place", "url")
             .select("shard", "page_id", "url", "payload", "digest", "refers_to", "refers_url"))
    store, folder = fs.FileSystem.from_uri(uri)
    store.create_dir(folder)
    parts = f"manifest-{uuid.uuid4().hex}"
    dealt.mapInArrow(lambda batches: write_files(batches, uri, file_bytes), WRITTEN).write.json(f"{uri.rstrip('/')}/{parts}")
    forget(keys, first)
    total = listed(spark, uri, parts).agg(F.count("*"), F.sum("records"), F.sum("bytes")).first()
    temporary = posixpath.join(folder, f".manifest.{uuid.uuid4().hex}")
    with store.open_output_stream(temporary, compression=None) as out:
        out.write(json.dumps({"parts": parts, **dict(zip(("files", "records", "bytes"), (n or 0 for n in total)))}, indent=1).encode())
    store.move(temporary, posixpath.join(folder, "manifest.json"))


def listed(spark: SparkSession, uri: str, parts: str) -> DataFrame:
    """A row for each file of the manifest."""
    return spark.read.schema(WRITTEN).json(f"{uri.rstrip('/')}/{parts}")


def parsed(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed stream."""
    while line := data.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        headers = {}
        while (line := data.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            headers[k] = v
        block = data.read(int(headers["Content-Length"]))
        if data.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end")
        yield headers, block


def read_files(batches: Iterator[pa.RecordBatch], uri: str, whole: bool) -> Iterator[pa.RecordBatch]:
    store, folder = fs.FileSystem.from_uri(uri)
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows, held = [], 0
            with store.open_input_stream(posixpath.join(folder, name), compression=None) as raw:
                for h, block in parsed(io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)):
                    if hashlib.sha1(block).hexdigest() != h["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"{name}: a block does not fit its digest")
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    revisit = h["WARC-Type"] == "revisit"
                    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (size != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{name}: a payload does not fit its digest")
                    page = None if h["X-Page-Id"] == "null" else int(h["X-Page-Id"])
                    rows.append((page, size, digest, h["WARC-Type"], int(h["X-Refers-To-Page-Id"]) if revisit else None,
                                 h["WARC-Target-URI"], payload if whole and not revisit else None))
                    held += 200 + (len(payload) if whole else 0)
                    if held > READ_BYTES:
                        yield as_batch(rows)
                        rows, held = [], 0
            if rows:
                yield as_batch(rows)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])


def read_warc(spark: SparkSession, uri: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest lists.  Every block and
    payload is held against its digest."""
    store, folder = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(posixpath.join(folder, "manifest.json"), compression=None) as f:
        root = json.loads(f.read())
    if not root["files"]:
        return spark.createDataFrame([], READ)
    files = listed(spark, uri, root["parts"]).select("file").repartition(min(root["files"], MOST_TASKS))
    return files.mapInArrow(lambda batches: read_files(batches, uri, payloads), READ)


def as_uri(path: str) -> str:
    return path if re.match(r"[a-z0-9+]+:", path) else f"file://{os.path.abspath(path)}"


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = as_uri(scratch(spark, "warc"))
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), uri)
    return read_warc(spark, uri, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_WARC = f"""
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (
  SELECT payload_digest, max(page_id) AS page FROM rows WHERE payload_bytes >= {REVISIT_FROM} GROUP BY 1 HAVING count(*) > 1
)
SELECT r.page_id, payload_bytes, r.payload_digest,
  CASE WHEN page IS NULL OR r.page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page IS NULL OR r.page_id = page THEN NULL ELSE page END AS refers_to
FROM rows r LEFT JOIN firsts f ON f.payload_digest = r.payload_digest
"""
