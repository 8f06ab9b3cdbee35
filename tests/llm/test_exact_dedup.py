"""Grace hash deduplication against brute force."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from barsmith.llm import grace_dedup as grace
from tests.llm.conftest import EDGES

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(docs):
    """Rows as the contract has them; of tied rows one is kept, whichever."""
    by = defaultdict(list)
    for d, t in docs:
        by[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for t, ids in by.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha, n = hashlib.sha256(t.encode()).hexdigest(), len(ids)
        own = sorted(ids, key=lambda i: (i != keep, i is None, i))
        out += [(d, keep, n, k == 0, sha) for k, d in enumerate(own)]
    return Counter(out)


def corpus(n):
    rnd = random.Random(n)
    some = [" ".join(rnd.choice(["a", "b", "c d", "\u00e9", "\t"]) for _ in range(rnd.randint(0, 30))) for _ in range(n // 4)]
    docs = [(i, rnd.choice(some) if rnd.random() < 0.5 else f"own  text {i}" + "x" * rnd.randint(0, 400)) for i in range(n)]
    docs += [(n + i, "the \n hot   text") for i in range(n // 2)]  # a third of all rows
    return docs + [(3, docs[3][1]), (3, docs[3][1]), (None, docs[5][1]), (None, None), (None, ""), (7 * n, None)]


def test_against_brute_force(spark):
    docs = corpus(400)
    got = grace.grouped(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == brute(docs)


def test_small_tables_spill_level_after_level(spark, monkeypatch):
    levels = []
    real = grace.written
    monkeypatch.setattr(grace, "written", lambda df, name: (levels.append(name), real(df, name))[1])
    monkeypatch.setattr(grace, "MOST_BUCKETS", 2)
    docs = corpus(300)
    got = grace.grouped(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), table_bytes=15_000)
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == brute(docs)
    assert "grace-2" in levels


def test_contents_that_share_a_hash_stay_apart(spark, monkeypatch):
    """A hash of 13 values: contents are compared in full, in one table and over levels."""
    monkeypatch.setattr(grace, "hashed", lambda text: F.pmod(F.xxhash64(text), F.lit(13)))
    docs = corpus(200)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, grace.grouped(df).select(*COLUMNS).collect())) == brute(docs)
    monkeypatch.setattr(grace, "MOST_BUCKETS", 2)
    got = grace.grouped(df, table_bytes=9_000)
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == brute(docs)


def test_a_table_never_holds_more_than_its_room():
    table = grace.Table(10_000)
    taken = [table.add(h, b"x" * 300 + str(h).encode(), h, 1, 1, False) for h in range(100)]
    assert table.used <= 10_000 + grace.ENTRY and taken == sorted(taken, reverse=True) and sum(taken) == len(table) < 100
    assert table.add(0, b"x" * 300 + b"0", -1, 1, 1, False) and table.columns[4][0] == 2 and table.columns[2][0] == -1
    assert table.add(0, b"other", 1, 1, 1, False) is None and table.columns[5][0]
    assert grace.Table(10).add(1, b"x" * 1000, 1, 1, 1, False)


def test_edges(spark, edges, nothing):
    got = grace.grouped(edges)
    added = [c for c in got.columns if c not in edges.columns]
    assert got.columns[:len(edges.columns)] == edges.columns and [c.lstrip("_") for c in added] == COLUMNS[1:]
    assert Counter((r[0], *r[-4:]) for r in got.select("doc_id", *added).collect()) == brute(EDGES)
    assert grace.distinct(edges).columns == edges.columns
    assert sorted(str(r.doc_id) for r in grace.distinct(edges).select("doc_id").collect()) == sorted(str(k[0]) for k, n in brute(EDGES).items() for _ in range(n) if k[3])
    assert grace.grouped(nothing).count() == 0 and grace.distinct(nothing).count() == 0
    ids = spark.createDataFrame([("b", "t  t"), ("a", "t t"), (None, "t\tt")], "doc_id string, text string")
    assert [(r.doc_id, r.keep_id, r.kept) for r in grace.grouped(ids).orderBy(F.asc_nulls_last("doc_id")).collect()] == [("a", "a", True), ("b", "a", False), (None, "a", False)]
