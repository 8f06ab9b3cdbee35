"""The filter interaction audit against brute force."""
from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from barsmith.llm import filter_audit
from tests.llm.conftest import EDGES

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(docs):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, _ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and least[t] < d}
        out.append({k for k, v in own.items() if v})
    return out


def brute(docs, labels, names="ABCDE"):
    good, toxic = ({d for d, *x in labels if x[i] == 1 and d is not None} for i in (0, 1))
    failed, rows, total = fails(docs), {}, Counter()
    for part in {p or "" for *_, p in docs}:
        for order in map("".join, permutations(names)):
            alive = {i for i, (*_, p) in enumerate(docs) if (p or "") == part}
            gone = set()
            for step, f in enumerate(order, 1):
                failing = {i for i in alive | gone if f in failed[i]}
                out = failing & alive
                lost = [sum(docs[i][0] in ids for i in out) for ids in (good, toxic)]
                alone = sum(failed[i] == {f} for i in failing)
                alive, before = alive - out, len(failing & gone)
                gone |= out
                rows[part, order, step] = (len(alive), len(out), before, alone, *lost)
                total[part, f] += len(out)
    return sorted((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items())


def corpus(n):
    rnd = random.Random(n)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(n):
        w = rnd.choices(words, k=rnd.choice([3, 49, 50, 60, 120]))
        t = " ".join(w) + rnd.choice(["", "", " $", " LOUD" * 9, "É" * 40])
        docs.append((i, rnd.choice([t, "the same text", "THE SAME $ text"]), rnd.choice(["hot", "hot", "a", None, "", "b"])))
    docs += [(None, "the same text", "a"), (None, None, None), (3, docs[3][1], "b"), (5 * n, None, "only nulls")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, n, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = corpus(150)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == COLUMNS and dict(got.dtypes)["shapley"] == "bigint"
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_what_steps_remove_adds_up(spark):
    docs, labels = corpus(60)
    got = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    shares = filter_audit.shapley_share(got, "ABCDE").groupBy("part").agg(F.round(F.sum("share"), 6).alias("s")).collect()
    failed = Counter()
    for (*_, part), f in zip(docs, fails(docs)):
        failed[part or ""] += bool(f)
    assert {r.part: r.s for r in shares} == dict(failed)


def test_no_text_takes_part_in_the_joins(spark):
    docs, labels = corpus(40)
    rows = filter_audit.numbered(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                                 filter_audit.rules(), "E", "doc_id", "text", "source")
    assert rows.columns == ["row", "part", "good", "toxic", "fails"] and rows.select("row").distinct().count() == len(docs)


def test_edges(spark, edges, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = edges.withColumnRenamed("part", "source")
    assert sorted(map(tuple, filter_audit.audit(docs, none).collect())) == brute([(d, t, "part") for d, t in EDGES], [])
    assert filter_audit.audit(nothing.withColumnRenamed("part", "source"), none).count() == 0
