"""As-of lookups and symbol slices against brute force."""
from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from barsmith.operators.asof import as_of
from barsmith.sources.bar_store import read_slice, write_clustered
from tests.conftest import make_raw

D0 = dt.date(2020, 1, 1)


def brute(rows, records):
    out = []
    for s, d, n in rows:
        known = [(k or dt.date.min, v, k) for r, k, v in records if r == s and s is not None and d is not None and (k or dt.date.min) <= d]
        latest = [x for x in known if x[0] == max(k for k, *_ in known)]
        # of one date the first by value, NULLs last
        best = min(latest, key=lambda x: (x[1] is None, x[1] or 0)) if latest else None
        out.append((s, d, n, best[2] if best else None, best[1] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("unit", ["month", "quarter", "year"])
def test_as_of_against_brute_force(spark, unit):
    rnd = random.Random(3)
    day = lambda span: D0 + dt.timedelta(days=rnd.randrange(span))
    keys = ["HOT"] * 5 + ["A", "B", "C", None]
    records = [(rnd.choice(keys), rnd.choice([None, *[day(1500)] * 12]), rnd.choice([None, 1, 2, 3])) for _ in range(120)]
    rows = [(rnd.choice([*keys, "UNKNOWN"]), rnd.choice([None, *[day(1600)] * 15]), i) for i in range(500)]
    rows += [(s, D0 - dt.timedelta(days=5000), -1) for s in ("HOT", "A")] + [rows[7]] * 3
    got = as_of(spark.createDataFrame(rows, "symbol string, day date, n int").repartition(5),
                spark.createDataFrame(records, "symbol string, known date, v int"), "symbol", "day", "known", prefer=[F.col("v").asc_nulls_last()], unit=unit)
    assert got.columns == ["symbol", "day", "n", "known", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, records)


def test_a_record_of_nulls_is_not_no_record(spark):
    rows = spark.createDataFrame([("A", D0)], "symbol string, day date")
    records = spark.createDataFrame([("A", dt.date(2019, 1, 1), 5), ("A", dt.date(2019, 6, 1), None)], "symbol string, known date, v int")
    assert [tuple(r) for r in as_of(rows, records, "symbol", "day", "known").collect()] == [("A", D0, dt.date(2019, 6, 1), None)]
    assert as_of(rows, records.limit(0), "symbol", "day", "known").collect()[0].known is None
    assert as_of(rows.limit(0), records, "symbol", "day", "known").count() == 0


def test_a_hot_key_is_worked_on_in_slices(spark):
    rows = spark.range(100).selectExpr("'HOT' as symbol", "date_add(date'2020-01-01', cast(id * 11 as int)) as day")
    plan = as_of(rows, rows.withColumnRenamed("day", "known"), "symbol", "day", "known")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [last(_record" in line]
    assert windows and all("[_by" in w and "_slice" in w for w in windows)


def rows_scanned(df):
    """Rows that the Parquet reader handed out: those of row groups it did not skip."""
    df._jdf.queryExecution().executedPlan().execute().count()
    todo, found = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan parquet"):
            found += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_a_slice_reads_the_row_groups_of_its_symbols(spark, scratch):
    import pyarrow.parquet as pq

    symbols = [f"S{i:03d}" for i in range(0, 400, 2)]  # the odd ones lie within the ranges, yet nowhere
    days = [str(D0 + dt.timedelta(days=i)) for i in range(50)]
    raw = make_raw(spark, [{"symbol": s, "date": d} for s in symbols for d in days] + [{"symbol": "HOT", "date": str(D0 + dt.timedelta(days=i))} for i in range(5000)])
    path = os.path.join(scratch, "clustered")
    write_clustered(raw, path, files=8, row_group_bytes=4096)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    groups = [pq.ParquetFile(os.path.join(path, f)).metadata for f in files]
    n_groups = sum(m.num_row_groups for m in groups)
    bounds = [(g.column(0).statistics.min, g.column(0).statistics.max) for m in groups for g in (m.row_group(i) for i in range(m.num_row_groups))]
    assert n_groups > 50 and bounds == sorted(bounds)  # ranges follow each other, file after file
    hot = sum(any(m.row_group(i).column(0).statistics.max == "HOT" for i in range(m.num_row_groups)) for m in groups)
    assert hot >= 2  # a symbol of a third of all bars is cut over files
    one = read_slice(spark, path, ["S100"])
    assert one.count() == 50 and rows_scanned(one) <= 1000
    dated = read_slice(spark, path, ["HOT"], "2020-02-01", "2020-02-29")
    assert dated.count() == 29 and rows_scanned(dated) <= 1000
    # a symbol inside the ranges that no row holds: the statistics can't tell, the bloom filter does
    assert any(lo < "S101" < hi for lo, hi in bounds)
    assert rows_scanned(read_slice(spark, path, ["S101"])) == 0
