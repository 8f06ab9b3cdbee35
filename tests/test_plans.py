"""Plan-shape guards for scale: partial aggregation before every shuffle of
bars, no single-partition step over unbounded data, top-1 windows limited
before the shuffle, broadcasts only where bounded."""
from __future__ import annotations

import re

import pytest

from barsmith.plans import registry
from tests.conftest import SF0001


def plan(spark, key):
    df = registry.QUERIES[key](spark, SF0001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["t1_winner", "t3_winner", "weekly_returns", "portfolio_detail"])
def test_anchor_aggregates_are_partial(spark, key):
    p = plan(spark, key)
    assert "partial_min_by" in p or "partial_max_by" in p
    assert "Window [row_number()" not in p  # no window + self-join form


@pytest.mark.parametrize("key", ["relative_increase", "monthly_cagr"])
def test_rank_reads_stored_scores_and_joins_nothing_on_them(spark, key):
    p = plan(spark, key)
    # the input was evaluated once, before: what is left reads the stored scores
    assert "FileScan" not in p and "Scan ExistingRDD" in p
    value = {"relative_increase": "relative_increase", "monthly_cagr": "monthly_cagr"}[key]
    assert not re.search(rf"Join \[[^\]]*{value}#", p) and "Join [_cell" in p
    # the only single-partition exchange feeds the counts of the cells, two a split point at most
    singles = [m.start() for m in re.finditer(r"Exchange SinglePartition", p)]
    assert singles and all("_cell" in p[s - 400:s + 400] for s in singles)


def test_a_value_of_many_rows_takes_part_in_no_window(spark):
    from barsmith.operators.ranking import global_rank
    df = spark.range(30_000).selectExpr("id", "case when id % 3 = 0 then 7.0D when id % 3 = 1 then null else cast(id as double) end as v")
    ranked = global_rank(df, "v", num_partitions=8)
    cells = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [rank(v" in cells and "Filter" in cells
    per = {r["rank"]: r.n for r in ranked.groupBy("rank").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert sorted(per.values())[-2:] == [10_000, 10_000] and len(per) == 10_002


@pytest.mark.parametrize("key", ["bars", "validate_valid", "weekly_returns", "portfolio_detail"])
def test_first_and_last_trades_aggregate_by_hash(spark, key):
    assert "SortAggregate" not in plan(spark, key)


def test_trades_are_grouped_by_key_and_named_afterwards(spark):
    p = plan(spark, "bars")
    below = p[p.index("partial_min_by"):]
    assert "hashpartitioning(key" in p and "conv(" not in below


def test_the_symbol_of_a_slice_reaches_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_suppkey,1\)", plan(spark, "inspect_symbol"))


def test_first_last_window_is_one_window_without_join(spark):
    p = plan(spark, "first_last_close_window")
    assert "SortMergeJoin" not in p and "HashJoin" not in p and p.count("+- Window") == 1


@pytest.mark.parametrize("key", ["t1_winner", "t3_winner"])
def test_winners_rank_nothing(spark, key):
    p = plan(spark, key)
    assert "rangepartitioning" not in p and "Window" not in p


def test_top1_windows_limit_before_shuffle(spark):
    p = plan(spark, "ticker_vetting")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_only_lookable_listings_reach_the_lookup(spark):
    p = plan(spark, "ticker_vetting")
    assert p.count("Union") >= 1 and "RLIKE" in p


def test_bars_of_valid_tickers_are_cut_down_before_the_aggregate(spark):
    p = plan(spark, "bars_for_valid_tickers")
    assert p.index("min_by(p") < p.index("LeftSemi") and "conv(" not in p[p.index("partial_min_by"):p.index("LeftSemi")]  # the plan prints from the top: the join lies below


@pytest.mark.parametrize("key", ["raw_roundtrip", "company_list"])
def test_scratch_copies_do_not_stay(spark, key):
    import os

    from barsmith.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert registry.QUERIES[key](spark, SF0001).count() > 0
    assert not [n for n in set(os.listdir(folder)) - before if n.startswith(("raw-", "companies-"))]


def test_scans_prune_columns(spark):
    p = plan(spark, "t1_winner")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "l_comment" not in scan and "l_tax" not in scan and "l_discount" not in scan


def test_portfolio_uses_scalar_subquery_not_join(spark):
    p = plan(spark, "portfolio_detail")
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
