"""Physical-plan facts the design relies on."""

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_SMALL


def plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["top_of_book", "dedup_first", "curate_ticks", "tick_tape"])
def test_window_group_limit(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["top_gainers", "top_losers", "volume_leaders", "top_volume"])
def test_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["trading_day_flags", "in_session", "gate_fundamentals_by_chunk"])
def test_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(spark, name) or "BroadcastNestedLoopJoin" in plan(spark, name)


@pytest.mark.parametrize("name", ["curate_daily_ohlcv", "session_vwap", "alert_parse", "parse_ticks", "l2_at"])
def test_no_python_in_hot_path(spark, name):
    p = plan(spark, name)
    assert "Python" not in p and "ArrowEval" not in p


def test_flagship_limits_groups_below_the_shuffle(spark):
    p = plan(spark, "curate_daily_ohlcv").split("== Initial Plan ==")[0]
    assert p.count("Exchange hashpartitioning") == 3  # bars by (symbol, date), actions by their key, then both by symbol
    assert p.count("FileScan parquet") == 2
    assert "Join" not in p
    below = p[p.index("Exchange hashpartitioning(date"):] if "Exchange hashpartitioning(date" in p else p
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize("name, mark", [("ticks", "PartitionFilters: [isnotnull(date"), ("top_volume", "PushedFilters: [IsNotNull(date)")])
def test_curated_scans_prune(spark, name, mark):
    p = plan(spark, name)
    assert "Scan ExistingRDD" not in p and mark in p


def test_curated_scan_reads_named_columns_only(spark):
    p = plan(spark, "spread_imbalance")
    assert "Scan ExistingRDD" not in p
    assert "bid_sz_1:bigint" in p and "bid_px_2" not in p


def test_projection_pruned(spark):
    p = plan(spark, "curate_ticks")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["write_receipts", "quarantine_rejects", "quarantine_parse_errors", "classify_symbol"])
def test_messages_of_all_channels_are_decoded_once(spark, name):
    assert plan(spark, name).split("== Initial Plan ==")[0].count("from_json(") == 1


def test_sql_binds_parameters(spark):
    assert queries()["sql"](spark, SF_SMALL).count() > 0
