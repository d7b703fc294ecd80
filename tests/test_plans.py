"""The shape of physical plans: what is read, what is shuffled, what is broadcast."""

import contextlib
import glob
import io
import re

import pytest

from rowsmith.operators import joins, ranks, scaling, windows
from rowsmith.operators.windows import Rolling
from rowsmith.plans.queries import QUERIES, events, table
from rowsmith.sources import writers

SMALL = "/root/testdata/sf0.001"
EVENTS = "/root/testdata/sf0.01"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


def test_flagship_shuffles_rows_once(spark):
    text = plan(QUERIES["multi_stage_etl"](spark, SMALL))
    assert exchanges(text) == ["hashpartitioning"]
    read = "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double"
    assert f"ReadSchema: struct<{read}>" in text
    unused = plan(QUERIES["multi_stage_etl_source_column"](spark, SMALL))
    assert "Window" not in unused


def test_filter_reaches_the_scan(spark):
    text = plan(QUERIES["filter_group_sum"](spark, SMALL))
    assert "EqualTo(p_size,30)" in text and "ReadSchema: struct<p_brand:string,p_size:int>" in text


def test_features_of_one_key_share_a_shuffle_and_a_sort(spark):
    wanted = windows.rolling_list(["cents", "event_id"], [3, 5], [1, 0], "rolling_mean")
    df = windows.rolling(events(spark, SMALL), wanted, ["ts", "event_id"], ["user_id"])
    assert len(exchanges(plan(df))) == 1
    both = windows.rolling_cumulative(
        events(spark, SMALL), wanted, ["ts", "event_id"], ["user_id"]
    )
    assert len(exchanges(plan(both))) == 1 and plan(both).count("Sort [") == 1


@pytest.mark.parametrize("keys", [[], ["event_type"]])
def test_large_groups_are_spread_over_blocks(spark, keys):
    df = windows.rolling(
        events(spark, EVENTS), [Rolling("cents", 3, 1)], ["ts", "event_id"], keys, 500
    )
    text = plan(df)
    above_union = text[: text.index("Union")]
    assert re.findall(r"Exchange (\w+)\(([^)]*__block)", above_union)
    assert "SinglePartition" not in above_union
    assert text.count("WindowGroupLimit") == 2


def test_large_ranks_are_spread_over_blocks(spark):
    df = ranks.rank(events(spark, EVENTS), ["cents"], "average", 1_000)
    frames = re.findall(r"windowspecdefinition\((\w+)", plan(df))
    assert "__block" in frames and "__value" not in frames


def test_scaling_moves_no_rows(spark):
    df = scaling.minmax(table(spark, SMALL, "lineitem"), ["l_quantity", "l_extendedprice"])
    text = plan(df)
    assert "Join" not in text
    assert set(exchanges(text)) == {"SinglePartition"}
    read = set(re.findall(r"ReadSchema: (\S+)", text))
    assert "struct<l_quantity:double,l_extendedprice:double>" in read


def test_join_without_large_keys_is_one_join(spark):
    left = events(spark, SMALL).select("event_id", "user_id")
    right = table(spark, SMALL, "customer").selectExpr("c_custkey as user_id", "c_name")
    assert plan(joins.join(left, right, "user_id", "outer")).count("Join") == 1
    hashed = plan(joins.join_partitioned(left, right, "user_id", num_partitions=6))
    assert hashed.count(", 6), REPARTITION_BY_NUM") == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows_or_runs_python_row_by_row(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "NestedLoop", "BatchEvalPython"):
        assert operator not in text


@pytest.fixture
def small_skew_limits(spark):
    """Thresholds under which the test tables count as skewed."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_events(spark):
    """A third of the events share one user."""
    return events(spark, EVENTS).selectExpr(
        "event_id", "if(event_id < 3400, 7, user_id) as user_id", "cents"
    ).repartition(8)


@pytest.mark.parametrize("how", ["inner", "outer"])
def test_skewed_join_keys_are_split(spark, small_skew_limits, how):
    right = table(spark, EVENTS, "customer").selectExpr("c_custkey as user_id", "c_name")
    df = joins.join(skewed_events(spark), right, "user_id", how, rows_per_task=1_000)
    assert df.count() == (10_000 if how == "inner" else 11_350)
    assert "skew=true" in plan_after(df)


def test_repeated_rank_values_are_split(spark, small_skew_limits):
    df = ranks.rank(skewed_events(spark), ["user_id"], "dense")
    assert "skew=true" in plan_after(df)


def plan_after(df):
    df.collect()
    return plan(df)


def test_frequent_value_is_written_by_several_tasks(spark, small_skew_limits, tmp_path):
    df = spark.range(0, 10_000, 1, 8).selectExpr("id", "if(id % 10 < 7, 'hot', 'cold') as kind")
    path = writers.write_partitioned(df, f"{tmp_path}/k.parquet", ["kind"])
    assert len(glob.glob(f"{path}/kind=hot/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 10_000
