"""Cut windows equal plain ones, for any window, lag, block size and spread of keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowsmith.operators import blocks, ranks, windows
from rowsmith.operators.windows import Rolling


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows, a third of them of one key, another third of the null key; ties in the first order column."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else rng.choice("abcdef")
        day = dt.date(2024, 1, 1) + dt.timedelta(days=min(i // 40, 9))
        x = None if rng.random() < 0.1 else rng.randint(-5, 20)
        rows.append((i, key, day if rng.random() < 0.95 else None, x))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id int, key string, day date, x int").repartition(3).cache()


def by_id(df):
    return {r["id"]: r for r in df.collect()}


@settings(
    max_examples=12, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    window=st.integers(1, 40),
    lag=st.integers(-30, 30),
    rows=st.sampled_from([1, 4, 25, 150]),
    op=st.sampled_from(["mean", "sum", "min", "max"]),
    keyed=st.booleans(),
)
def test_rolling_equals_plain_window(skewed, window, lag, rows, op, keyed):
    keys, lag = (["key"], abs(lag)) if keyed else ([], lag)
    feature = [Rolling("x", window, lag, f"rolling_{op}", "r")]
    cut = windows.rolling(skewed, feature, ["day", "id"], keys, rows)
    plain = windows.rolling(skewed, feature, ["day", "id"], keys)
    assert by_id(cut) == by_id(plain)


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("window, lag", [(40, 0), (2, 35), (3, -50)])
def test_windows_longer_than_several_blocks(skewed, monkeypatch, keys, window, lag):
    lag = abs(lag) if keys else lag
    feature = [Rolling("x", window, lag, "rolling_sum", "r")]
    plain = by_id(windows.rolling(skewed, feature, ["day", "id"], keys))
    monkeypatch.setattr(windows, "_cut_for", lambda df, k, o, rows, reach: blocks.find_cuts(df, k, o, rows))
    cut = windows.rolling(skewed, feature, ["day", "id"], keys, 6)
    assert by_id(cut) == plain


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("rows", [1, 30, 150])
def test_running_totals_equal_plain_window(skewed, keys, rows):
    cut = windows.cumulative_sum(skewed, ["x"], ["day", "id"], keys, rows)
    assert by_id(cut) == by_id(windows.cumulative_sum(skewed, ["x"], ["day", "id"], keys))


def test_rolling_cumulative_equals_plain_window(skewed):
    feature = [Rolling("x", 3, 2, "rolling_sum")]
    cut = windows.rolling_cumulative(skewed, feature, ["day", "id"], ["key"], 20)
    assert by_id(cut) == by_id(windows.rolling_cumulative(skewed, feature, ["day", "id"], ["key"]))


@pytest.mark.parametrize("method", ["average", "dense", "min"])
def test_rank_of_strings_equals_plain(skewed, method):
    cut = ranks.rank(skewed, ["key"], method, 10)
    assert by_id(cut) == by_id(ranks.rank(skewed, ["key"], method))


def test_only_large_groups_are_cut(skewed):
    cuts = blocks.find_cuts(skewed, ["key"], ["id"], 150)
    assert {r["key"] for r in cuts.table.collect()} == {"hot", None}
    blocked = blocks.assign_blocks(skewed, cuts)
    small = blocked.filter("key not in ('hot')")
    assert small.agg(F.max(blocks.BLOCK)).first()[0] == 0
    assert blocked.filter("key = 'hot'").select(blocks.BLOCK).distinct().count() > 1
    assert blocks.find_cuts(skewed, ["key"], ["id"], 10_000) is None
    assert blocks.find_cuts(skewed, [], ["id"], 600) is None


def test_blocks_follow_the_order(skewed):
    cuts = blocks.find_cuts(skewed, [], ["day", "id"], 50)
    blocked = blocks.assign_blocks(skewed, cuts)
    spans = (
        blocked.groupBy(blocks.BLOCK)
        .agg(F.min(F.struct("day", "id")).alias("lo"), F.max(F.struct("day", "id")).alias("hi"))
        .orderBy(blocks.BLOCK)
    )
    previous = spans.withColumn("before", F.lag("hi").over(Window.orderBy(blocks.BLOCK)))
    assert previous.filter("before >= lo").count() == 0
    assert spans.count() > 6


def test_number_of_blocks_is_bounded(skewed, monkeypatch):
    monkeypatch.setattr(blocks, "MAX_BLOCKS", 5)
    cuts = blocks.find_cuts(skewed, [], ["id"], 1)
    assert cuts.longest <= 5
    keyed = blocks.find_cuts(skewed, ["key"], ["id"], 1)
    assert sum(len(r["__points"]) for r in keyed.table.collect()) <= 10
    feature = [Rolling("x", 7, 3)]
    cut = windows.rolling(skewed, feature, ["id"], ["key"], 1)
    assert by_id(cut) == by_id(windows.rolling(skewed, feature, ["id"], ["key"]))


@pytest.mark.parametrize("op", ["sum", "mean", "min", "max"])
@pytest.mark.parametrize("dtype", ["int", "bigint", "decimal(9,2)", "double"])
def test_windows_in_runs_equal_sliding_frames(spark, op, dtype):
    rows = [(i, None if i % 17 == 0 else Decimal(i * 7 % 31)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, x decimal(9,2)").withColumn("x", F.col("x").cast(dtype))
    feature = [Rolling("x", 6, 2, f"rolling_{op}", "r")]
    narrow = windows.rolling(df, feature, ["id"])
    for block in (None, 15):
        wide = windows.rolling(df, feature, ["id"], rows_per_block=block, runs_from=2)
        assert wide.schema["r"].dataType == narrow.schema["r"].dataType
        assert by_id(wide) == by_id(narrow)


@pytest.mark.parametrize("lag", [0, 3, -2])
def test_runs_of_any_length_and_lag(spark, lag):
    df = spark.range(50).selectExpr("int(id) as id", "id * id % 23 as x")
    for window in (1, 2, 7, 49, 50, 51):
        feature = [Rolling("x", window, lag, "rolling_sum", "r")]
        near, far = (windows.rolling(df, feature, ["id"], runs_from=n) for n in (100, 1))
        assert by_id(near) == by_id(far)


@pytest.mark.parametrize("window", [64, 65])
def test_large_exact_values(spark, window):
    """Totals of the group overflow, those of a window don't; and beyond 2**53 doubles would round."""
    df = spark.range(300).selectExpr("int(id) as id", "cast(9e35 as decimal(38,0)) as d", "9007199254740993 + id as n")
    features = [Rolling("d", window, 0, "rolling_sum", "d_sum"), Rolling("n", window, 0, "rolling_mean", "n_mean")]
    near, far = (windows.rolling(df, features, ["id"], runs_from=n).orderBy("id").collect() for n in (100, 2))
    assert near == far
    assert near[-1].d_sum == window * 9 * 10**35
    exact = sum(9007199254740993 + i for i in range(300 - window, 300))
    assert near[-1].n_mean == float(exact) / window


@pytest.mark.parametrize(
    "order", ["timestamp", "timestamp_ntz", "date", "double", "decimal(12,3)", "string", "binary", "tinyint"]
)
def test_order_columns_of_any_type(spark, order):
    """The leading order column has ties, nulls and, as a double, NaN and both zeros."""
    seconds = "1730000000 + (id * 37) % 11 * 3600"
    leading = {
        "timestamp": f"timestamp_seconds({seconds})",
        "timestamp_ntz": f"timestamp_seconds({seconds})",
        "date": "date_add(date'2024-10-20', int(id * 37 % 11))",
        "double": "case id % 5 when 0 then double('NaN') when 1 then -0.0D when 2 then 0.0D else id % 7 end",
    }.get(order, "id * 37 % 11")
    if order == "binary":
        leading = "string(id * 37 % 11)"
    df = spark.range(200).selectExpr(
        "int(id) as id",
        f"cast(if(id % 13 = 0, null, {leading}) as {order}) as o",
        "cast(id % 2 as decimal(5,1)) as key",
        "int(id % 9) as x",
    )
    feature = [Rolling("x", 5, 2, "rolling_sum", "r")]
    for keys in ([], ["key"]):
        assert blocks.find_cuts(df, keys, ["o", "id"], 20) is not None
        cut = windows.rolling(df, feature, ["o", "id"], keys, 20).drop("o")
        assert by_id(cut) == by_id(windows.rolling(df, feature, ["o", "id"], keys).drop("o"))


def test_blocks_do_not_depend_on_the_session_time_zone(spark):
    df = spark.range(300).selectExpr(
        "int(id) as id", "timestamp_seconds(1730600000 + id * 60) as o", "int(id % 9) as x"
    )
    feature = [Rolling("x", 5, 2, "rolling_sum", "r")]
    plain = by_id(windows.rolling(df, feature, ["o"]).drop("o"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert by_id(windows.rolling(df, feature, ["o"], (), 20).drop("o")) == plain
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
