"""What a task sends or holds, and how often the source is read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import checks
from rowsmith.operators import arrow_ops, features, joins, ranks, windows
from rowsmith.operators.windows import Rolling
from rowsmith.plans import flows
from rowsmith.sources import readers, writers
from test_plans import plan


def executions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


@pytest.fixture(scope="module")
def many(spark):
    """12,000 rows in four parts."""
    return spark.range(12_000).selectExpr("id", "id % 3 as k", "id * 7 % 101 as x", "cast(id * 7 % 101 as double) / 8 as y").repartition(4)


# The reach of long windows


@pytest.mark.parametrize("width", [1_500, 5_000])
def test_long_reach_moves_few_rows(many, width):
    feature = [Rolling("x", width, 0, "rolling_sum", "r")]
    cut = windows.rolling(many, feature, ["id"], rows_per_block=3_000)
    text = plan(cut)
    assert "MapInArrow" in text
    assert sorted(cut.select("id", "r").collect()) == sorted(windows.rolling(many, feature, ["id"]).select("id", "r").collect())
    short = windows.rolling(many, [Rolling("x", 500, 0, "rolling_sum", "r")], ["id"], rows_per_block=3_000)
    assert "MapInArrow" not in plan(short) and "WindowGroupLimit" in plan(short)


@pytest.mark.parametrize("n", [1_500, 20_000])
@pytest.mark.parametrize("last", [False, True])
def test_tasks_send_the_outermost_rows_only(spark, n, last):
    rows = spark.range(200_000).selectExpr("id % 2 as b", "id", "hash(id) as v").repartition(3)
    sent = arrow_ops.outermost_rows(rows, ["b"], ["id"], n, last)
    assert sent.count() <= 3 * 2 * n
    bound = F.col("id") >= 200_000 - 2 * n if last else F.col("id") < 2 * n
    assert sent.filter(bound).count() == 2 * n


def test_outermost_rows_order_as_spark_does(spark, monkeypatch):
    monkeypatch.setattr(arrow_ops, "ROWS_KEPT", 20)
    draw = random.Random(4)
    pick = lambda *v: draw.choice([None, *v])
    rows = [
        (pick("a", "b"), pick(1.5, -0.0, 0.0, float("nan"), float("-inf")), pick("x", "é", ""), pick(True, False),
         pick(dt.date(2020, 1, 1), dt.date(1960, 1, 1)), i)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "g string, d double, s string, b boolean, t date, i int").repartition(3)
    order = ["d", "s", "b", "t", "i"]
    for last in (False, True):
        from pyspark.sql import Window

        spec = Window.partitionBy("g").orderBy(*((F.desc(c) if last else F.asc(c)) for c in order))
        top = lambda t: sorted(r.i for r in t.withColumn("n", F.row_number().over(spec)).filter("n <= 9").collect())
        sent = arrow_ops.outermost_rows(df, ["g"], order, 9, last)
        assert top(sent) == top(df) and sent.count() < 200
    packed = df.withColumn("a", F.array("i"))
    assert arrow_ops.outermost_rows(packed, ["g"], ["a"], 1).count() == 300


# One measuring pass


def test_cut_operators_measure_in_one_pass(spark, many):
    def measured(build):
        before = executions(spark)
        build()
        return executions(spark) - before

    feature = [Rolling("x", 3, 0, "rolling_sum", "r")]
    doubles = [Rolling("y", 3, 0, "rolling_sum", "r")]
    for rows in (None, 900):
        assert measured(lambda: windows.rolling(many, feature, ["id"], rows_per_block=rows)) == 1
        assert measured(lambda: windows.rolling(many, doubles, ["id"], ["k"], rows)) == 1
        assert measured(lambda: windows.cumulative_sum(many, ["x", "y"], ["id"], ["k"], rows)) == 1
        assert measured(lambda: windows.rolling_cumulative(many, doubles, ["id"], ["k"], rows)) == 1
        assert measured(lambda: ranks.rank(many, ["x"], "dense", rows)) == 1
        assert measured(lambda: features.feature_bundle(many, ["x"], [3], [1], "dense", ["id"], ["k"], rows)) == 3


# Equal rows of a large key


def test_equal_rows_of_a_large_key_are_spread(spark):
    left = spark.range(20_500).selectExpr("if(id < 20000, 7, id) as k", "'same' as v").repartition(6, "k")
    right = spark.range(100).selectExpr("id % 50 + 0 as k", "id as w")
    joined = joins.join_partitioned(left, right, "k", num_partitions=16, rows_per_task=1_000)
    sizes = [r[1] for r in joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 16_000 and len(sizes) >= 5


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_maps_and_odd_numbers_pass_through_a_salted_join(spark, how):
    left = spark.range(120).selectExpr(
        "if(id < 100, 1, id) as k", "map('b', id % 3, 'a', 0) as m", "if(id % 2 = 0, 0.0D, -0.0D) as d",
        "array(named_struct('z', map(1, id % 2))) as deep",
    )
    right = spark.range(6).selectExpr("id as k", "map('w', cast(null as string)) as n", "cast('NaN' as float) as f")
    text = ["k", "to_json(m) as m", "cast(d as string) as d", "to_json(deep) as deep", "to_json(n) as n", "cast(f as string) as f"]
    for columns in (["k", "m", "d"], ["k", "m", "d", "deep"]):
        side = left.select(*columns)
        shown = [t for t in text if t.split()[-1] in columns or t.split()[-1] in ("n", "f")]
        plain = joins.join(side, right, "k", how).selectExpr(*shown)
        salted = joins.join_partitioned(side, right, "k", how, 4, rows_per_task=10)
        key = lambda t: sorted(map(str, t.collect()))
        normal = lambda t: [s.replace('{"a":0,', "{").replace(',"a":0}', "}") for s in key(t)]
        assert sorted(normal(salted.selectExpr(*shown))) == sorted(normal(plain))


# Batches, row groups, rows


def test_batches_have_the_size_asked_for(spark):
    rows = spark.range(0, 1_000, 1, 3)
    sizes = arrow_ops.map_batches(rows, lambda t: t.slice(0, 1).append_column("n", [[t.num_rows]]), "id bigint, n bigint", batch_size=64)
    got = [r.n for r in sizes.collect()]
    assert sum(got) == 1_000 and max(got) == 64 and sum(n < 64 for n in got) <= 3
    assert arrow_ops.map_batches(rows, lambda t: t, "id bigint", batch_size=1).count() == 1_000
    assert arrow_ops.map_batches(rows.limit(0), lambda t: t, "id bigint", batch_size=5).count() == 0
    with pytest.raises(ValueError, match="batch_size"):
        arrow_ops.map_batches(rows, lambda t: t, "id bigint", batch_size=0)


def test_rows_per_group_and_counted_writes(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    assert writers.write_counted(spark.range(0, 1_050, 1, 2), path, rows_per_group=100) == 1_050
    groups = readers.row_groups(spark, path).collect()
    assert sum(r.rows for r in groups) == 1_050 and max(r.rows for r in groups) == 100 and len(groups) == 12
    assert spark.read.parquet(path).count() == 1_050
    assert writers.write_counted(spark.range(0), path) == 0
    with pytest.raises(ValueError, match="ignore"):
        writers.write_counted(spark.range(1), path, mode="ignore")
    with pytest.raises(ValueError, match="at least 1"):
        writers.write_parquet(spark.range(1), path, rows_per_group=0)


def test_flows_refuse_empty_sources_in_their_own_job(spark, tmp_path):
    source, none, target = (f"{tmp_path}/{n}.parquet" for n in ("source", "none", "target"))
    spark.createDataFrame([("a", 1, 2), ("b", 1, 3)], "g string, w int, v int").write.parquet(source)
    spark.read.parquet(source).limit(0).write.parquet(none)
    before = executions(spark)
    flows.filter_group(spark, source, target, "w", 1, ["g"], "v", require_rows=True)
    assert executions(spark) - before == 1
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(Exception, match="the table has no rows"):
        flows.filter_group(spark, none, target, "w", 1, ["g"], "v", require_rows=True)
    with pytest.raises(Exception, match="the table has no rows"):
        flows.join_tables(spark, [source, none], f"{tmp_path}/j.parquet", "g", require_rows=True)
    flows.filter_group(spark, none, target, "w", 1, ["g"], "v")
    df = spark.read.parquet(source)
    asserted = checks.asserting_rows(df, df)
    assert asserted.schema == df.schema and sorted(asserted.collect()) == sorted(df.collect())


def test_latest_list_of_a_tie_is_always_the_same(spark):
    rows = [("n", 2, [1]), ("n", 2, [5, 6]), ("n", 1, [9]), ("n", None, [8]), ("m", None, [3])]
    from rowsmith.operators import filters

    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, "name string, section int, v array<int>").coalesce(1)
        got = {r.name: r.v for r in filters.latest_lists(df, "name", "section", "v").collect()}
        assert got["n"] in ([1], [5, 6])
        assert got == {**got, "m": None}
        first = first if order is not rows else got  # noqa: F821
        assert got == first
