"""Filters, labels, aggregates, scaling and Arrow functions."""

import math

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowsmith.functions import checks
from rowsmith.operators import aggregates, arrow_ops, filters, labels, scaling


def test_filters(users):
    assert filters.equal_to(users, "age", 30).count() == 5
    assert filters.not_null(users, "age").count() == 8
    assert [r.seq for r in filters.even_rows(users, "seq").orderBy("seq").collect()] == [2, 4, 6, 8]


def test_even_values(spark):
    lists = [("a", list(range(1, 11))), ("edades", [3, 4, 5, 6, 2, 3, 4, 5]), ("odd", [1, 3])]
    df = spark.createDataFrame(lists, "name string, v array<int>")
    found = {
        r.name: (r.kept, r.ordered)
        for r in df.select(
            "name",
            filters.even_values(F.col("v")).alias("kept"),
            filters.even_values(F.col("v"), ordered=True).alias("ordered"),
        ).collect()
    }
    assert found["a"][0] == [2, 4, 6, 8, 10]
    assert found["edades"] == ([4, 6, 2, 4], [2, 4, 4, 6])
    assert found["odd"] == ([], [])


def test_latest_list_replaces_earlier_ones(spark):
    df = spark.createDataFrame(
        [("a", 1, [1]), ("a", 3, [4, 5]), ("a", 2, [9]), ("b", 1, [])],
        "name string, section int, v array<int>",
    )
    found = {r.name: r.v for r in filters.latest_lists(df, "name", "section", "v").collect()}
    assert found == {"a": [4, 5], "b": []}


def test_threshold_label(users, in_order):
    labelled = labels.threshold(users, "age", 35)
    assert in_order(labelled, "age_diferiencia") == [
        "Bajo", "Alto", "Alto", "Bajo", "Alto", "Bajo", "Bajo", "Bajo", "Bajo",
    ]
    own = labels.threshold(users, "age", 35, "lo", "hi", null_label="none")
    assert in_order(own, "age_diferiencia")[:3] == ["lo", "hi", "none"]
    assert labels.threshold_if_present(users, "mb").columns == users.columns


def test_sql_labels(users, in_order):
    labelled = labels.sql_predicates(users, ["age > 30", "user_id = 2"], "Alto", "Bajo")
    assert in_order(labelled, "Categoria_age")[:3] == ["Bajo", "Alto", "Bajo"]
    assert in_order(labelled, "Categoria_user_id")[5:7] == ["Bajo", "Alto"]
    for wrong in ("age>30", "age > 30 or"):
        with pytest.raises(ValueError, match="predicate must read"):
            labels.sql_predicates(users, [wrong], "a", "b")
    with pytest.raises(ValueError, match="numeric: city"):
        labels.sql_predicates(users, ["city = A"], "a", "b")
    with pytest.raises(ValueError, match="two predicates"):
        labels.sql_predicates(users, ["age > 3", "age < 1"], "a", "b")


def test_named_labels(users, in_order):
    labelled = labels.named_predicates(users, {"age": "is_null"}, "y", "n")
    assert in_order(labelled, "Categoria_age")[:4] == ["n", "n", "y", "n"]
    with pytest.raises(ValueError, match="unknown operator"):
        labels.named_predicates(users, {"age": "is_odd"}, "y", "n")


def test_row_operators_run_on_streams(spark, users, tmp_path):
    users.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(users.schema).parquet(f"{tmp_path}/in")
    labelled = labels.threshold(filters.not_null(stream, "age"), "age", 35)
    running = labelled.writeStream.format("memory").queryName("labelled").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    assert spark.table("labelled").filter("age_diferiencia = 'Bajo'").count() == 6


def test_group(users):
    found = aggregates.filter_then_group(users, "age", 30, ["city"], "age")
    assert {r.city: r.Total_Edad for r in found.collect()} == {"A": 60, "B": 90}
    for op, expected in [("mean", 34), ("sum", 170), ("min", 20), ("max", 50), ("count", 5)]:
        found = aggregates.group(users, ["user_id"], "age", op)
        assert {r.user_id: r[f"{op}_age"] for r in found.collect()}[1] == expected
    with pytest.raises(ValueError, match="unknown operator"):
        aggregates.group(users, ["user_id"], "age", "median")


def test_spread(users):
    found = aggregates.spread_map(users, {"age": "sum", "user_id": "mean"})
    assert found.count() == 9
    assert {(r.sum_age, r.mean_user_id) for r in found.collect()} == {(260, 12 / 9)}
    lows = aggregates.spread(users, ["age", "seq"], "min").first()
    assert (lows.min_age, lows.min_seq) == (20, 1)


def test_mean_and_sums(spark, users):
    numbers = spark.createDataFrame([(x,) for x in (10, 20, 30, 40, 50)], "x int")
    assert aggregates.column_mean(numbers, "x").first().mean_x == 30
    with pytest.raises(PySparkException, match="no values"):
        aggregates.column_mean(numbers.filter("x > 99"), "x").collect()
    small = spark.createDataFrame([("a", 5), ("b", 10)], "name string, x int")
    assert aggregates.guarded_sum(small, "x").first().sum_x == 15
    assert aggregates.sum_times(small, "x", 5).first().sum_times_x == 75
    assert aggregates.sum_times(small, "x").first().sum_times_x == 0
    with pytest.raises(PySparkException, match="exceeds"):
        aggregates.guarded_sum(small.union(small).union(small.limit(1)).union(small), "x", 49).collect()


def test_summary_leaves_out_metrics_without_samples(spark):
    df = spark.createDataFrame(
        [("cpu", 1.0), ("cpu", 3.0), ("ram", None)], "metric string, value double"
    )
    found = aggregates.summarize_samples(df, "metric", "value").collect()
    assert [tuple(r) for r in found] == [("cpu", 2.0, 3.0, 1.0, 2)]


def test_minmax(users, in_order):
    scaled = [x and round(x, 6) for x in in_order(scaling.normalize(users, "age"), "age_normalize")]
    third = 0.333333
    assert scaled == [third, 0.666667, None, third, 1, 0, third, third, third]
    replaced = scaling.minmax(users, ["age"], replace=True)
    assert replaced.columns == users.columns and in_order(replaced, "age")[4] == 1


def test_zscore(users, in_order):
    found = in_order(scaling.zscore(users, ["age", "seq"]), "Zscore_age")
    assert found[4] == pytest.approx((50 - 32.5) / 8.864052604279181)
    assert found[2] is None


def test_constant_columns(spark, in_order):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "seq int, x double")
    for scaler in scaling.SCALERS:
        assert in_order(scaling.guarded(df, ["x"], scaler), f"{scaler}_x") == [0, 0, 0]
    found = in_order(scaling.minmax(df, ["x"]), "MinMax_x")
    assert math.isnan(found[0]) and found[2] is None
    assert in_order(scaling.zscore(df, ["x"], on_constant="null"), "Zscore_x") == [None] * 3
    one = df.limit(1)
    assert scaling.guarded(one, ["x"], "scaler").first().scaler_x is None
    assert scaling.minmax(df.filter("seq > 9"), ["x"]).count() == 0
    with pytest.raises(ValueError, match="unknown scaler"):
        scaling.guarded(df, ["x"], "robust")
    with pytest.raises(ValueError, match="on_constant"):
        scaling.minmax(df, ["x"], on_constant="one")


def test_map_batches(users):
    def doubled(t: pa.Table) -> pa.Table:
        return pa.table({"seq": t["seq"], "twice": pc.multiply(t["seq"], 2)})

    found = arrow_ops.map_batches(users, doubled, "seq bigint, twice bigint").collect()
    assert sorted(tuple(r) for r in found) == [(i, 2 * i) for i in range(1, 10)]


def _largest():
    """Made inside a function, so that executors get it by value and need not import this file."""

    def largest(batches):
        most, user = None, None
        for b in batches:
            user = b["user_id"][0].as_py()
            top = pc.max(b["age"]).as_py()
            most = top if most is None or (top is not None and top > most) else most
        yield pa.RecordBatch.from_pydict({"user_id": [user], "age": [most]})

    return largest


def test_map_groups(users):
    narrow = users.select("user_id", F.col("age").cast("bigint"))
    found = arrow_ops.map_groups(narrow, ["user_id"], _largest(), "user_id bigint, age bigint")
    assert {tuple(r) for r in found.collect()} == {(1, 50), (2, 30)}


@pytest.mark.parametrize("key", ["id % 3", "string(id % 3)", "if(id % 3 = 0, null, id % 3)"])
@pytest.mark.parametrize("held, batch", [(1, 7), (65_536, 10_000)])
def test_reduce_groups(spark, monkeypatch, key, held, batch):
    """Keys go on over many batches, before and after the shuffle."""
    df = spark.range(3_000).selectExpr(f"{key} as key", "id % 2 as side", "id as age").repartition(4)

    def top(t: pa.Table) -> pa.Table:
        best = t.group_by(["key", "side"]).aggregate([("age", "max")])
        return pa.table({"key": best["key"], "side": best["side"], "age": best["age_max"]})

    def negated(t: pa.Table) -> pa.Table:
        return t.set_column(2, "age", pc.negate(t["age"]))

    schema = df.schema
    monkeypatch.setattr(arrow_ops, "COMBINE_ROWS", held)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = arrow_ops.reduce_groups(df, ["key", "side"], top, top, schema, negated, schema)
        expected = df.groupBy("key", "side").agg((-F.max("age")).alias("age"))
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_rows_equal_to_the_last():
    t = pa.table({"a": [1.0, math.nan, math.nan], "b": ["x", None, None]})
    assert arrow_ops._same_as_last(t, ["a", "b"]).to_pylist() == [False, True, True]
    assert arrow_ops._same_as_last(t.slice(0, 2), ["b"]).to_pylist() == [False, True]
    assert arrow_ops._same_as_last(pa.table({"a": [1, None, 1]}), ["a"]).to_pylist() == [True, False, True]


def test_checks(users):
    with pytest.raises(ValueError, match="no rows"):
        checks.require_rows(users.filter("seq < 0"))
    assert checks.require_rows(users) is users
    with pytest.raises(ValueError, match="must end in"):
        checks.require_suffix("table.json", [".csv", ".parquet"])


def test_totals_of_nothing_are_zero_and_nan_takes_no_part(spark):
    none = spark.createDataFrame([(None,)], "v double")
    for empty in (none, none.filter("false")):
        assert aggregates.guarded_sum(empty, "v").first()[0] == 0
        assert aggregates.sum_times(empty, "v", 3).first()[0] == 0
    found = scaling.minmax(spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "v double"), ["v"])
    values = [r[1] for r in found.orderBy("v").collect()]
    assert values[:2] == [0.0, 1.0] and values[2] != values[2]


def test_names_that_differ_by_case_only_clash(spark):
    scaled = scaling.minmax(spark.createDataFrame([(1.0,), (2.0,)], "v double"), ["v"])
    with pytest.raises(ValueError, match="already exist"):
        scaling.guarded(scaled, ["v"], "minmax")
