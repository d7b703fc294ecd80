"""Joins, including keys too large for one task."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.functions.checks import require_two_tables
from rowsmith.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(2, "p"), (3, "q"), (None, "r")], "k int, x string")
    return left, right


def rows(df):
    return Counter(map(tuple, df.collect()))


EXPECTED = {
    "inner": [(2, "b", "p"), (2, "c", "p")],
    "left": [(1, "a", None), (2, "b", "p"), (2, "c", "p"), (None, "d", None)],
    "right": [(2, "b", "p"), (2, "c", "p"), (3, None, "q"), (None, None, "r")],
    "outer": [
        (1, "a", None), (2, "b", "p"), (2, "c", "p"), (3, None, "q"),
        (None, "d", None), (None, None, "r"),
    ],
}


@pytest.mark.parametrize("how", EXPECTED)
@pytest.mark.parametrize("limit", [None, 1])
@pytest.mark.parametrize("partitions", [None, 3])
def test_join_types(sides, how, limit, partitions):
    plain = joins.join(*sides, "k", how, rows_per_task=limit)
    assert plain.columns == ["k", "x", "x_right"]
    assert rows(plain) == Counter(EXPECTED[how])
    hashed = joins.join_partitioned(*sides, "k", how, partitions, rows_per_task=limit)
    assert hashed.columns == ["k", "x", "x_right"]
    assert rows(hashed) == Counter(EXPECTED[how])


@pytest.mark.parametrize("limit", [None, 1])
def test_both_keys_can_be_kept(sides, limit):
    kept = joins.join(*sides, ["k"], "full", coalesce_keys=False, rows_per_task=limit)
    assert kept.columns == ["k", "x", "x_right", "k_right"]
    assert (None, None, "q", 3) in rows(kept)
    assert (1, "a", None, None) in rows(kept)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("heavy", ["left", "right", "both"])
def test_large_keys_equal_plain_join(spark, how, heavy):
    def side(is_heavy, offset, n):
        key = F.when(F.col("id") % 3 == 0, 7 if is_heavy else -offset).otherwise(F.col("id") % 11 + offset)
        return spark.range(n).select(
            F.when(F.col("id") % 10 != 9, key).alias("k"), F.col("id").alias(f"v{offset}")
        )

    left = side(heavy != "right", 1, 300).repartition(5)
    right = side(heavy != "left", 4, 90).repartition(3)
    expected = rows(left.join(right, "k", how).select("k", "v1", "v4"))
    assert rows(joins.join(left, right, "k", how, rows_per_task=20)) == expected
    salted = joins.join_partitioned(left, right, "k", how, 4, rows_per_task=20)
    assert rows(salted) == expected


def test_several_keys(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "j int, k int, x string")
    right = spark.createDataFrame([(1, 2, "p"), (1, 3, "q")], "j int, k int, y string")
    for limit in (None, 1):
        found = rows(joins.join(left, right, ["j", "k"], "outer", rows_per_task=limit))
        assert found == Counter([(1, 1, "a", None), (1, 2, "b", "p"), (1, 3, None, "q")])


def test_arguments_are_checked(sides):
    left, right = sides
    with pytest.raises(ValueError, match="join type"):
        joins.join(left, right, "k", "cross")
    with pytest.raises(ValueError, match="not in the table: z"):
        joins.join(left, right, "z")
    with pytest.raises(ValueError, match="another suffix"):
        joins.join(left.withColumn("x_right", F.lit(1)), right, "k")
    with pytest.raises(ValueError, match="num_partitions"):
        joins.join_partitioned(left, right, "k", num_partitions=0)
    with pytest.raises(ValueError, match="exactly two"):
        require_two_tables([left])


def test_label_then_join(spark):
    left = spark.createDataFrame([(1, 10), (2, 90)], "user_id int, mb int")
    right = spark.createDataFrame([(1, "p"), (2, "q")], "user_id int, name string")
    labelled = joins.label_then_join(left, right, "user_id", "inner", ["mb > 50"], "Alto", "Bajo")
    assert rows(labelled) == Counter([(1, 10, "Bajo", "p"), (2, 90, "Alto", "q")])
    plain = joins.label_then_join(
        left, right, "user_id", "inner", ["mb > 50"], "Alto", "Bajo", join_filter=False
    )
    assert plain.columns == ["user_id", "mb", "name"]
    with pytest.raises(ValueError, match="numeric"):
        joins.label_then_join(
            left.withColumn("user_id", F.lit("u")), right, "user_id", "inner", [], "a", "b"
        )


def test_label_both_then_join(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 90.0)], "user_id int, mb double")
    right = spark.createDataFrame([(1, 70.0), (2, None)], "user_id int, mb double")
    for partitioned in (False, True):
        both = joins.label_both_then_join(left, right, "user_id", "inner", "mb", 2, partitioned)
        assert rows(both) == Counter(
            [(1, 10.0, "Bajo", 70.0, "Alto"), (2, 90.0, "Alto", None, "Alto")]
        )
        assert both.columns[2] == "mb_diferiencia" and both.columns[4] == "mb_diferiencia_right"
    one = joins.label_both_then_join(left, right.drop("mb"), "user_id", "left", "mb")
    assert one.columns == ["user_id", "mb", "mb_diferiencia"]


def test_names_compare_as_the_session_does(spark):
    left = spark.createDataFrame([(1, "a")], "K int, Name string")
    right = spark.createDataFrame([(1, "b")], "k int, name string")
    joined = joins.join(left, right, "k")
    assert joined.columns == ["K", "Name", "name_right"] and joined.collect() == [(1, "a", "b")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="not in the table: k"):
            joins.join(left, right, "k")
        same = joins.join(left, right.withColumnRenamed("k", "K"), "K")
        assert same.columns == ["K", "Name", "name"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_keys_of_different_kinds_are_refused(spark):
    left, right = (spark.createDataFrame([(v,)], f"k {t}") for v, t in ((1, "int"), ("1", "string")))
    with pytest.raises(ValueError, match="key k is int on the left, string on the right"):
        joins.join(left, right, "k")


def test_salt_splits_rows_that_lie_together(spark):
    left = spark.range(20_000).selectExpr("if(id % 2 = 0, 7, id) as k", "id as v").repartition(6, "k")
    right = spark.range(100).selectExpr("id as k", "id * 2 as w")
    joined = joins.join_partitioned(left, right, "k", num_partitions=16, rows_per_task=1_000)
    sizes = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in sizes) == 10_001 and max(r[1] for r in sizes) <= 5_000 and len(sizes) >= 5
