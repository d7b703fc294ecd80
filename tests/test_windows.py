"""Positional features on the nine-row table, plain and cut into blocks."""

import pytest

from rowsmith.operators import features, ranks, windows
from rowsmith.operators.windows import Rolling

N = None
BLOCK_SIZES = [None, 3, 1]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
@pytest.mark.parametrize(
    "op, window, lag, keys, expected",
    [
        ("mean", 2, 1, [], [N, N, 35, N, N, 40, 35, 25, 30]),
        ("mean", 2, -1, [], [35, N, N, 40, 35, 25, 30, 30, N]),
        ("sum", 2, 1, [], [N, N, 70, N, N, 80, 70, 50, 60]),
        ("mean", 1, 4, [], [N, N, N, N, 30, 40, N, 30, 50]),
        ("mean", 1, -20, [], [N] * 9),
        ("mean", 1, 20, [], [N] * 9),
        ("sum", 2, 0, ["user_id"], [N, 70, N, N, 80, 70, N, 60, 60]),
        ("max", 2, 0, ["user_id"], [N, 40, N, N, 50, 50, N, 30, 30]),
        ("min", 2, 0, ["user_id"], [N, 40 - 10, N, N, 30, 20, N, 30, 30]),
        ("mean", 9, 0, ["user_id"], [N] * 9),
    ],
)
def test_rolling(users, in_order, op, window, lag, keys, expected, rows):
    feature = Rolling("age", window, lag, f"rolling_{op}")
    result = windows.rolling(users, [feature], ["seq"], keys, rows)
    assert in_order(result, f"rolling_{op}_age") == expected
    assert result.columns == [*users.columns, f"rolling_{op}_age"]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_several_features_at_once(users, in_order, rows):
    wanted = windows.rolling_list(["age", "seq"], [2, 3], [1, -1], "rolling_sum")
    result = windows.rolling(users, wanted, ["seq"], rows_per_block=rows)
    assert in_order(result, "rolling_sum_age") == [N, N, 70, N, N, 80, 70, 50, 60]
    assert in_order(result, "rolling_sum_seq") == [N, 6, 9, 12, 15, 18, 21, 24, N]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_rolling_over_self(users, in_order, rows):
    result = windows.rolling_over_self(users, [Rolling("age", 2, 1)], ["seq"], rows)
    assert in_order(result, "rolling_mean_age") == [N, N, N, N, N, N, 30, 30, 30]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_rolling_cumulative(users, in_order, rows):
    feature = Rolling("age", 2, 1, "rolling_sum")
    result = windows.rolling_cumulative(users, [feature], ["seq"], ["user_id"], rows)
    assert in_order(result, "rolling_sum_age") == [N, N, 70, N, N, 150, N, N, 60]
    assert result.columns == [*users.columns, "rolling_sum_age"]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_cumulative_sum(users, in_order, rows):
    keyed = windows.cumulative_sum(users, ["age"], ["seq"], ["user_id"], rows)
    assert in_order(keyed, "Acumulacion_age") == [30, 70, N, 100, 150, 170, 30, 60, 90]
    whole = windows.cumulative_sum(users, ["age"], ["seq"], rows_per_block=rows)
    assert in_order(whole, "Acumulacion_age") == [30, 70, N, 100, 150, 170, 200, 230, 260]
    plain = windows.cumulative_sum(users, ["age"], ["seq"], ["user_id"])
    assert keyed.schema["Acumulacion_age"].dataType == plain.schema["Acumulacion_age"].dataType


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_shift(users, in_order, rows):
    back = windows.shift(users, "city", 2, ["seq"], ["user_id"], rows_per_block=rows)
    assert in_order(back, "shift_city") == [N, N, "A", "B", "A", "A", N, N, "B"]
    ahead = windows.shift(users, "age", -1, ["seq"], rows_per_block=rows)
    assert in_order(ahead, "shift_age") == [40, N, 30, 50, 20, 30, 30, 30, N]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
@pytest.mark.parametrize(
    "method, expected",
    [
        ("dense", [2, 3, N, 2, 4, 1, 2, 2, 2]),
        ("min", [2, 7, N, 2, 8, 1, 2, 2, 2]),
        ("average", [4, 7, N, 4, 8, 1, 4, 4, 4]),
    ],
)
def test_rank(users, in_order, method, expected, rows):
    assert in_order(ranks.rank(users, ["age"], method, rows), "Rank_age") == expected


def test_rank_puts_nan_last(spark, in_order):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None)], "seq int, x double")
    for rows in BLOCK_SIZES:
        assert in_order(ranks.rank(df, ["x"], "min", rows), "Rank_x") == [2, 1, N]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
def test_feature_bundle(users, in_order, rows):
    result = features.feature_bundle(
        users, ["age"], [2], [1], "dense", ["seq"], ["user_id"], rows
    )
    assert in_order(result, "Rolling_age") == [N, N, 70, N, N, 80, 70, 50, 60]
    assert in_order(result, "Acumulacion_age") == [30, 70, N, 100, 150, 170, 30, 60, 90]
    assert in_order(result, "Rank_age") == [2, 3, N, 2, 4, 1, 2, 2, 2]


@pytest.mark.parametrize("rows", BLOCK_SIZES)
@pytest.mark.parametrize(
    "column, op, expected", [("age", "mean", {1: 34, 2: 30}), ("r", "mean", {1: 36.25, 2: 30})]
)
def test_clean_roll_group(users, column, op, expected, rows):
    feature = Rolling("age", 2, 0, "rolling_mean", "r")
    result = features.clean_roll_group(
        users, "age", feature, ["user_id"], ["seq"], ["user_id"], column, op, rows
    )
    assert {r.user_id: r[f"{op}_{column}"] for r in result.collect()} == expected


def test_empty_table(users):
    empty = users.filter("seq < 0")
    feature = [Rolling("age", 2, 1)]
    assert windows.rolling(empty, feature, ["seq"], rows_per_block=1).count() == 0
    assert windows.cumulative_sum(empty, ["age"], ["seq"], ["user_id"], 1).count() == 0
    assert ranks.rank(empty, ["age"], "min", 1).count() == 0


def test_all_null_column(spark, in_order):
    df = spark.createDataFrame([(i, None) for i in range(4)], "seq int, x double")
    for rows in BLOCK_SIZES:
        rolled = windows.rolling(df, [Rolling("x", 1)], ["seq"], (), rows)
        assert in_order(rolled, "rolling_mean_x") == [N] * 4
        summed = windows.cumulative_sum(df, ["x"], ["seq"], (), rows)
        assert in_order(summed, "Acumulacion_x") == [N] * 4
        assert in_order(ranks.rank(df, ["x"], "average", rows), "Rank_x") == [N] * 4


def test_arguments_are_checked(users):
    ok = [Rolling("age", 2)]
    with pytest.raises(ValueError, match="order_by"):
        windows.rolling(users, ok, [])
    with pytest.raises(ValueError, match="not in the table: nobody"):
        windows.rolling(users, ok, ["seq"], ["nobody"])
    with pytest.raises(ValueError, match="numeric: city"):
        windows.rolling(users, [Rolling("city", 2)], ["seq"])
    with pytest.raises(ValueError, match="window"):
        windows.rolling(users, [Rolling("age", 0)], ["seq"])
    with pytest.raises(ValueError, match="lag"):
        windows.rolling(users, [Rolling("age", 2, -1)], ["seq"], ["user_id"])
    with pytest.raises(ValueError, match="unknown operator"):
        windows.rolling(users, [Rolling("age", 2, 0, "rolling_median")], ["seq"])
    with pytest.raises(ValueError, match="already exist"):
        windows.rolling(users, [Rolling("age", 2, name="city")], ["seq"])
    with pytest.raises(ValueError, match="same length"):
        windows.rolling_list(["age"], [2, 3], [1, 2], "rolling_sum")
    with pytest.raises(ValueError, match="unique"):
        windows.rolling_list(["age", "age"], [2, 3], [1, 2], "rolling_sum")
    with pytest.raises(ValueError, match="rank method"):
        ranks.rank(users, ["age"], "max")
    with pytest.raises(TypeError, match="one table"):
        windows.rolling([users, users], ok, ["seq"])
