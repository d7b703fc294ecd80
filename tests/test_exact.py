"""Sums of doubles: the true sum's nearest double, whatever the cuts, the partitioning and the window."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import exact
from rowsmith.operators import aggregates, windows
from rowsmith.operators.windows import Rolling


def groups():
    draw = random.Random(2)
    yield from ([0.1] * 10, [1e16, 1.0, -1e16], [0.0], [-0.0, 0.0], [-5e-2, 5e-2], [5e-324, 5e-324], [1.7e308, -1.7e308, 1.0])
    # Ties, and ties that a much smaller rest decides.
    for rest in (0.0, 2.0**-80, -(2.0**-80)):
        for one in (1.0, -1.0, 1 + 2.0**-52, -1 - 2.0**-52):
            yield [one, 2.0**-53, rest]
            yield [one, -(2.0**-53), rest]
    for _ in range(60):
        yield [draw.choice((-1, 1)) * draw.random() * 2.0 ** draw.randrange(-70, 70) for _ in range(draw.randrange(1, 12))]
        close = [draw.uniform(-100, 100) for _ in range(20)]
        yield close + [-x for x in close[:19]]


def test_group_sums_are_the_nearest_double(spark):
    rows = [(g, x) for g, found in enumerate(groups()) for x in found]
    want = defaultdict(Fraction)
    for g, x in rows:
        want[g] += Fraction(x)
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
        got = {r.g: r.sum_x for r in aggregates.group(df, ["g"], "x", "sum", exactly=True).collect()}
        assert got == {g: float(total) for g, total in want.items()}


def test_special_values_and_nulls(spark):
    inf = math.inf
    rows = [(1, inf), (1, 1.0), (2, inf), (2, -inf), (3, math.nan), (3, 1.0), (4, None), (5, None), (5, 2.5), (6, -inf)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.sum_x for r in aggregates.group(df, ["g"], "x", "sum", exactly=True).collect()}
    assert got[1] == inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] is None and got[5] == 2.5 and got[6] == -inf
    means = {r.g: r.mean_x for r in aggregates.group(df, ["g"], "x", "mean", exactly=True).collect()}
    assert means[5] == 2.5 and means[4] is None
    assert aggregates.group(df.limit(0), ["g"], "x", "sum", exactly=True).collect() == []


@pytest.fixture(scope="module")
def wild(spark):
    draw = random.Random(9)
    rows = []
    for i in range(900):
        x = None if i % 11 == 0 else draw.choice((-1, 1)) * draw.random() * 10.0 ** draw.randrange(-12, 12)
        rows.append((i, "hot" if i % 3 else "cold", x))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "id int, k string, x double").repartition(4).cache()


def values(df, column):
    return {r.id: r[column] for r in df.collect()}


def in_order(wild):
    found = defaultdict(list)
    for r in sorted(wild.collect(), key=lambda r: r.id):
        found[r.k].append((r.id, r.x))
    return found


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_totals_do_not_depend_on_cuts(wild, keys):
    uncut = values(windows.cumulative_sum(wild, ["x"], ["id"], keys), "Acumulacion_x")
    for rows in (7, 150):
        assert values(windows.cumulative_sum(wild, ["x"], ["id"], keys, rows), "Acumulacion_x") == uncut
    assert values(windows.cumulative_sum(wild.repartition(1), ["x"], ["id"], keys, 40), "Acumulacion_x") == uncut
    if keys:
        for rows in in_order(wild).values():
            total = Fraction(0)
            for i, x in rows:
                total += Fraction(x or 0)
                assert uncut[i] == (None if x is None else float(total))


@pytest.mark.parametrize("op", ["rolling_sum", "rolling_mean"])
@pytest.mark.parametrize("window, lag", [(3, 1), (40, 0)])
def test_rolling_values_are_the_same_in_frames_runs_and_blocks(wild, op, window, lag):
    feature = [Rolling("x", window, lag, op, "r")]
    frames = values(windows.rolling(wild, feature, ["id"], ["k"], runs_from=10**6), "r")
    assert frames == values(windows.rolling(wild, feature, ["id"], ["k"], runs_from=1), "r")
    assert frames == values(windows.rolling(wild, feature, ["id"], ["k"], rows_per_block=50), "r")
    for rows in in_order(wild).values():
        for at in range(len(rows)):
            part = [x for _, x in rows[max(at - lag - window + 1, 0) : max(at - lag + 1, 0)]]
            full = len(part) == window and None not in part
            total = float(sum(map(Fraction, part))) if full else None
            assert frames[rows[at][0]] == (total if total is None or op == "rolling_sum" else total / window)


@pytest.mark.parametrize("op", ["rolling_sum", "rolling_mean", "rolling_max"])
def test_rolling_cumulative_does_not_depend_on_cuts(wild, op):
    feature = [Rolling("x", 3, 1, op, "r")]
    inner = values(windows.rolling(wild, feature, ["id"], ["k"]), "r")
    uncut = values(windows.rolling_cumulative(wild, feature, ["id"], ["k"]), "r")
    assert uncut == values(windows.rolling_cumulative(wild, feature, ["id"], ["k"], 30), "r")
    for rows in in_order(wild).values():
        total = Fraction(0)
        for i, _ in rows:
            total += Fraction(inner[i] or 0)
            assert uncut[i] == (None if inner[i] is None else float(total))


def test_digits_of_rolling_values_cover_them(spark):
    digits = exact.Digits.between(-10, 20)
    wider = exact.of_rolling(spark.range(1).select(F.lit(1.0).alias("x")).schema["x"].dataType, digits, "mean", 5)
    assert wider.low <= -10 - 3 - 53 and wider.high >= 20
    assert exact.Digits.between(-2000, 0).low == -1074
