"""Sums of doubles that do not depend on the order of adding.

A double is a whole number of 53 bits times a power of two. Here it is cut at fixed powers of two into
digits of WIDTH bits, each an exact ``bigint``. Digits of one place are added as whole numbers, in any order and
over any partitioning; the total is put together from them at the end and rounded once, to the nearest
double (ties to even). So a sum over cut blocks, over partial aggregates or over one whole group is the same
bit for bit, and it is the true sum's nearest double.

How many digits a column needs follows from its smallest and largest magnitude (``ranges``, one aggregate over it).
The digits of 2**(62 - WIDTH) rows fit a ``bigint``; more fail the job in Spark's overflow check. NaN and
infinities are added apart, as doubles, and decide the result as in any sum.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType

WIDTH = 22
# Up to so many digits are put together in one projection for each.
MOST_STEPS = 12
_HALF = 1 << (WIDTH - 1)
_MASK = (1 << WIDTH) - 1
_LOWEST, _HIGHEST = -1074, 1023


def inexact(dtype: DataType) -> bool:
    """Whether sums of the type depend on the order of adding."""
    return isinstance(dtype, (DoubleType, FloatType))


@dataclass(frozen=True)
class Digits:
    """``count`` digits; digit i counts multiples of 2**(low + WIDTH * i). ``special``: NaN or infinities may occur."""

    low: int
    count: int
    special: bool = False

    @classmethod
    def between(cls, low: int, high: int, special: bool = False) -> Digits:
        """For multiples of 2**low below 2**high."""
        low = max(low, _LOWEST)
        return cls(low, max(1, math.ceil((high - low) / WIDTH)), special)

    @property
    def high(self) -> int:
        return self.low + WIDTH * self.count

    def parts(self) -> int:
        return self.count + self.special


def ranges(columns: Sequence[str]) -> list[Column]:
    """Aggregates from which ``from_ranges`` finds the digits of double columns."""
    out = []
    for i, c in enumerate(columns):
        size = F.abs(F.col(c).cast("double"))
        finite = ~F.isnan(size) & (size < math.inf)
        out += [
            F.min(F.when(finite & (size > 0), size)).alias(f"least_{i}"),
            F.max(F.when(finite, size)).alias(f"most_{i}"),
            F.max(~finite).alias(f"special_{i}"),
        ]
    return out


def from_ranges(columns: Sequence[str], found: Mapping) -> dict[str, Digits]:
    out = {}
    for i, c in enumerate(columns):
        least, most, special = (found.get(f"{k}_{i}") for k in ("least", "most", "special"))
        low = math.frexp(least)[1] - 53 if least else 0
        high = math.frexp(most)[1] if most else 1
        out[c] = Digits.between(low, high, bool(special))
    return out


def measure(df: DataFrame, columns: Sequence[str]) -> dict[str, Digits]:
    """The digits that double columns need (one job)."""
    if not columns:
        return {}
    return from_ranges(columns, df.agg(*ranges(columns)).first().asDict())


def of_rolling(dtype: DataType, digits: Digits | None, aggregate: str, window: int) -> Digits:
    """Digits of a rolling feature's values, given those of its column.

    A sum of multiples of 2**low is one too, and its double may have all 53 bits above it. A mean is
    at least such a multiple over ``window`` and has 53 bits below that.
    """
    if digits is None:
        digits = Digits.between(0, 64) if isinstance(dtype, IntegralType) else Digits.between(-128, 128)
    wider = max(window - 1, 0).bit_length()
    if aggregate == "mean":
        return Digits.between(digits.low - wider - 54, digits.high, digits.special)
    return Digits.between(digits.low, min(digits.high + wider, _HIGHEST + 1), digits.special)


def _power(exponent: int) -> Column:
    return F.lit(math.ldexp(1.0, exponent))


def parts(value: Column, digits: Digits) -> list[Column]:
    """The digits of a value, to be added one by one, and its special value if there may be any."""
    x = value.cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) < math.inf), x).otherwise(F.when(x.isNotNull(), F.lit(0.0))) if digits.special else x
    out = []
    for i in range(digits.count):
        at = digits.low + WIDTH * i
        below = finite if at + WIDTH > _HIGHEST else finite % _power(at + WIDTH)
        out.append((below / _power(at)).cast("bigint"))
    if digits.special:
        out.append(F.when(F.isnan(x) | (F.abs(x) == math.inf), x))
    return out


def totals(df: DataFrame, wanted: Mapping[str, tuple[Sequence[str], Digits]]) -> DataFrame:
    """Add each named double from the columns with the sums of its parts.

    First the digits are carried so that each lies within half of 2**WIDTH on both sides of 0; such
    digits are parts of the total that don't overlap. Then they are added from the highest on until one
    does not fit, and the sign of the rest decides a tie.
    """
    far = {n: w for n, w in wanted.items() if w[1].count > MOST_STEPS}
    near = {n: w for n, w in wanted.items() if n not in far}
    if near:
        df = _in_steps(df, near)
    return df.withColumns({n: _in_arrays(sums, digits) for n, (sums, digits) in far.items()}) if far else df


def _rounded(held: Column, error: Column, rest: Column) -> Column:
    beyond = held + 2 * error
    half = (F.signum(error) * F.signum(rest) > 0) & (beyond - held == 2 * error)
    return F.when(half, beyond).otherwise(held)


def _scaled(number: Column, at: int) -> Column:
    """A digit times 2**at, also beyond the largest power of two."""
    return number * _power(at) if at <= _HIGHEST else number * _power(1000) * _power(min(at - 1000, _HIGHEST))


def _in_arrays(sums: Sequence[str], digits: Digits) -> Column:
    """One expression over arrays, for columns of so many digits that a projection for each would make a huge plan."""
    zero = F.lit(0).cast("bigint")
    every = F.array(*(F.col(s) for s in sums[: digits.count]), zero, zero, zero)
    none = F.array().cast("array<bigint>")

    def carry(state: Column, here: Column) -> Column:
        moved = state["carry"] + here + _HALF
        digit = moved.bitwiseAND(F.lit(_MASK).cast("bigint")) - _HALF
        return F.struct(F.shiftright(moved, WIDTH).alias("carry"), F.array_append(state["digits"], digit).alias("digits"))

    carried = F.aggregate(every, F.struct(zero.alias("carry"), none.alias("digits")), carry, lambda s: s["digits"])
    places = [digits.low + WIDTH * i for i in range(digits.count + 3)]
    first = F.array(*(_power(min(at, _HIGHEST)) for at in places))
    second = F.array(*(_power(max(at - _HIGHEST, 0)) for at in places))
    scaled = F.zip_with(F.zip_with(carried, first, lambda d, p: d.cast("double") * p), second, lambda d, p: d * p)

    def add(state: Column, d: Column) -> Column:
        held, error, rest = state["held"], state["error"], state["rest"]
        fits = error == 0
        return F.struct(
            F.when(fits, held + d).otherwise(held).alias("held"),
            F.when(fits, d - ((held + d) - held)).otherwise(error).alias("error"),
            F.when(~fits & (rest == 0), d).otherwise(rest).alias("rest"),
        )

    start = F.struct(*(F.lit(0.0).alias(k) for k in ("held", "error", "rest")))
    total = F.aggregate(F.reverse(scaled), start, add, lambda s: _rounded(s["held"], s["error"], s["rest"]))
    total = F.when(F.col(sums[0]).isNotNull(), total)
    return F.coalesce(F.col(sums[digits.count]), total) if digits.special else total


def _in_steps(df: DataFrame, wanted: Mapping[str, tuple[Sequence[str], Digits]]) -> DataFrame:
    """One projection per digit and step, so that each step is computed once and compiled."""
    work = {name: f"__exact_{j}" for j, name in enumerate(wanted)}
    places = {name: digits.count + 3 for name, (_, digits) in wanted.items()}
    most = max(places.values())
    digit = lambda name, i: f"{work[name]}_{i}"
    for i in range(most):
        step = {}
        for name, (sums, digits) in wanted.items():
            if i >= places[name]:
                continue
            here = F.col(sums[i]) if i < digits.count else F.lit(0).cast("bigint")
            moved = here + _HALF if i == 0 else here + F.col(f"{work[name]}_carry") + _HALF
            step[f"{work[name]}_carry"] = F.shiftright(moved, WIDTH)
            step[digit(name, i)] = moved.bitwiseAND(F.lit(_MASK).cast("bigint")) - _HALF
        df = df.withColumns(step)

    def value(name: str, i: int) -> Column:
        return _scaled(F.col(digit(name, i)).cast("double"), wanted[name][1].low + WIDTH * i)

    df = df.withColumns(
        {
            f"{work[n]}_{k}": v
            for n in wanted
            for k, v in (("sum", value(n, places[n] - 1)), ("error", F.lit(0.0)), ("rest", F.lit(0.0)))
        }
    )
    for back in range(2, most + 1):
        step = {}
        for name in wanted:
            i = places[name] - back
            if i < 0:
                continue
            held, error, rest = (F.col(f"{work[name]}_{k}") for k in ("sum", "error", "rest"))
            d = value(name, i)
            fits = error == 0
            step[f"{work[name]}_sum"] = F.when(fits, held + d).otherwise(held)
            step[f"{work[name]}_error"] = F.when(fits, d - ((held + d) - held)).otherwise(error)
            step[f"{work[name]}_rest"] = F.when(~fits & (rest == 0), d).otherwise(rest)
        df = df.withColumns(step)
    final, used = {}, []
    for name, (sums, digits) in wanted.items():
        held, error, rest = (F.col(f"{work[name]}_{k}") for k in ("sum", "error", "rest"))
        rounded = _rounded(held, error, rest)
        final[name] = F.coalesce(F.col(sums[digits.count]), rounded) if digits.special else rounded
        used += [f"{work[name]}_{k}" for k in ("carry", "sum", "error", "rest", *range(places[name]))]
    return df.withColumns(final).drop(*used)
