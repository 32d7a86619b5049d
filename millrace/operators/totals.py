"""Sums and averages that do not depend on the order of rows.

Doubles added up in another order, after a retry or with other partitions, give other last digits. Here
every value is taken apart into a whole number and a power of two, whole numbers of one power are
added up as integers, which is exact in any order, and the few totals of a group are put together at the end,
the largest first, in double-double arithmetic. The result is the double nearest to the exact sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits between neighbouring bins. A value has 53 bits and, with the bits of its bin and three for the
# estimate of its exponent, fits 64; 22-bit digits of it add up over 2 ** 41 rows.
BIN_BITS = 8
DIGIT_BITS = 22
MASK = (1 << DIGIT_BITS) - 1
LEAST_EXPONENT = -1022
# Exponent of the largest bin whose totals are doubles, with the bits of a value and of its rows on top.
ROOM = 912


def power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def scaled(value: Column, exponent: Column) -> Column:
    """``value * 2 ** exponent``, also where the power alone would be too large or too small."""
    half = F.floor(exponent / 2)
    return value * power_of_two(half) * power_of_two(exponent - half)


def is_finite(value: Column) -> Column:
    return ~(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))))


def bin_of(value: Column) -> Column:
    """Number of the bin of a double: its whole number counts units of ``2 ** (BIN_BITS * bin)``. NULL for
    zero, NULL, NaN and infinity, which have no digits."""
    exponent = F.greatest(F.floor(F.log2(F.abs(value))), F.lit(LEAST_EXPONENT)) - 1
    return F.when(is_finite(value) & (value != 0), F.floor((exponent - 52) / BIN_BITS).cast("int"))


def digits_of(value: Column, bin_: Column) -> list[Column]:
    """Three digits of the whole number of a value, the highest, which has the sign, first."""
    whole = scaled(value, -BIN_BITS * bin_.cast("bigint")).cast("bigint")
    middle = F.shiftright(whole, DIGIT_BITS).bitwiseAND(F.lit(MASK))
    return [F.shiftright(whole, 2 * DIGIT_BITS), middle, whole.bitwiseAND(F.lit(MASK))]


def _two_sum(total: Column, term: Column) -> Column:
    """``total`` (``hi`` and ``lo``) and ``term`` with what rounding loses kept in ``lo``."""
    hi = total["hi"] + term
    back = hi - total["hi"]
    lost = (total["hi"] - (hi - back)) + (term - back)
    return F.struct(hi.alias("hi"), (total["lo"] + lost).alias("lo"))


def put_together(bins: Column) -> Column:
    """The double nearest to the sum of ``bins``, structs of ``bin`` and the sums of its three digits
    ``d0``, ``d1``, ``d2``; 0 if there are none."""
    ordered = F.sort_array(bins, asc=False)
    # Only totals near the largest double are added up in smaller units, which their sum may exceed.
    unit = F.greatest(BIN_BITS * F.get(ordered, F.lit(0))["bin"].cast("bigint") - ROOM, F.lit(0))

    def terms(one: Column) -> Column:
        # Digits in range, so that each of three doubles holds its part exactly.
        middle = one["d1"] + F.shiftright(one["d2"], DIGIT_BITS)
        high = one["d0"] + F.shiftright(middle, DIGIT_BITS)
        low = middle.bitwiseAND(F.lit(MASK)) * (1 << DIGIT_BITS) + one["d2"].bitwiseAND(F.lit(MASK))
        power = BIN_BITS * one["bin"].cast("bigint") - unit
        parts = [
            (F.shiftright(high, 32), power + 2 * DIGIT_BITS + 32),
            (high.bitwiseAND(F.lit(0xFFFF_FFFF)), power + 2 * DIGIT_BITS),
            (low, power),
        ]
        return F.array(*[scaled(digits.cast("double"), exponent) for digits, exponent in parts])

    start = F.struct(F.lit(0.0).alias("hi"), F.lit(0.0).alias("lo"))
    total = F.aggregate(F.flatten(F.transform(ordered, terms)), start, _two_sum, lambda t: t["hi"] + t["lo"])
    return F.when(F.size(ordered) > 0, scaled(total, unit)).otherwise(F.lit(0.0))


def exact_totals(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column] | None = None,
    averages: dict[str, Column] | None = None,
    rows: str | None = None,
    least: dict[str, Column] | None = None,
    most: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group: sums and averages of any numbers, the number of ``rows``, least and greatest
    values, under the given names. Without ``keys`` the whole table is one group.

    Sums and averages are doubles and the same for any partitioning and order of rows. As in ``sum`` and ``avg``, NULL is
    left out, a group without values has NULL, NaN gives NaN, and infinities give an infinity, or NaN if they
    have both signs. Rows are combined per group and bin before the first shuffle; a group has
    few bins, one for values within a factor of 256, and never more than 264 a column.
    """
    sums, averages, least, most = sums or {}, averages or {}, least or {}, most or {}
    values = [*sums.values(), *averages.values()]
    bins = [f"_bin{i}" for i in range(len(values))]
    doubles = [value.cast("double").alias(f"_v{i}") for i, value in enumerate(values)]
    named = df.select(*keys, *doubles, *[c.alias(f"_x{n}") for n, c in {**least, **most}.items()])
    binned = named.select("*", *[bin_of(F.col(f"_v{i}")).alias(name) for i, name in enumerate(bins)])
    parts, whole = [F.count("*").alias("_rows")], [F.sum("_rows").alias("_rows")]
    for i, name in enumerate(bins):
        value = F.col(f"_v{i}")
        for d, digit in enumerate(digits_of(value, F.col(name))):
            parts.append(F.sum(digit).alias(f"_d{i}_{d}"))
        parts.append(F.count(value).alias(f"_n{i}"))
        parts.append(F.sum(F.when(~is_finite(value), value)).alias(f"_odd{i}"))
        held = F.struct(F.col(name).alias("bin"), *[F.col(f"_d{i}_{d}").alias(f"d{d}") for d in range(3)])
        whole.append(F.collect_list(F.when(F.col(name).isNotNull(), held)).alias(f"_bins{i}"))
        whole += [F.sum(f"_n{i}").alias(f"_n{i}"), F.sum(f"_odd{i}").alias(f"_odd{i}")]
    for n in least:
        parts.append(F.min(f"_x{n}").alias(f"_x{n}"))
        whole.append(F.min(f"_x{n}").alias(f"_x{n}"))
    for n in most:
        parts.append(F.max(f"_x{n}").alias(f"_x{n}"))
        whole.append(F.max(f"_x{n}").alias(f"_x{n}"))
    grouped = binned.groupBy(*keys, *bins).agg(*parts).groupBy(*keys).agg(*whole)
    out = [F.col(key) for key in keys]
    for i, name in enumerate([*sums, *averages]):
        total = F.coalesce(F.col(f"_odd{i}"), put_together(F.col(f"_bins{i}")))
        result = total if i < len(sums) else total / F.col(f"_n{i}")
        out.append(F.when(F.col(f"_n{i}") > 0, result).alias(name))
    if rows is not None:
        out.append(F.coalesce("_rows", F.lit(0)).alias(rows))
    return grouped.select(*out, *[F.col(f"_x{n}").alias(n) for n in [*least, *most]])


def rounded(value: Column, digits: int) -> Column:
    """Half up, where a half is what is one within seven more digits: a mean of 1.00 and 1.01 is 1.01,
    although no double is 1.005."""
    return F.round(F.round(value, digits + 7), digits)
