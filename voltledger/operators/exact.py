"""Sums of doubles that are the same whatever the order of addition.

A double is a whole number of 20-bit digits: at most four of them, from the one that holds its top
bit. Digits are whole numbers, so their sums are exact, and they are the same for any number of
partitions, tasks and retries. Rows are grouped by the place of their top digit (a column spans few
of the 105 places), which combines before the shuffle like any sum. The digit sums of a group are
then carried over and rounded once, half to even: the result is the double nearest to the true sum.

Nulls are skipped and nothing adds up to 0. NaN, or infinities of both signs, give NaN; otherwise an
infinity stays. A sum beyond the doubles is an infinity, though a part of it may be. A group may
have 2**41 rows; more would raise an overflow error, not wrap around.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, require_columns, sum_or_zero

BITS = 20
MASK = (1 << BITS) - 1
# Places that stand for values which have no digits.
NAN, INFINITE, MINUS_INFINITE = 1000, 1001, 1002


def is_floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def _power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _scaled(x: Column, digits: Column) -> Column:
    """``x * 2**(20 * digits)``, in two halves so that the factor is always a double."""
    half = _power_of_two(digits * (BITS // 2))
    return x * half * half


def _place(x: Column) -> Column:
    """The place of the top digit; null for zero and null. One too low or too high does no harm:
    four digits have seven bits more than a double."""
    special = (
        F.when(F.isnan(x), NAN)
        .when(x == float("inf"), INFINITE)
        .when(x == float("-inf"), MINUS_INFINITE)
    )
    return special.when(x != 0, F.floor(F.log2(F.abs(x)) / BITS).cast("int"))


def added_up(df: DataFrame, by: int = 0) -> DataFrame:
    """``k0..., measure, place, s0, s1, s2, s3, p0...`` added up per place and the first ``by`` keys."""
    keys = [f"k{n}" for n in range(by)]
    plain = [name for name in df.columns if name.startswith("p") and name != "place"]
    sums = [F.sum(name).alias(name) for name in ("s0", "s1", "s2", "s3", *plain)]
    return df.groupBy(*keys, "measure", "place").agg(*sums)


def digit_sums(
    df: DataFrame, measures: Sequence[Column], by: Sequence[Column], plain: Sequence[Column] = ()
) -> DataFrame:
    """``k0..., measure, place, s0, s1, s2, s3, p0...``: digit sums of each measure by place, and
    the sums of ``plain`` columns beside those of the first measure."""
    x, y, upper = F.col("x"), F.col("y"), F.col("upper")
    keys = [f"k{n}" for n in range(len(by))]
    others = [f"p{n}" for n in range(len(plain))]
    values = F.array(*[c.cast("double") for c in measures])
    rows = df.select(
        *[c.alias(name) for name, c in zip(keys, by)],
        *[c.alias(name) for name, c in zip(others, plain)],
        F.posexplode(values).alias("measure", "x"),
    )
    has_digits = F.col("place") < NAN
    placed = rows.select("*", _place(x).alias("place"))
    placed = placed.withColumn("y", F.when(has_digits, _scaled(x, -F.col("place"))))
    # The upper two digits as one whole number; what is left of the double are the lower two.
    placed = placed.withColumn("upper", (y * (1 << BITS)).cast("long"))
    lower = ((y * (1 << BITS) - upper) * (1 << 2 * BITS)).cast("long")
    placed = placed.withColumn("lower", lower)
    return added_up(
        placed.select(
            *keys,
            "measure",
            "place",
            F.shiftright("upper", BITS).alias("s0"),
            F.col("upper").bitwiseAND(MASK).alias("s1"),
            F.shiftright("lower", BITS).alias("s2"),
            F.col("lower").bitwiseAND(MASK).alias("s3"),
            *[F.when(F.col("measure") == 0, F.col(name)).alias(name) for name in others],
        ),
        len(by),
    )


def _carried(digits: Column) -> Column:
    """``carry`` and ``digits`` from 0 to 2**20 - 1, for whole numbers from the lowest place up."""
    start = F.struct(
        F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits")
    )

    def step(before: Column, digit: Column) -> Column:
        total = digit + before["carry"]
        kept = F.concat(before["digits"], F.array(total.bitwiseAND(MASK)))
        return F.struct(F.shiftright(total, BITS).alias("carry"), kept.alias("digits"))

    return F.aggregate(digits, start, step)


def _spread(parts: Column, places: Column) -> Column:
    """The sum at every place from a list of ``place, s0, s1, s2, s3``."""

    def at(place: Column) -> Column:
        def add(total: Column, part: Column) -> Column:
            matched = F.when(part["place"] == place, part["s0"])
            for n in (1, 2, 3):
                matched = matched.when(part["place"] - n == place, part[f"s{n}"])
            return total + F.coalesce(matched, F.lit(0).cast("long"))

        return F.aggregate(parts, F.lit(0).cast("long"), add)

    return F.transform(places, at)


def _rounded(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each list of digit sums in ``names`` replaced by the nearest double."""
    for name in names:
        parts = F.col(name)
        digits_of = F.filter(parts, lambda p: p["place"] < NAN)
        found = found.withColumn("parts", digits_of)
        lowest = F.array_min(F.transform("parts", lambda p: p["place"])) - 3
        # A sum of 2**41 digits reaches three places further up.
        highest = F.array_max(F.transform("parts", lambda p: p["place"])) + 4
        found = found.withColumn("lowest", lowest)
        places = F.when(F.size("parts") > 0, F.sequence(F.col("lowest"), highest))
        found = found.withColumn("spread", _spread(F.col("parts"), places))
        found = found.withColumn("carried", _carried(F.col("spread")))
        negative = F.col("carried.carry") < 0
        found = found.withColumn("negative", negative)
        turned = _carried(F.transform("spread", lambda digit: -digit))["digits"]
        size = F.when(F.col("negative"), turned).otherwise(F.col("carried.digits"))
        found = found.withColumn("digits", size)
        nonzero = F.transform("digits", lambda digit, n: F.when(digit != 0, n))
        found = found.withColumn("top", F.array_max(nonzero))

        def digit(down: int) -> Column:
            return F.coalesce(F.get("digits", F.col("top") - down), F.lit(0).cast("long"))

        rest = F.exists(
            F.transform("digits", lambda one, n: (one != 0) & (n < F.col("top") - 3)), lambda x: x
        )
        upper = digit(0) * (1 << BITS) + digit(1)
        # Two doubles without rounding: 40 bits each, the last one set if anything lies below.
        # Their sum is rounded, which is the only rounding there is.
        lower = (digit(2) * (1 << BITS) + digit(3)).bitwiseOR(rest.cast("long"))
        value = upper.cast("double") * float(1 << 2 * BITS) + lower.cast("double")
        value = _scaled(value, F.col("lowest") + F.col("top") - 3)
        found = found.withColumn("value", F.when(F.col("negative"), -value).otherwise(value))

        def has(place: int) -> Column:
            return F.exists(parts, lambda p: F.coalesce(p["place"] == place, F.lit(False)))

        total = (
            F.when(has(NAN) | (has(INFINITE) & has(MINUS_INFINITE)), float("nan"))
            .when(has(INFINITE), float("inf"))
            .when(has(MINUS_INFINITE), float("-inf"))
            .otherwise(F.coalesce("value", F.lit(0.0)))
        )
        found = found.withColumn(name, total)
    return found


def finished(sums: DataFrame, n_measures: int, by: int, n_plain: int = 0) -> DataFrame:
    """``k0..., m0..., p0...``: the total of every measure and plain sum, a row per group."""
    keys = [f"k{n}" for n in range(by)]
    part = F.struct("place", "s0", "s1", "s2", "s3")
    lists = [
        F.collect_list(F.when(F.col("measure") == n, part)).alias(f"m{n}")
        for n in range(n_measures)
    ]
    plain = [F.sum(f"p{n}").alias(f"p{n}") for n in range(n_plain)]
    names = [f"m{n}" for n in range(n_measures)]
    found = _rounded(sums.groupBy(*keys).agg(*lists, *plain), names)
    return found.select(*keys, *names, *[f"p{n}" for n in range(n_plain)])


def exact_sums(df: DataFrame, measures: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Per group, or over all rows, the sum of each measure under its name.

    Sums of floating columns are the doubles nearest to the true sums; whole numbers and decimals
    add up as always. Groups come under the names of ``by``; null is a group.
    """
    require_columns(df, by)
    taken = [name for name in measures if name in by]
    if taken:
        raise ValueError(f"sums cannot be named {taken}, as columns that are grouped by")
    kinds = df.select([c.alias(name) for name, c in measures.items()]).schema
    floating = [name for name in measures if is_floating(kinds[name].dataType)]
    others = [name for name in measures if name not in floating]
    plain = [measures[name] for name in others]
    if not floating:
        keys = [col(name).alias(name) for name in by]
        return df.groupBy(*keys).agg(*[sum_or_zero(c).alias(n) for n, c in zip(others, plain)])
    sums = digit_sums(df, [measures[name] for name in floating], [col(n) for n in by], plain)
    found = finished(sums, len(floating), len(by), len(plain))
    total = {name: F.col(f"m{n}") for n, name in enumerate(floating)}
    if others:
        usual = df.agg(*[sum_or_zero(c).alias(name) for name, c in zip(others, plain)]).schema
        for n, name in enumerate(others):
            total[name] = F.coalesce(F.col(f"p{n}"), F.lit(0)).cast(usual[name].dataType)
    return found.select(
        *[F.col(f"k{n}").alias(name) for n, name in enumerate(by)],
        *[total[name].alias(name) for name in measures],
    )
