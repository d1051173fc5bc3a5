import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from voltledger import operators as ops


def true_sum(values):
    """The double nearest to the sum, by fractions."""
    values = [v for v in values if v is not None]
    if any(math.isnan(v) for v in values) or {math.inf, -math.inf} <= set(values):
        return math.nan
    for infinite in (math.inf, -math.inf):
        if infinite in values:
            return infinite
    total = sum((Fraction(v) for v in values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def bits(value):
    return "nan" if math.isnan(value) else struct.pack(">d", value)


def any_double(rng):
    return struct.unpack(">d", rng.randbytes(8))[0]


def lists():
    """Lists of doubles of every kind: any bits, one size, cancelling, tiny, ties, special ones."""
    rng = random.Random(20)
    for n in range(60):
        yield [any_double(rng) for _ in range(rng.randrange(1, 12))]
        yield [rng.uniform(-1, 1) * 2.0 ** rng.randint(-30, 30) for _ in range(40)]
        far = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-1074, 1000) for _ in range(9)]
        yield far + [-v for v in far] + [rng.uniform(0, 1) * 2.0**-1060]
        yield [5e-324 * rng.randrange(-9, 9) for _ in range(7)]
        # Halfway between two doubles, and a little to either side of it.
        whole = float(rng.randrange(2**52, 2**53))
        yield [whole, 0.5, rng.choice([0.0, 2.0**-80, -(2.0**-80), 5e-324, -5e-324])]
        yield [2.0 ** (20 * n - 600)] * rng.randrange(1, 5) + [-(2.0 ** (20 * n - 620))]
    nan, inf, most = math.nan, math.inf, 1.7976931348623157e308
    yield from ([nan], [inf, 1.0], [-inf, most], [inf, -inf], [nan, inf, -inf], [None], [None, 1.5])
    yield from ([most, most], [most, most, -most], [-most, -most, 1e300], [most, 2.0**969], [most, 2.0**970])
    yield from ([-0.0], [0.0, -0.0], [1.0, -1.0], [0.1] * 10, [1e16, 1.0, 1.0], [2.0**53, 1.0, 2.0**-1074])


@pytest.fixture(scope="module")
def numbers(spark):
    data = [(n, v) for n, one in enumerate(lists()) for v in one]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, "n int, x double").cache()


def test_sums_are_the_nearest_doubles(numbers):
    got = {r.n: r.x for r in ops.group_sums(numbers, "n", ["x"], exact=True).collect()}
    want = {n: true_sum(one) for n, one in enumerate(lists())}
    assert len(want) > 370 and got.keys() == want.keys()
    assert {n: bits(got[n]) for n in got} == {n: bits(want[n] + 0.0) for n in want}


def test_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(8)
    data = [(k % 3, rng.gauss(0, 1) * 10.0 ** rng.randint(-8, 12), k) for k in range(5_000)]
    df = spark.createDataFrame(data, "k int, x double, n long")
    seen = set()
    for parts in (1, 7, 200):
        dealt = df.repartition(parts, F.rand(parts))
        rows = sorted(ops.group_sums(dealt, "k", ["x"], exact=True).collect())
        whole = ops.sum_columns(dealt, ["x", "n"], exact=True).first()
        seen.add((*(bits(r.x) for r in rows), bits(whole.x), whole.n))
    assert seen == {
        (*(bits(true_sum([x for k, x, _ in data if k == n])) for n in range(3)), bits(true_sum([x for _, x, _ in data])), 12_497_500)
    }


def test_no_rows_and_types(spark):
    schema = "k string, x double, y float, n int, d decimal(9,2)"
    none = spark.createDataFrame([], schema)
    total = ops.sum_columns(none, ["n", "x", "d", "y"], exact=True)
    plain = ops.sum_columns(none, ["n", "x", "d", "y"])
    assert total.columns == plain.columns
    assert [f.dataType for f in total.schema] == [f.dataType for f in plain.schema]
    assert tuple(total.first()) == (0, 0.0, 0, 0.0)
    assert ops.group_sums(none, "k", ["x"], exact=True).collect() == []
    one = spark.createDataFrame([(None, 0.1, 0.5, 3, None), (None, 0.2, 0.25, 4, None)], schema)
    assert tuple(ops.sum_columns(one, ["n", "x", "d", "y"], exact=True).first()) == (7, 0.1 + 0.2, 0, 0.75)
    assert ops.group_sums(one, "k", ["n"], exact=True).collect() == [(None, 7)]


def test_names_that_the_work_uses_itself(spark):
    names = ["measure", "place", "k0", "m0", "s0", "x", "a.b"]
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)] * 2, [f"`{n}`" for n in names]).toDF(*names)
    assert tuple(ops.sum_columns(df, names, exact=True).first()) == (2, 4, 6, 8, 10, 12, 14)
    assert tuple(ops.group_sums(df, "place", ["a.b", "k0"], exact=True).first()) == (2, 14, 6)
    with pytest.raises(ValueError, match="grouped by"):
        ops.group_sums(df, "x", ["x"], exact=True)


def test_share_and_reconciliation(spark):
    data = [("a", 0.1), ("a", 0.2), ("b", 0.3), (None, 1e16), (None, 1.0), (None, -1e16)]
    df = spark.createDataFrame(data, "k string, x double")
    rows = ops.group_share(df, "k", "x", "share", exact=True).collect()
    assert [tuple(r) for r in rows] == [(None, 1.0, 62.5), ("b", 0.3, 18.75), ("a", 0.1 + 0.2, 18.75)] or [
        tuple(r) for r in rows
    ] == [(None, 1.0, 62.5), ("a", 0.1 + 0.2, 18.75), ("b", 0.3, 18.75)]
    found = ops.reconcile(
        df,
        {"all": (F.col("x"), None), "a": (F.col("x"), F.col("k") == "a"), "none": (F.col("x"), F.col("k") == "z")},
        {"rest": F.col("all") - F.col("a")},
        exact=True,
    )
    assert tuple(found.first()) == (true_sum([x for _, x in data]), 0.1 + 0.2, 0.0, 1.6 - (0.1 + 0.2))
