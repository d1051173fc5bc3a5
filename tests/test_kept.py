import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import plan
from voltledger import operators as ops
from voltledger.operators import kept

LONG = T.LongType()


def keys(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "k long, n string").repartition(3)


def test_duplicates_as_loads_come(spark, tmp_path):
    state, rng = str(tmp_path / "keys"), random.Random(1)
    loads = [[rng.choice([None, *range(60)]) for _ in range(25)] for _ in range(4)]
    every = []
    for n, values in enumerate(loads):
        ops.add_key_counts(state, f"load-{n}", keys(spark, values), "k", buckets=8)
        every += values
        found = ops.duplicated_in_load(state, keys(spark, values), "k", buckets=8).collect()
        assert sorted(map(str, (r.k for r in found))) == sorted(str(v) for v in values if every.count(v) > 1)
    repeated = {v for v in every if every.count(v) > 1}
    assert tuple(ops.kept_duplicates(spark, state, LONG).first()) == (
        len(repeated), sum(every.count(v) for v in repeated),
    )
    # A load that comes again replaces itself.
    ops.add_key_counts(state, "load-2", keys(spark, loads[2]), "k", buckets=8)
    counts = {r.key: r.n for r in ops.key_counts(spark, state, LONG).collect()}
    assert counts == {v: every.count(v) for v in every}


def test_a_load_reads_only_its_buckets(spark, tmp_path):
    state = str(tmp_path / "keys")
    ops.add_key_counts(state, "a", keys(spark, range(500)), "k", buckets=32)
    found = ops.duplicated_in_load(state, keys(spark, [3, 4, 3]), "k", buckets=32)
    scanned = [line for line in plan(found).splitlines() if "FileScan" in line]
    touched = keys(spark, [3, 4]).select(kept._bucket(F.col("k"), 32).alias("b")).distinct().collect()
    buckets = ",".join(str(b) for b in sorted(r.b for r in touched))
    folders = scanned[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert len(scanned) == 1 and f"IN ({buckets})" in folders


def slots(spark, rows):
    made = [(g, None if t is None else datetime.datetime(*t)) for g, t in rows]
    return spark.createDataFrame(made, "g string, t timestamp_ntz")


@pytest.mark.parametrize("step", [30, 60, 15, 1])
def test_slots_merge_by_load(spark, tmp_path, step):
    state, rng = str(tmp_path / "slots"), random.Random(step)
    rows, loads = [], []
    for n in range(3):
        load = []
        for _ in range(200):
            minute = rng.randrange(0, 1440 // step) * step + rng.choice([0, 0, 0, 7 if step > 7 else 0])
            at = datetime.datetime(2024, 1, rng.choice([30, 31])) + datetime.timedelta(days=n, minutes=minute)
            load.append((rng.choice(["a", "b", None]), at))
        loads.append(spark.createDataFrame([*load, ("a", None)], "g string, t timestamp_ntz"))
        rows += load
    for name, n in (("x", 2), ("y", 0), ("z", 1), ("y", 0)):
        ops.add_grid_load(state, name, loads[n], "g", "t", step)
    first, last = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)
    want = {}
    for g, at in rows:
        if first <= at.date() <= last and (at.hour * 60 + at.minute) % step == 0:
            want.setdefault((g, at.date()), []).append(at)
    got = ops.kept_day_completeness(spark, state, T.StringType(), first, last, step)
    assert {(r.group, r.day): (r.n_rows, r.n_slots, r.n_missing) for r in got.collect()} == {
        key: (len(all_), len(set(all_)), 1440 // step - len(set(all_))) for key, all_ in want.items()
    }


def test_times_between_slots_and_months_that_are_skipped(spark, tmp_path):
    state = str(tmp_path / "slots")
    rows = slots(spark, [("a", (2024, 3, 1, 0, 30)), ("a", (2024, 3, 1, 0, 30, 0, 5)), ("a", (2024, 3, 1, 0, 31)), ("a", (2024, 5, 1))])
    ops.add_grid_load(state, "x", rows, "g", "t")
    march = datetime.date(2024, 3, 1), datetime.date(2024, 3, 31)
    found = ops.kept_day_completeness(spark, state, T.StringType(), *march)
    assert [tuple(r) for r in found.collect()] == [("a", datetime.date(2024, 3, 1), 1, 1, 47)]
    scan = [line for line in plan(found).splitlines() if "FileScan" in line][0]
    assert "month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    with pytest.raises(ValueError, match="whole number"):
        ops.add_grid_load(state, "y", rows, "g", "t", 7)
    with pytest.raises(ValueError, match="cannot be named"):
        ops.add_grid_load(state, "a/b", rows, "g", "t")


def test_sketches_merge_and_their_bounds_hold(spark, tmp_path):
    state = str(tmp_path / "sketches")
    rows = spark.range(60_000).select(
        "id", (F.col("id") % 700).alias("few"), F.when(F.col("id") % 2 == 0, F.col("id") % 9_000).alias("half")
    )
    columns = ["id", "few", "half"]
    for n, some in enumerate([rows.where("id < 40000"), rows.where("id >= 20000"), rows.where("id % 5 = 0")]):
        ops.add_sketches(state, str(n), some, columns)
    bounds = {r.column: r for r in ops.kept_distinct(spark, state).collect()}
    for name, true in (("id", 60_000), ("few", 700), ("half", 4_500)):
        assert bounds[name].low <= true <= bounds[name].high
        assert bounds[name].high - bounds[name].low < 0.2 * true
    limits = {"id": 1_000, "few": 700, "half": 4_501}
    found = {r.column: (r.reached, r.counted) for r in ops.at_least_distinct(spark, state, rows, limits).collect()}
    assert found == {"id": (True, False), "few": (True, True), "half": (False, True)}
    with pytest.raises(ValueError, match="no sketches"):
        ops.at_least_distinct(spark, state, rows.withColumn("z", F.lit(1)), {"z": 1})


def test_loads_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "k long, t timestamp_ntz")
    ops.add_key_counts(str(tmp_path / "a"), "x", none, "k")
    assert tuple(ops.kept_duplicates(spark, str(tmp_path / "a"), LONG).first()) == (0, 0)
    assert ops.duplicated_in_load(str(tmp_path / "a"), none, "k").collect() == []
    ops.add_sketches(str(tmp_path / "b"), "x", none, ["k"])
    assert tuple(ops.kept_distinct(spark, str(tmp_path / "b")).first()) == ("k", 0, 0, 0)
