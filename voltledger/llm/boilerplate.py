"""Removal of lines that stand on many sites, found by their distinct-site spread.

Each line hash gets a HyperLogLog sketch of the sites it stands on; sketches merge as rows are
aggregated. Lines whose estimate lies near the threshold get an exact count of their sites, and
the others are decided by the estimate. A boilerplate line stays where it comes first (lowest
``doc_id``, then place) and goes everywhere else. DataFrame functions only.

How many sites make a line boilerplate may follow from the table (``sites_needed``): a line that
half of all sites share, or ten of them, or three if it is long. That is a rule about the whole
table, so a part of it, with other sites, may have other results.

A line is compared without the blanks around it; blank lines are left alone. Null text stays null,
a null site is no site, and a null ``doc_id`` comes first. Rows that repeat an id and a text are
treated alike. Two lines are one when two 64-bit hashes of them agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.session import written

# A line that stands on so many sites is boilerplate.
MIN_SITES = 10
# Where long lines have a rule of their own: so many characters, and so many sites.
LONG_CHARS = 200
LONG_SITES = 3
# Sketches of 2**12 cells have a standard error of 1.6 %; estimates within a quarter of the
# threshold, over ten such errors, are not relied on.
SKETCH_BITS = 12
NEAR = 0.25


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def sites_needed(docs: DataFrame, site: str = "source") -> tuple[int, int]:
    """How many sites make a line boilerplate among ``docs``, and how many a long line: half of the
    sites that there are, at least 2 and at most ``MIN_SITES`` or ``LONG_SITES``."""
    n = docs.agg(F.countDistinct(F.col(site).cast("string"))).first()[0]
    least = max(2, min(MIN_SITES, (n + 1) // 2))
    return least, min(LONG_SITES, least)


def line_rows(docs: DataFrame, site: str) -> DataFrame:
    """One row per line that is not blank: where it stands, and its hashes."""
    line = F.btrim(F.col("line"), F.lit(" \t\r"))
    return (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            F.col(site).cast("string").alias("site"),
            F.posexplode(split_lines(F.col("text"))).alias("place", "line"),
        )
        .where(line != "")
        .select(
            "doc_id",
            "text_key",
            "site",
            "place",
            F.xxhash64(line).alias("line_a"),
            F.xxhash64(F.lit(1), line).alias("line_b"),
            (F.char_length(line) >= LONG_CHARS).alias("long"),
        )
    )


def spread(lines: DataFrame, keys: list[str], least: Column) -> DataFrame:
    """Line hashes with an estimated spread of ``least`` sites or more, and their first place."""
    return (
        lines.groupBy(*keys)
        .agg(
            F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"),
            F.min(F.struct("doc_id", "place")).alias("first"),
        )
        .select(*keys, "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= least)
    )


def removals(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    site: str = "source",
    long_sites: int | None = None,
) -> DataFrame:
    """Per text, the sorted places of the lines to remove: ``doc_id, text_key, places``.

    Lines of ``LONG_CHARS`` or more need ``long_sites`` only, if that is given.
    Lines that may be boilerplate are written to the shared folder, and so are the places where
    they stand; the lines of all texts are never shuffled but as hashes, and never twice where
    the candidates are few.
    """
    lines = line_rows(docs, site)
    keys, least = ["line_a", "line_b"], F.lit(min_sites)
    if long_sites is None:
        lines = lines.drop("long")
    else:
        keys, least = [*keys, "long"], F.when(F.col("long"), long_sites).otherwise(min_sites)
    low, high = least * (1 - NEAR), least * (1 + NEAR)
    candidates = written(spread(lines, keys, low), "line-candidates")
    found = written(lines.join(candidates, keys), "line-places")
    exact = (
        found.where(F.col("sites") <= high)
        .groupBy(*keys)
        .agg(F.countDistinct("site").alias("n"))
        .where(F.col("n") >= least)
    )
    clear = candidates.where(F.col("sites") > high)
    boilerplate = clear.select(*keys).unionAll(exact.select(*keys))
    here = F.struct("doc_id", "place")
    return (
        found.join(boilerplate, keys)
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )


def without_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    site: str = "source",
    count: str = "n_removed",
    long_sites: int | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines out of ``text``, and how many in the new column ``count``.

    What stays between two removed lines is cut out as a slice, so that the work on a text grows
    with its lines only. A column named as the new one is replaced.
    """
    names = [name for name in docs.columns if name != count]
    gone = removals(docs, min_sites, site, long_sites).select(
        F.col("doc_id").alias("gone_id"),
        F.col("text_key").alias("gone_key"),
        F.concat(F.array(F.lit(-1)), "places").alias("gone_places"),
    )
    rows = docs.select(
        F.struct(*[f"`{name}`" for name in names if name != "text"]).alias("row"),
        F.xxhash64("text").alias("text_key"),
        split_lines(F.col("text")).alias("lines"),
    )
    joined = rows.join(
        gone,
        F.col("row.doc_id").eqNullSafe(F.col("gone_id"))
        & (F.col("text_key") == F.col("gone_key")),
        "left",
    )
    kept = F.flatten(
        F.transform(
            "gone_places",
            lambda place, k: F.slice(
                "lines",
                place + 2,
                F.coalesce(F.get("gone_places", k + 1), F.size("lines")) - place - 1,
            ),
        )
    )
    lines = F.when(F.col("gone_places").isNull(), F.col("lines")).otherwise(kept)
    columns = [
        F.array_join(lines, "\n").alias("text") if name == "text" else F.col(f"row.`{name}`")
        for name in names
    ]
    removed = F.coalesce(F.size("gone_places") - 1, F.lit(0)).cast("long")
    return joined.select(*columns, removed.alias(count))
