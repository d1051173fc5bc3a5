"""Near-duplicate documents by weighted MinHash signatures and banded joining.

A document is the multiset of its word shingles. DartMinHash gives every distinct text a signature
whose coordinates agree with the chance of the weighted Jaccard similarity; runs of coordinates
make the keys of buckets. Texts that share a bucket are compared in two steps:

1. With the bucket's leader, the text that has the most company over all its buckets. What turns
   out similar is joined into components, so that a large group of copies costs one comparison
   per member and leader.
2. In buckets that still hold several components, texts of different components with each other,
   block by block within a task, in the first bucket that two of them share. Sketches say which
   texts may have a partner; only their bags are brought to the block, and compared there. What
   comes out is a link for each two components that are joined, not a row for each pair.

Every pair that is linked was compared exactly. Two texts of similarity 0.8 miss all common
buckets with a chance of about 2 in 100,000, and fail by their sketches with about 1 in 10,000.

Equal texts are one node from the start, named by a 64-bit hash of the text; null counts as empty.
A text without words is similar to equal texts only. A text of fewer words than a shingle is one
shingle. A null ``doc_id`` is kept, but is nobody's smallest id while there is another. Rows that
repeat an id and a text count as one document each, of which ``survivors`` keeps one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.llm.darts import signatures
from voltledger.llm.graph import components
from voltledger.llm.groups import dealt, grouped
from voltledger.llm.memory import giving_back
from voltledger.llm.words import mix, owner, salted, shingles, text_slices, word_hashes
from voltledger.session import written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# A pair of similarity s shares a bucket with a chance of 1 - (1 - s**ROWS)**BANDS.
BANDS, ROWS = 27, 5
# Sketches of one byte per coordinate; at 0.8 their error is 0.025, and four errors are allowed.
SKETCH = 256
SKETCH_FLOOR = 0.7
# Texts of one bucket that are compared in one task, on either side.
BLOCK = 250


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, how often each occurs, and where each text's begin."""
    values, offsets = shingles(*word_hashes(texts), SHINGLE_WORDS)
    text = owner(offsets)
    order = np.lexsort((values, text))
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(values)))
    return values[first], counts, np.searchsorted(text[first], np.arange(len(texts) + 1))


def bucket_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each text's buckets, one per band, and which texts have words to have any."""
    values, counts, offsets = bags(texts)
    signed = signatures(values, counts.astype(np.float64), offsets, BANDS * ROWS)
    parts = signed.reshape(len(texts), BANDS, ROWS)
    key = np.broadcast_to(salted(np.arange(BANDS, dtype=np.uint64), 21), parts.shape[:2]).copy()
    for row in range(ROWS):
        key = mix(key * np.uint64(3) + parts[:, :, row])
    return key.view(np.int64), np.diff(offsets) > 0


def members(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the n-th occurrence of a shingle is a member of its own."""
    at = np.repeat(np.arange(len(values)), counts)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(values[at] + mix(nth.astype(np.uint64))).view(np.int64))


def node_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


@giving_back
def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, text`` to ``node, keys``; a text without words is left out."""
    for rows, texts in text_slices(batches, 1):
        keys, full = bucket_keys(texts)
        offsets = np.arange(full.sum() + 1, dtype=np.int32) * BANDS
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).filter(pa.array(full)), lists], ["node", "keys"]
        )


@giving_back
def bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, text`` to ``node, bag, sketch``."""
    for rows, texts in text_slices(batches, 1):
        values, counts, offsets = bags(texts)
        sketch = signatures(values, counts.astype(np.float64), offsets, SKETCH) >> np.uint64(8)
        sketches = [row.tobytes() for row in sketch.astype(np.uint8)]
        cuts = zip(offsets[:-1], offsets[1:])
        made = [members(values[a:b], counts[a:b]) for a, b in cuts]
        ends = np.concatenate([[0], np.cumsum([len(one) for one in made])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), lists, pa.array(sketches, pa.binary())], ["node", "bag", "sketch"]
        )


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two bags, as sorted sets of members."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


@F.pandas_udf(T.DoubleType())
@giving_back
def sketched_similarity(sides: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in sides:
        left, right = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, SKETCH) for s in (a, b))
        yield pd.Series((left == right).mean(axis=1), dtype="float64")


@F.pandas_udf(T.DoubleType())
@giving_back
def bag_similarity(sides: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in sides:
        yield pd.Series([jaccard(x, y) for x, y in zip(a, b)], dtype="float64")


def linked(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose bags reach the threshold; ``known`` has ``node, bag, sketch``."""

    def both(rows: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            side_known = known.select(
                F.col("node").alias(side), F.col(column).alias(f"{column}_{side}")
            )
            rows = rows.join(side_known, side)
        return rows

    pairs = both(pairs, "sketch")
    pairs = pairs.where(sketched_similarity("sketch_a", "sketch_b") >= SKETCH_FLOOR)
    pairs = both(written(pairs.select("a", "b"), "near-candidates"), "bag")
    return written(
        pairs.where(bag_similarity("bag_a", "bag_b") >= threshold).select("a", "b"), "near-links"
    )


def keys_of(docs: DataFrame) -> DataFrame:
    """``node, keys`` per text with words, written to the shared folder."""
    texts = docs.select(node_of(F.col("text")).alias("node"), "text")
    keys = texts.mapInArrow(key_rows, "node long, keys array<long>")
    return written(keys.dropDuplicates(["node"]), "near-keys")


def company(keys: DataFrame) -> DataFrame:
    """``bucket, node, size`` for buckets of two texts or more, written to the shared folder."""
    rows = keys.select("node", F.explode("keys").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return written(rows.join(sizes, "bucket"), "near-company")


def pairs_with_leaders(shared: DataFrame) -> DataFrame:
    """Each text with the leader of each of its buckets, none twice."""
    mates = shared.groupBy("node").agg(F.sum("size").alias("mates"))
    leaders = (
        shared.join(mates, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("mates", "node")).alias("leader"))
        .select("bucket", F.col("leader.node").alias("a"))
    )
    return (
        shared.join(leaders, "bucket")
        .where("a <> node")
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


BLOCK_KEY = ("bucket", "low", "high")


def partners(block: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of a bucket block, by place, the later rows of other components that share no
    earlier bucket with it and may be similar."""
    sketch = np.frombuffer(b"".join(block["sketch"]), np.uint8).reshape(-1, SKETCH)
    keys = np.array(list(block["keys"]), np.int64)
    band = int(np.flatnonzero(keys[0] == block["bucket"].iloc[0])[0])
    part, chunk = block["component"].to_numpy(), block["chunk"].to_numpy()
    low, high = block["low"].iloc[0], block["high"].iloc[0]
    right = np.flatnonzero(chunk == high)
    for k in np.flatnonzero(chunk == low):
        others = right[right > k] if low == high else right
        others = others[part[others] != part[k]]
        others = others[(keys[others, :band] != keys[k, :band]).all(axis=1)]
        agree = (sketch[others] == sketch[k]).mean(axis=1)
        yield int(k), others[agree >= SKETCH_FLOOR]


@giving_back
def with_partners(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each block that have a partner there."""
    for block in grouped(frames, BLOCK_KEY):
        some = np.zeros(len(block), bool)
        for k, others in partners(block):
            some[others] = True
            some[k] |= len(others) > 0
        if some.any():
            yield block.loc[some, ["bucket", "low", "high", "chunk", "node", "component"]]


def joining_links(frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """From the rows with partners and their bags: similar pairs, as many as join components."""
    for block in grouped(frames, BLOCK_KEY):
        node, bag = block["node"].to_numpy(), list(block["bag"])
        root = {c: c for c in block["component"]}

        def find(c, root=root):
            while root[c] != c:
                c = root[c]
            return c

        part, found = block["component"].tolist(), []
        for k, others in partners(block):
            for other in others:
                a, b = find(part[k]), find(part[other])
                if a != b and jaccard(bag[k], bag[other]) >= threshold:
                    root[a] = b
                    found.append((node[k], node[other]))
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


def block_rows(rows: DataFrame) -> DataFrame:
    """``bucket, low, high, chunk, node, component`` of ``rows(bucket, node, component)``: the texts
    of buckets with several components, in blocks that hold every pair to be compared.

    The texts of a bucket's largest component are not compared with each other: they meet those
    outside it only. So a large group with a few other texts is sent once, and these to all of it.
    """
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("bucket")
        .agg(
            F.max(F.struct("n", "component")).alias("main"),
            F.sum("n").alias("size"),
            F.count("*").alias("components"),
        )
        .where("components > 1")
        .select(
            "bucket",
            F.col("main.component").alias("main"),
            F.ceil(F.col("main.n") / BLOCK).cast("int").alias("inside"),
            F.ceil((F.col("size") - F.col("main.n")) / BLOCK).cast("int").alias("outside"),
        )
    )
    is_main, inside = F.col("component") == F.col("main"), F.col("inside")
    place, last = F.xxhash64("node"), F.col("inside") + F.col("outside") - 1
    own = F.when(is_main, F.pmod(place, inside)).otherwise(inside + F.pmod(place, F.col("outside")))
    first = F.when(is_main, inside).otherwise(F.lit(0))
    chunk, other = F.col("chunk"), F.col("other")
    return (
        rows.join(mixed, "bucket")
        .withColumn("chunk", own.cast("int"))
        .withColumn("other", F.explode(F.sequence(first, last)))
        .select(
            "bucket",
            F.least(chunk, other).alias("low"),
            F.greatest(chunk, other).alias("high"),
            "chunk",
            "node",
            "component",
        )
    )


def links_across(
    shared: DataFrame, comps: DataFrame, keys: DataFrame, known: DataFrame, threshold: float
) -> DataFrame:
    """Links between texts of one bucket and different components, enough to join these."""
    rows = shared.join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    rows = block_rows(rows.select("bucket", "node", "component"))
    place = "bucket long, low int, high int, chunk int, node long, component long"
    sketches = known.select("node", "sketch")
    some = dealt(rows.join(keys, "node").join(sketches, "node"), BLOCK_KEY)
    some = written(some.mapInPandas(with_partners, place), "near-partners")
    whole = dealt(some.join(keys, "node").join(known, "node"), BLOCK_KEY)
    return written(
        whole.mapInPandas(
            giving_back(lambda frames: joining_links(frames, threshold)), "a long, b long"
        ),
        "near-links",
    )


def near_links(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Links ``a, b`` between nodes, enough to make all components of similar texts."""
    keys = keys_of(docs)
    shared = company(keys)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("node", node_of(F.col("text")))
    first = texts.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    wanted = first.join(shared.select("node").distinct(), "node").withColumnRenamed("node", "key")
    once = texts.join(
        wanted,
        (F.col("node") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        "left_semi",
    ).dropDuplicates(["node", "doc_id"])
    made = once.select("node", "text").mapInArrow(
        bag_rows, "node long, bag array<long>, sketch binary"
    )
    known = written(made, "near-bags")
    led = linked(pairs_with_leaders(shared), known, threshold)
    return led.unionAll(links_across(shared, components(led), keys, known, threshold))


def classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, class_id, component_id, kept`` per row of ``docs(doc_id, text)``.

    ``class_id`` is the smallest id with an equal text, ``component_id`` the smallest that links
    lead to, and ``kept`` says whether the row has that id and its text.
    """
    rows = docs.select("doc_id", node_of(F.col("text")).alias("node"))
    comps = components(near_links(docs, threshold))
    per_node = (
        rows.groupBy("node")
        .agg(F.min("doc_id").alias("class_id"))
        .join(comps, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    best = F.struct(F.col("class_id").isNull(), "class_id", "node")
    per_component = per_node.groupBy("component").agg(F.min(best).alias("best"))
    per_node = written(
        per_node.join(per_component, "component").select(
            "node",
            "class_id",
            F.col("best.class_id").alias("component_id"),
            (F.col("best.node") == F.col("node")).alias("keeper"),
        ),
        "near-classes",
    )
    return rows.join(per_node, "node").select(
        "doc_id",
        "node",
        "class_id",
        "component_id",
        (F.col("keeper") & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def survivors(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near duplicates."""
    kept = classes(docs.select("doc_id", "text"), threshold).where("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node")).distinct()
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", node_of(F.col("text")).alias("node")
    )
    mine = (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    once = rows.join(kept, mine, "left_semi").dropDuplicates(["node", "doc_id"])
    return once.select("row.*")
