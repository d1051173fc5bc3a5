"""Rows of a sorted partition, one group at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def dealt(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with those of one key in one partition, next to each other."""
    return rows.repartition(*key).sortWithinPartitions(*key)


def grouped(frames: Iterator[pd.DataFrame], key: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The groups of sorted frames, also where a group goes on in the next frame."""
    key = list(key)
    open_part: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        cuts = [0, *((keys[1:] != keys[:-1]).any(axis=1).nonzero()[0] + 1), len(frame)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            part = frame.iloc[start:end]
            if open_part and tuple(open_part[-1][key].iloc[-1]) != tuple(part[key].iloc[0]):
                yield open_part[0] if len(open_part) == 1 else pd.concat(open_part)
                open_part = []
            open_part.append(part)
    if open_part:
        yield open_part[0] if len(open_part) == 1 else pd.concat(open_part)
