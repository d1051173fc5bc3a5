"""Hashed words and word shingles of many texts at once, as flat numpy arrays.

A word is a longest run of ASCII letters and digits and of any characters beyond ASCII, in lower
case; everything else parts words. ``split_words`` says the same thing in plain Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

# Texts are worked on together up to this many characters; a longer text is worked on by itself.
CHUNK_CHARS = 1 << 20

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")

# An odd base and its inverse modulo 2**64: prefix sums of byte * BASE**i hash any run of bytes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_WORD_BYTES = np.zeros(256, np.uint8)
for _byte in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _WORD_BYTES[_byte] = _byte
_powers: dict[int, np.ndarray] = {}


def split_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x ^ mix(np.array([salt], np.uint64)))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call up to the usual chunk."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_CHARS), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if len(known) <= 8 * CHUNK_CHARS:
            _powers[base] = known
    return known[:n]


def forget_powers() -> None:
    _powers.clear()


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[start:end] for each run; codes are bytes, none of them 0."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(codes) + 1)[starts])


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def chunked(texts: Iterable[str | None], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The texts in order, null as empty, in lists of about ``limit`` characters."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= limit or len(part) >= limit // 16:
            yield part
            part, size = [], 0
    if part:
        yield part


def text_slices(
    batches: Iterator[pa.RecordBatch], place: int
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with the texts of one column, as ``chunked`` cuts them."""
    for batch in batches:
        start = 0
        for part in chunked(one.as_py() for one in batch.column(place)):
            yield batch.slice(start, len(part)), part
            start += len(part)


def joined_bytes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes with a line feed between them, and the line feeds' places."""
    whole = "\n".join([t.replace("\n", " ") for t in texts]).encode("utf-8", "surrogatepass")
    data = np.frombuffer(whole, np.uint8)
    return data, np.flatnonzero(data == 10)


def word_hashes(
    texts: Sequence[str], stems: Sequence[int] = ()
) -> tuple[np.ndarray, np.ndarray] | tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The hash of every word, and where each text's words begin (one more entry than texts).

    With ``stems`` also, for each of these numbers, the hash of every word's first so many bytes.
    """
    if not texts:
        none = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        return (*none, [none[0] for _ in stems]) if stems else none
    data, breaks = joined_bytes([t.lower() for t in texts])
    codes = _WORD_BYTES[data]
    starts, ends = runs(codes > 0)
    offsets = np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]])
    hashes = run_hashes(codes, starts, ends)
    if not stems:
        return hashes, offsets
    cut = [run_hashes(codes, starts, np.minimum(ends, starts + stem)) for stem in stems]
    return hashes, offsets, cut


def owner(offsets: np.ndarray) -> np.ndarray:
    """The number of the text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingles(
    hashes: np.ndarray, offsets: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words in its text, and offsets as for words.

    A text of fewer words has one shingle, all of it; a text without words has none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(made)])
    if not starts[-1]:
        return np.zeros(0, np.uint64), starts
    first = np.arange(starts[-1]) - np.repeat(starts[:-1] - offsets[:-1], made)
    end = np.repeat(offsets[1:], made)
    total = np.zeros(len(first), np.uint64)
    for step, factor in enumerate(powers(BASE, size + 1)[1:]):
        at = first + step
        total += np.where(at < end, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0)) * factor
    return mix(total), starts


def ngrams(
    stream: np.ndarray, text: np.ndarray, gaps: Sequence[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words at i + gap for each gap, all in one text, and the number of that text."""
    reach = gaps[-1]
    n = max(0, len(stream) - reach)
    total = np.zeros(n, np.uint64)
    for gap, factor in zip(gaps, powers(BASE, 64)[1:]):
        total += stream[gap : gap + n] * factor
    inside = text[:n] == text[reach : reach + n]
    return mix(total)[inside], text[:n][inside]
