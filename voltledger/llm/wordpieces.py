"""How many word pieces greedy longest-match-first makes of each text, in linear time.

The vocabulary is a trie over bytes with failure links. Where a walk can go no further, the link
leads to the node reached after the longest piece and those that must follow it are taken off, and
a table made beforehand says how many pieces those are; so a word is read once, and no piece is
built. All distinct words of a chunk are walked side by side, one byte at a time; the last few, the
longest, are walked one by one.

A text is parted at white space, and between letters, digits and other signs. Word-initial and
continuing pieces are told apart as in the usual vocabularies; a word that no longer piece begins
starts with the bare mark of a beginning, where the vocabulary has it, and goes on with continuing
pieces. A word that the vocabulary cannot spell is one unknown piece.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm.words import chunked

# Files above this size are refused: the automaton is sent to every executor.
MAX_VOCABULARY_BYTES = 64 * 1024 * 1024

# So many words are no longer worth a step of arrays.
FEW_WORDS = 24

WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
NONE = -1


@dataclass(frozen=True)
class Automaton:
    """Edges sorted by node * 256 + byte; failure link, pieces taken by it, and whether a node
    ends a word well, by node. ``finish`` is what is still to pop at a word's end, -1 if none."""

    edge_keys: np.ndarray
    edge_to: np.ndarray
    link: np.ndarray
    popped: np.ndarray
    finish: np.ndarray
    start: int
    inner: int

    @cached_property
    def tables(self) -> tuple[dict[int, int], list[int], list[int]]:
        """Edges, links and popped counts as Python has them, for a walk word by word."""
        edges = dict(zip(self.edge_keys.tolist(), self.edge_to.tolist()))
        return edges, self.link.tolist(), self.popped.tolist()

    def walk(self, word: bytes, node: int, count: int) -> tuple[int, int]:
        """The node and the count after the rest of a word; no node if it cannot go on."""
        edges, link, popped = self.tables
        for byte in word:
            to = edges.get(node << 8 | byte)
            while to is None:
                count += popped[node]
                node = link[node]
                if node == NONE:
                    return NONE, NONE
                to = edges.get(node << 8 | byte)
            node = to
        return node, count


def build(initial: Iterable[bytes], inner: Iterable[bytes]) -> Automaton:
    """The automaton of pieces that may begin a word and pieces that may follow one.

    Node 0 is the root for beginnings, node 1 the root for what follows. A node's failure link is
    where the walk stands after its longest piece, and further pieces as needed, are popped. An
    empty piece among the beginnings is the bare mark: it takes no byte and leads to node 1.
    """
    children: list[dict[int, int]] = [{}, {}]
    ends = [False, False]
    marked = False
    for root, pieces in ((0, initial), (1, inner)):
        for piece in pieces:
            marked = marked or (root == 0 and not piece)
            node = root
            for byte in piece:
                if byte not in children[node]:
                    children.append({})
                    ends.append(False)
                    children[node][byte] = len(children) - 1
                node = children[node][byte]
            ends[node] = bool(piece) or ends[node]
    link, popped = [NONE] * len(children), [0] * len(children)
    if marked:
        link[0], popped[0] = 1, 1
    queue = deque((child, 0, byte) for byte, child in children[0].items())
    queue.extend((child, 1, byte) for byte, child in children[1].items())
    while queue:
        node, parent, byte = queue.popleft()
        if ends[node]:
            link[node], popped[node] = 1, 1
        else:
            at, count = link[parent], popped[parent]
            while at != NONE and byte not in children[at]:
                count += popped[at]
                at = link[at]
            if at != NONE:
                link[node], popped[node] = children[at][byte], count
        queue.extend((child, node, b) for b, child in children[node].items())
    finish = [NONE] * len(children)
    finish[1] = 0
    for node in range(2, len(children)):
        at, count = node, 0
        while at not in (NONE, 1):
            count += popped[at]
            at = link[at]
        if at == 1:
            finish[node] = count
    edges = [(node << 8 | byte, to) for node, out in enumerate(children) for byte, to in out.items()]
    table = np.array(sorted(edges), np.int64).reshape(-1, 2)
    return Automaton(
        table[:, 0].copy(), table[:, 1].astype(np.int32), np.array(link, np.int32),
        np.array(popped, np.int32), np.array(finish, np.int32), 0, 1,
    )


def lengths(words: Sequence[bytes], automaton: Automaton) -> np.ndarray:
    """The number of pieces of each word, -1 where the vocabulary cannot spell it."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    node = np.zeros(len(words), np.int64)
    count = np.zeros(len(words), np.int64)
    place = np.zeros(len(words), np.int64)
    going = np.flatnonzero(sizes > 0)
    keys = automaton.edge_keys
    while len(going) > FEW_WORDS:
        key = node[going] << 8 | data[begin[going] + place[going]]
        at = np.searchsorted(keys, key)
        at[at == len(keys)] = 0
        step = keys[at] == key
        moved, stuck = going[step], going[~step]
        node[moved] = automaton.edge_to[at[step]]
        place[moved] += 1
        count[stuck] += automaton.popped[node[stuck]]
        node[stuck] = automaton.link[node[stuck]]
        count[stuck[node[stuck] == NONE]] = NONE
        going = going[(node[going] != NONE) & (place[going] < sizes[going])]
    for k in going.tolist():
        node[k], count[k] = automaton.walk(words[k][place[k] :], int(node[k]), int(count[k]))
    done = node != NONE
    rest = automaton.finish[np.where(done, node, 1)]
    spelled = done & (rest != NONE) & (sizes > 0)
    return np.where(spelled, count + rest, NONE)


def byte_of_symbol() -> dict[str, int]:
    """What byte each printable symbol of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_vocabulary(path: str) -> Automaton:
    """The automaton of a byte-level vocabulary file, in which a leading space marks a beginning."""
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    symbols = byte_of_symbol()
    special = {token["content"] for token in json.loads(content).get("added_tokens") or []}
    initial, inner = [], []
    for piece in json.loads(content)["model"]["vocab"]:
        if piece in special or any(symbol not in symbols for symbol in piece):
            continue
        raw = bytes(symbols[symbol] for symbol in piece)
        (initial if raw[:1] == b" " else inner).append(raw.removeprefix(b" "))
    return build(initial, inner)


def count_pieces(texts: Sequence[str], automaton: Automaton) -> np.ndarray:
    """Words, pieces and unknown words of each text; an unknown word counts as one piece."""
    number: dict[str, int] = {}
    found, n_words = [], []
    for text in texts:
        words = WORD.findall(text)
        n_words.append(len(words))
        found += [number.setdefault(word, len(number)) for word in words]
    each = lengths([word.encode("utf-8", "surrogatepass") for word in number], automaton)
    pieces, unknown = np.where(each < 0, 1, each), (each < 0).astype(np.int64)
    at = np.array(found, np.int64)
    offsets = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(column[at])]) for column in (pieces, unknown)]
    return np.stack([np.diff(offsets), *[s[offsets[1:]] - s[offsets[:-1]] for s in sums]], axis=1)


def with_token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` and ``n_unknown``; null and empty texts have none."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("struct<n_words:long,n_tokens:long,n_unknown:long>")
    def counted(column: pd.Series) -> pd.DataFrame:
        parts = [count_pieces(part, sent.value) for part in chunked(column)]
        rows = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
        return pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"])

    made = docs.withColumn("__counted", counted(F.col(text)))
    for name in ("n_words", "n_tokens", "n_unknown"):
        made = made.withColumn(name, F.col("__counted")[name])
    return made.drop("__counted")
