import random
import time

import pytest

from tests.llm.odd import no_documents, odd_documents
from voltledger.llm import wordpieces
from voltledger.llm.queries import WORD_PIECES as PATH


def greedy(word, initial, inner):
    """Longest match first; a word that nothing else begins takes the bare mark, if there is one."""
    at = n = 0
    if b"" in initial and not any(word[:e] in initial for e in range(1, len(word) + 1)):
        initial, n = inner, 1
    while at < len(word):
        known = inner if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


@pytest.mark.parametrize("seed", range(60))
def test_lengths_are_those_of_greedy_search(seed):
    rng = random.Random(seed)

    def some(n, longest):
        return [bytes(rng.choices(b"abc", k=rng.randint(1, longest))) for _ in range(n)]

    initial, inner = set(some(6, 4)), set(some(6, 4))
    words = [*some(200, 9), b""]
    want = [greedy(word, initial, inner) if word else -1 for word in words]
    assert wordpieces.lengths(words, wordpieces.build(initial, inner)).tolist() == want


@pytest.mark.parametrize("few", [0, 5, 10**6])
def test_words_walked_one_by_one(monkeypatch, few):
    monkeypatch.setattr(wordpieces, "FEW_WORDS", few)
    rng = random.Random(few)
    initial, inner = {b"a", b"ab", b"abca", b"c", b""}, {b"a", b"bc", b"cab", b"c"}
    words = [bytes(rng.choices(b"abc", k=rng.randint(1, 30))) for _ in range(300)]
    want = [greedy(word, initial, inner) for word in words]
    assert wordpieces.lengths(words, wordpieces.build(initial, inner)).tolist() == want


def test_a_word_of_ten_million_bytes():
    automaton = wordpieces.read_vocabulary(PATH)
    unit = "日本語の文章ですSomeunspacedtext".encode()
    part = unit * 2_000
    one, two = wordpieces.lengths([part, part * 2], automaton).tolist()
    word = unit * (10_000_000 // len(part) * 2_000)
    start = time.monotonic()
    (n,) = wordpieces.lengths([word], automaton)
    assert n == one + (two - one) * (len(word) // len(part) - 1)
    assert time.monotonic() - start < 40


def plain_counts(text, initial, inner):
    each = [greedy(w.encode(), initial, inner) for w in wordpieces.WORD.findall(text or "")]
    return len(each), sum(max(1, n) for n in each), sum(n < 0 for n in each)


@pytest.fixture(scope="module")
def vocabulary():
    import json

    symbols = wordpieces.byte_of_symbol()
    with open(PATH) as file:
        pieces = json.load(file)["model"]["vocab"]
    raw = [bytes(symbols[s] for s in p) for p in pieces if all(s in symbols for s in p)]
    initial = {piece[1:] for piece in raw if piece[:1] == b" "}
    return initial, {piece for piece in raw if piece[:1] != b" "}


def test_given_table_against_greedy_search(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in wordpieces.with_token_counts(docs, PATH).collect():
        assert (row.n_words, row.n_tokens, row.n_unknown) == plain_counts(row.text, *vocabulary)


def test_odd_rows(spark, vocabulary):
    docs = odd_documents(spark)
    rows = wordpieces.with_token_counts(docs, PATH).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert (row.n_words, row.n_tokens, row.n_unknown) == plain_counts(row.text, *vocabulary)
    assert wordpieces.with_token_counts(no_documents(spark), PATH).collect() == []


def test_a_large_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(wordpieces, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        wordpieces.read_vocabulary(PATH)


def greedy_whole(word, pieces):
    """Longest match over the whole vocabulary, of the word with the space before it."""
    rest, n = b" " + word, 0
    while rest:
        end = next((e for e in range(len(rest), 0, -1) if rest[:e] in pieces), None)
        if end is None:
            return -1
        rest, n = rest[end:], n + 1
    return n


@pytest.mark.parametrize("seed", range(60))
def test_lengths_with_a_bare_mark_are_those_of_greedy_search(seed):
    rng = random.Random(seed)

    def some(n, longest):
        return [bytes(rng.choices(b"abc", k=rng.randint(1, longest))) for _ in range(n)]

    initial, inner = {*some(4, 4), b""}, set(some(6, 4))
    words = some(200, 9)
    want = [greedy_whole(word, {b" " + piece for piece in initial} | inner) for word in words]
    assert wordpieces.lengths(words, wordpieces.build(initial, inner)).tolist() == want


def test_scripts_without_a_beginning_of_their_own(spark, vocabulary):
    initial, inner = vocabulary
    pieces = {b" " + piece for piece in initial} | inner | {b" "}
    texts = [
        "\u4e2d\u6587", "\u4f60\u597d\uff0c\u4e16\u754c", "\u4e2d\u6587" * 2_000, "\ud55c\uad6d\uc5b4 \ud14d\uc2a4\ud2b8",
        "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e0a\u0e32\u0e27\u0e42\u0e25\u0e01", "\U0001f389\U0001f680 \U0001f1eb\U0001f1f7 \U0001f9d1\u200d\U0001f4bb", "plain words \u6df7\u3056\u308b",
        "\x00 \x7f", "\U00020000\ue000",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in wordpieces.with_token_counts(docs, PATH).collect():
        each = [greedy_whole(word.encode(), pieces) for word in wordpieces.WORD.findall(row.text)]
        assert (row.n_words, row.n_tokens, row.n_unknown) == (len(each), sum(each), 0)
