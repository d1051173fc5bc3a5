import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from voltledger.llm.words import chunked, ngrams, owner, shingles, split_words, word_hashes

TEXTS = st.lists(st.text(st.sampled_from("abAB1 _-.\n\té日𝔘İ\x00"), max_size=30), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    hashes, offsets = word_hashes(texts)
    words = [split_words(text) for text in texts]
    assert [len(w) for w in words] == list(np.diff(offsets))
    flat = [word for part in words for word in part]
    pairs = set(zip(flat, hashes.tolist()))
    assert len(pairs) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingles_are_runs_of_words(texts):
    made, starts = shingles(*word_hashes(texts), 3)
    want = []
    for text in texts:
        words = split_words(text)
        want.append([tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else [])
    assert [len(w) for w in want] == list(np.diff(starts))
    flat = [run for part in want for run in part]
    assert len(set(zip(flat, made.tolist()))) == len(set(flat)) == len(set(made.tolist()))


def test_ngrams_stay_in_their_text():
    hashes, offsets = word_hashes(["a b c", "", "d e"])
    _, text = ngrams(hashes, owner(offsets), (0, 1))
    assert text.tolist() == [0, 0, 2]
    skip, text = ngrams(hashes, owner(offsets), (0, 2))
    assert len(skip) == 1 and text.tolist() == [0]
    assert len(ngrams(hashes, owner(offsets), (0, 9))[0]) == 0


def test_chunks_keep_order_and_nulls():
    parts = list(chunked(["ab", None, "cd" * 10, "e"], limit=64))
    assert [t for part in parts for t in part] == ["ab", "", "cd" * 10, "e"]
    assert list(chunked([])) == []


def test_a_stem_of_a_short_word_is_the_word():
    hashes, _, (stem,) = word_hashes(["ab abcd abcdef"], stems=(4,))
    assert stem[0] == hashes[0] and stem[1] == stem[2] == hashes[1]
