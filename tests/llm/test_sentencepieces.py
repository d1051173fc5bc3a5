import random
import re
import struct

import numpy as np
import pytest
import sentencepiece

from tests.llm.odd import no_documents, odd_documents
from voltledger.llm import sentencepieces
from voltledger.llm.queries import SENTENCE_PIECES as PATH
from voltledger.llm.sentencepieces import BYTE, CONTROL, NORMAL, UNKNOWN, Codec, parse

TEXTS = [
    "", "a", " a", "a  b", "   x   y ", "  ", "\n\n\t x", "日本 語 🎉", "▁x ▁▁ y", "z" * 300,
    "<s> </s> <unk> <0x41>", "     hello      world       ", "\x00 ́ é", " " * 9 + "z", "ﬁne ①",
]


def varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)


def message(*fields):
    made = b""
    for number, value in fields:
        if isinstance(value, float):
            made += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            made += varint(number << 3) + varint(value)
        else:
            made += varint(number << 3 | 2) + varint(len(value)) + value
    return made


def unigram_model(byte_fallback=True, dummy_prefix=1, single_spaces=1):
    """A small model, written piece by piece; no scores are trained."""
    rng = random.Random(4)
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)]
    words = ["▁", *"abcdeh", "▁a", "ab", "▁ab", "abc", "cd", "de", "▁he", "head", "ed", "cab", "▁c", "da"]
    pieces += [(word, -rng.uniform(1, 9), NORMAL) for word in words]
    rows = [(1, message((1, p.encode()), (2, s), (3, t))) for p, s, t in pieces]
    trainer = message((3, 1), (4, len(pieces)), (35, int(byte_fallback)), (40, 0), (41, 1), (42, 2))
    rules = message((1, b"identity"), (3, dummy_prefix), (4, single_spaces), (5, 1))
    return message(*rows, (2, trainer), (3, rules))


def both(data):
    return Codec(parse(data)), sentencepiece.SentencePieceProcessor(model_proto=data)


def check(codec, library, texts):
    ids = codec.encode(texts)
    assert [one.tolist() for one in ids] == library.encode(texts)
    decoded = codec.decode(ids)
    assert decoded == [library.decode(one.tolist()) for one in ids]
    assert codec.run(texts)[2].tolist() == [a == codec.plain(b) for a, b in zip(decoded, texts)]
    return ids


def test_the_file_against_the_library():
    codec, library = both(sentencepieces.read_model(PATH))
    assert codec.splits
    ids = check(codec, library, TEXTS)
    assert codec.decode(ids) == [codec.plain(text) for text in TEXTS]
    codec.splits = False
    assert [a.tolist() for a in codec.encode(TEXTS)] == [a.tolist() for a in ids]


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("prefix, single", [(1, 1), (0, 0), (1, 0), (0, 1)])
def test_unigram_scores_and_rules(fallback, prefix, single):
    codec, library = both(unigram_model(fallback, prefix, single))
    rng = random.Random(1)
    texts = ["".join(rng.choices("aabcdeh  é", k=rng.randint(0, 25))) for _ in range(400)]
    check(codec, library, texts)


def test_segments_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(sentencepieces, "KNOWN_SEGMENTS", 2)
    codec, library = both(sentencepieces.read_model(PATH))
    for _ in range(2):
        for text in TEXTS:
            check(codec, library, [text])


def parts_of(text):
    return re.findall(" *[^ ]+| +$", text)


def test_segments_against_a_pattern():
    codec, _ = both(sentencepieces.read_model(PATH))
    rng = random.Random(3)
    texts = ["".join(rng.choices(" aé\n▁", k=rng.randint(0, 9))) for _ in range(300)]
    texts = ["", *map(codec.normalise, texts), "", ""]
    for split, expected in ((True, parts_of), (False, lambda text: [text] if text else [])):
        codec.splits = split
        parts, begin = codec.segments(texts)
        found = [parts[a:b].to_pylist() for a, b in zip(begin[:-1], begin[1:])]
        assert found == [expected(text) for text in texts]
    assert [len(x) for x in codec.segments([])] == [0, 1]


class Counted:
    """A tokenizer that notes the lists that are encoded with their words' numbers."""

    def __init__(self, tokenizer):
        self.tokenizer, self.numbered = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode(self, words, **rules):
        self.numbered.append(words)
        return self.tokenizer.encode(words, **rules)

    def encode_batch(self, lists, **rules):
        self.numbered += lists
        return self.tokenizer.encode_batch(lists, **rules)


def test_segments_are_looked_up_once_and_encoded_without_numbers(monkeypatch):
    codec, library = both(sentencepieces.read_model(PATH))
    codec.tokenizer = Counted(codec.tokenizer)
    learned, learn = [], codec.learn
    monkeypatch.setattr(codec, "learn", lambda parts: learned.append(parts) or learn(parts))
    texts = ["so so so  so", "", "so it is 日本 🎉"] * 20
    assert [one.tolist() for one in codec.encode(texts)] == library.encode(texts)
    assert learned == [[" so", "  so", " it", " is", " 日本", " 🎉"]]
    assert codec.tokenizer.numbered == []


@pytest.mark.parametrize("fallback", [True, False])
def test_sizes_of_what_is_unknown_or_named_like_a_byte(fallback):
    codec, _ = both(unigram_model(fallback))
    codec.tokenizer = Counted(codec.tokenizer)
    rng = random.Random(2)
    signs = ["a", "b", "cab", "▁", "é", "日", "<0x41>", "<unk>", "<s>"]
    for known in (4, 9):
        for _ in range(100):
            some = signs[:known]
            words = ["".join(rng.choices(some, k=rng.randint(1, 4))) for _ in range(5)]
            one = codec.tokenizer.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
            sizes = codec.sizes_of(words, np.array(one.ids, np.int32))
            assert sizes.tolist() == [one.word_ids.count(k) for k in range(5)]
        assert bool(codec.tokenizer.numbered) == (known == 9)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sentencepieces.with_pieces(docs, PATH).collect()
    assert len(rows) == docs.count()
    assert all(row.parity and row.decodes and row.n_tokens == len(row.ids) for row in rows)
    again = sentencepieces.with_text(sentencepieces.with_pieces(docs, PATH).drop("text"), PATH)
    assert {r.doc_id: r.text for r in again.collect()} == {r.doc_id: r.text for r in rows}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sentencepieces.with_pieces(docs, PATH).collect()
    assert len(rows) == docs.count() and all(row.parity and row.decodes for row in rows)
    assert all((row.n_tokens == 0) == (not row.text) for row in rows)
    unchecked = sentencepieces.with_pieces(docs, PATH, verify=False)
    assert {row.parity for row in unchecked.collect()} == {None}
    assert sentencepieces.with_pieces(no_documents(spark), PATH).collect() == []


def test_what_is_refused(monkeypatch):
    with pytest.raises(ValueError, match="not supported"):
        parse(message((2, message((3, 3)))))
    with pytest.raises(ValueError, match="not a SentencePiece model"):
        parse(b"\x0b\x00")
    monkeypatch.setattr(sentencepieces, "MAX_MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        sentencepieces.read_model(PATH)


def test_ids_may_be_null():
    codec = Codec(parse(sentencepieces.read_model(PATH)))
    assert codec.decode([np.zeros(0, np.int32)]) == [""]
