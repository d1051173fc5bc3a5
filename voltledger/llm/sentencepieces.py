"""SentencePiece models run by the tokenizers library: encoding, decoding, and parity.

The model file is read as a protocol buffer by its wire format. From it are rebuilt the normaliser
(character map, white space rules, the meta symbol for a space), the unigram scores or, for a
byte-pair model, the merges in the order of their scores, and the byte fallback. Segments between
spaces are encoded once per task, by all threads, where no piece can reach over a space.

Null text encodes as empty; an empty text has no ids.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.llm.memory import giving_back
from voltledger.llm.words import text_slices

# Files above this size are refused: the model is sent to every executor.
MAX_MODEL_BYTES = 64 * 1024 * 1024
SPACE = "▁"

# Segments are forgotten when more than these are known.
KNOWN_SEGMENTS = 1 << 19
# So many segments go to a thread together.
LISTED = 1024

# Fixed values of the model format: model types and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = read_varint(data, at)
        if key & 7 == 0:
            value, at = read_varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                if key & 7 != 2:
                    raise ValueError("not a SentencePiece model")
                size, at = read_varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    character_map: bytes = b""
    dummy_prefix: bool = True
    single_spaces: bool = True
    unknown_text: str = " ⁇ "


def parse(data: bytes) -> Model:
    """A model from its file. Models that mark spaces behind words are refused."""
    pieces, scores, types = [], [], []
    trainer: dict[int, int | bytes] = {}
    normaliser: dict[int, int | bytes] = {}
    for number, value in wire_fields(data):
        if number == 1:
            piece = dict(wire_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            types.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(wire_fields(value))
        elif number == 3:
            normaliser = dict(wire_fields(value))
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE) or trainer.get(24, 0) or not normaliser.get(5, 1):
        raise ValueError("this kind of SentencePiece model is not supported")
    return Model(
        pieces, scores, types, kind, bool(trainer.get(35, 0)), normaliser.get(2, b""),
        bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)),
        trainer.get(44, " ⁇ ".encode()).decode(),
    )


def merges(model: Model) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best score first, as a byte-pair model needs it."""
    known = {
        piece: k
        for k, (piece, kind) in enumerate(zip(model.pieces, model.types))
        if kind in (NORMAL, USER_DEFINED)
    }
    ways = [
        (-model.scores[k], k, known[piece[:cut]], known[piece[cut:]], cut)
        for piece, k in known.items()
        for cut in range(1, len(piece))
        if piece[:cut] in known and piece[cut:] in known
    ]
    return [(model.pieces[k][:cut], model.pieces[k][cut:]) for _, k, _, _, cut in sorted(ways)]


class Codec:
    """Encoder and decoder of one model, made in the process that uses it."""

    def __init__(self, model: Model, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import tokenizers
        from tokenizers import decoders, models, normalizers

        unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else 0
        if model.kind == UNIGRAM:
            # Control pieces get a real space in front: no normalised text can match them.
            core_names = [
                piece if kind in (NORMAL, USER_DEFINED, BYTE) else f" {piece}"
                for piece, kind in zip(model.pieces, model.types)
            ]
            scored = list(zip(core_names, model.scores))
            core = models.Unigram(scored, unknown, model.byte_fallback)
        else:
            core_names = model.pieces
            core = models.BPE(
                {piece: k for k, piece in enumerate(core_names)},
                merges(model),
                unk_token=core_names[unknown],
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
                cache_capacity=0,
            )
        self.tokenizer = tokenizers.Tokenizer(core)
        rules = [normalizers.Precompiled(model.character_map)] if model.character_map else []
        if model.single_spaces:
            rules.append(normalizers.Replace(tokenizers.Regex(" {2,}"), " "))
            rules.append(normalizers.Strip())
        self.normalizer = normalizers.Sequence(rules) if rules else None
        self.model = model
        self.unknown = unknown
        steps = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(SPACE, " ")]
        if model.types.count(BYTE) < 256:
            steps.insert(0, decoders.Replace(core_names[unknown], model.unknown_text))
        self.tokenizer.decoder = decoders.Sequence(steps)
        # Where a piece has a space behind another sign, texts are encoded whole.
        normal = [p for p, t in zip(model.pieces, model.types) if t in (NORMAL, USER_DEFINED)]
        self.splits = not any(SPACE in piece.lstrip(SPACE) for piece in normal)
        # The bytes of text that each id stands for; the unknown one may stand for any number.
        self.n_bytes = np.array(
            [1 if t == BYTE else len(name.encode()) for name, t in zip(core_names, model.types)]
        )
        self.n_bytes[unknown] = 0
        self.forget()

    def normalise(self, text: str) -> str:
        """The normalised text, with plain spaces for the model's meta symbol."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return ""
        return (" " if self.model.dummy_prefix else "") + text.replace(SPACE, " ")

    def segments(self, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        """Parts of normalised texts that no piece reaches over, spaces with what follows them, and
        where each text's begin."""
        coded = [text.encode() for text in texts]
        cuts = np.cumsum([0, *map(len, coded)])
        whole = b"".join(coded)
        starts = np.zeros(len(whole) + 1, bool)
        starts[cuts] = True
        if self.splits:
            space = np.frombuffer(whole, np.uint8) == 32
            starts[1:-1] |= space[1:] & ~space[:-1]
        bounds = np.flatnonzero(starts).astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(whole)]
        parts = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers)
        return parts, np.searchsorted(bounds, cuts)

    def learn(self, parts: list[str]) -> np.ndarray:
        """The numbers of distinct segments. Those not known yet are encoded, in lists that all
        threads share, and it is seen which of them decode to what they were."""
        if len(self.number) > KNOWN_SEGMENTS:
            self.forget()
        numbers = np.fromiter(map(self.number.get, parts, repeat(-1)), np.int64, len(parts))
        fresh = np.flatnonzero(numbers < 0)
        numbers[fresh] = range(len(self.number), len(self.number) + len(fresh))
        new = [parts[k] for k in fresh.tolist()]
        plain = [new[k : k + LISTED] for k in range(0, len(new), LISTED)]
        lists = [[word.replace(" ", SPACE) for word in words] for words in plain]
        sizes, flats, exact = [self.sizes], [self.flat], [self.exact]
        coded = self.tokenizer.encode_batch_fast(
            lists, is_pretokenized=True, add_special_tokens=False
        )
        for words, marked, one in zip(plain, lists, coded):
            ids = one.ids
            flat = np.array(ids, np.int32)
            size = self.sizes_of(marked, flat)
            same = self.tokenizer.decode(ids, skip_special_tokens=False) == "".join(words)
            if not same:
                ends = np.cumsum(size).tolist()
                each = [ids[a:b] for a, b in zip([0, *ends], ends)]
                decoded = self.tokenizer.decode_batch(each, skip_special_tokens=False)
                same = [text == word for text, word in zip(decoded, words)]
            sizes.append(size)
            flats.append(flat)
            exact.append(np.broadcast_to(same, len(words)))
        self.number.update(zip(new, numbers[fresh].tolist()))
        self.sizes, self.flat, self.exact = map(np.concatenate, (sizes, flats, exact))
        return numbers

    def sizes_of(self, words: list[str], flat: np.ndarray) -> np.ndarray:
        """How many of the ids each word of a list has.

        No id reaches over a word's end, so that the bytes they stand for tell it. Where these are
        not those of the words (something is unknown to the model), the words are encoded again
        with their numbers.
        """
        reached = np.cumsum(self.n_bytes[flat])
        ends = np.cumsum([len(word.encode()) for word in words])
        if len(flat) and reached[-1] == ends[-1]:
            return np.diff(np.searchsorted(reached, ends) + 1, prepend=0)
        one = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(one.word_ids, np.int64), minlength=len(words))

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.exact = np.zeros(0, bool)

    def run(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, where each text's begin, and whether they decode to the text.

        Each distinct segment is encoded and decoded once as long as it is remembered; no piece
        and no sequence of fallback bytes reaches over the end of a segment.
        """
        parts, counts = self.segments([self.normalise(text) for text in texts])
        distinct = parts.dictionary_encode()
        words = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = self.learn(words)[distinct.indices.to_numpy()]
        begin = np.cumsum(self.sizes) - self.sizes
        size = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin[at], size)
        changed = np.concatenate([[0], np.cumsum(~self.exact[at])])[counts]
        return self.flat[source], ends[counts], np.diff(changed) == 0

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        whole, cuts, _ = self.run(texts)
        return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: Sequence[np.ndarray]) -> list[str]:
        texts = self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
        return [t.removeprefix(" ") for t in texts] if self.model.dummy_prefix else texts

    def plain(self, text: str) -> str:
        """What decoding must give back where nothing in the text is unknown to the model."""
        text = self.normalise(text)
        return text[1:] if self.model.dummy_prefix and text else text


@lru_cache(maxsize=2)
def codec_of(data: bytes, threads: int) -> Codec:
    """One codec per model in a worker; a task that used it lets it forget its segments."""
    return Codec(parse(data), threads)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return data


ADDED = (
    T.StructType()
    .add("ids", T.ArrayType(T.IntegerType()))
    .add("n_tokens", T.LongType())
    .add("decodes", T.BooleanType())
    .add("parity", T.BooleanType())
)


def coded(part: list[str], codec: Codec, library, threads: int) -> list[pa.Array]:
    """The columns of ``ADDED`` for some texts."""
    flat, cuts, decodes = codec.run(part)
    parity = [None] * len(part)
    if library is not None:
        expected = library.encode(part, num_threads=threads, return_type="numpy")
        ids = (flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:]))
        parity = [a == b.tobytes() for a, b in zip(ids, expected)]
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))
    columns = [lists, pa.array(np.diff(cuts), pa.int64())]
    return [*columns, pa.array(decodes, pa.bool_()), pa.array(parity, pa.bool_())]


def coded_rows(
    batches: Iterator[pa.RecordBatch], data: bytes, place: int, threads: int, verify: bool
) -> Iterator[pa.RecordBatch]:
    """The batches of a task, with the columns of ``ADDED`` for the text column at ``place``."""
    codec = codec_of(data, threads)
    library = None
    if verify:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=data)
    try:
        for own, part in text_slices(batches, place):
            columns = [*own.columns, *coded(part, codec, library, threads)]
            yield pa.RecordBatch.from_arrays(columns, [*own.schema.names, *ADDED.names])
    finally:
        codec.forget()


def with_pieces(
    docs: DataFrame, path: str, threads: int = 2, verify: bool = True, text: str = "text"
) -> DataFrame:
    """``docs`` with the ids of each text, their number, whether they decode to the normalised
    text, and ``parity``: whether the SentencePiece library gives the same ids (null unless
    ``verify``).

    Rows go through in small batches, so that a task holds the ids of few texts at a time. Columns
    of the new names that are there already are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_model(path))
    rows = docs.drop(*ADDED.names)
    names, place = rows.columns, rows.columns.index(text)
    plain = rows.toDF(*[f"c{k}" for k in range(len(names))])  # names with dots are not passed on

    @giving_back
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from coded_rows(batches, sent.value, place, threads, verify)

    made = plain.mapInArrow(code, T.StructType([*plain.schema.fields, *ADDED.fields]))
    return made.toDF(*names, *ADDED.names)


def with_text(rows: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text that their ids decode to; null ids decode as none."""
    sent = rows.sparkSession.sparkContext.broadcast(read_model(path))

    @F.pandas_udf("string")
    def decoded(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(sent.value, 2)
        for column in frames:
            given = [np.zeros(0, np.int32) if one is None else one for one in column]
            yield pd.Series(codec.decode(given), dtype="object")

    return rows.withColumn(name, decoded(F.col(ids)))
