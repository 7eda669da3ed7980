"""Encoding of a corpus with a public byte-level BPE vocabulary.

The vocabulary file is serialised directly as a sentencepiece BPE model: every byte sequence becomes a
piece in the usual byte-to-letter mapping, its score is its negative rank, so that sentencepiece merges in
the order of the ranks, and the normaliser is the identity. Texts are split into pre-tokens first; pieces
of equal text are encoded once per worker. Ids are those of the vocabulary; there are no special tokens.

Null and empty texts get an empty list. Texts are never cut. Strings that look like special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The public pattern that splits text before the merges of the rank files.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_VOCABULARY = os.environ.get("WORKLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Distinct chunks a worker keeps; beyond it the memory starts anew.
CACHE_ENTRIES = 400_000
#: Chunks longer than this aren't kept.
CACHE_CHUNK_CHARS = 200


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte sequences of a rank file, in the order of their ids, which must be 0, 1, 2 ..."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"the ids of {path} aren't contiguous")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _bytes_field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model (serialised protobuf) with the tokens' ids; the id after the last is <unk>."""
    letters = byte_letters()

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _bytes_field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _int_field(3, kind)
        return _bytes_field(1, body)

    pieces = [piece("".join([letters[b] for b in token]), -float(rank), 1) for rank, token in enumerate(tokens)]
    pieces.append(piece("<unk>", 0.0, 2))
    trainer = _int_field(3, 2) + _int_field(4, len(pieces)) + _int_field(40, len(tokens))
    normaliser = _bytes_field(1, b"identity") + _bytes_field(2, b"") + b"".join(_int_field(k, 0) for k in (3, 4, 5))
    return b"".join(pieces) + _bytes_field(2, trainer) + _bytes_field(3, normaliser)


class _Uncut(Exception):
    """A chunk begins or ends with white space, so that the text can't be cut at all of its blanks."""


class Encoder:
    """Encodes on one worker. A text is cut at single blanks between other characters: no pre-token crosses
    such a place and none beside it depends on what lies beyond, so each chunk is encoded by itself."""

    _single_blank = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(PRETOKEN).findall
        self.letters = byte_letters()
        self.known = _Known(lambda chunk: np.array(self._chunk(chunk), dtype="<i4").tobytes())
        self.counted = _Known(lambda chunk: len(self._chunk(chunk)))

    def _chunk(self, chunk: str) -> list[int]:
        letters, encode = self.letters, self.processor.encode
        words = ["".join([letters[b] for b in word.encode("utf-8", "surrogatepass")]) for word in self.find(chunk)]
        return [i for word in words for i in encode(word)]

    def _parts(self, text: str, known: _Known) -> list:
        """What known has for the chunks of the text. Chunks but the first are kept without the blank before them."""
        first, *rest = text.split(" ")
        try:
            if first[-1:].isspace() or not first:
                raise _Uncut
            return [known.of(first), *map(known.__getitem__, rest)]
        except _Uncut:
            first, *rest = self._single_blank.split(text)
            if not rest:
                return [known.of(first)]
            return [known.of(first), *map(known.__getitem__, rest[:-1]), known.of(" " + rest[-1])]

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        return b"".join(self._parts(text, self.known)) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def count(self, text: str | None) -> int:
        return sum(self._parts(text, self.counted)) if text else 0


class _Known(dict):
    """Results by chunk, without the blank that precedes it; kept up to a number of entries."""

    def __init__(self, of: Callable):
        super().__init__()
        self.of = of

    def __missing__(self, chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Uncut
        found = self.of(" " + chunk)
        if len(chunk) <= CACHE_CHUNK_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = found
        return found


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(model: bytes) -> Encoder:
    """This worker's encoder of the model."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def _sparse_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(batch.schema.get_field_index(text)).to_pylist()


def encode_corpus(documents: DataFrame, text: str = "text", ids: str = "ids", keep: list[str] | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns in keep (all but text, if None) and ids, array<int>: each row's text encoded.

    One pass without a shuffle. A column of documents that is named as ids is replaced.
    """
    kept = [c for c in (keep if keep is not None else documents.columns) if c not in (text, ids)]
    model = documents.sparkSession.sparkContext.broadcast(sentencepiece_model(read_ranks(vocabulary)))
    given = documents.select(*kept, text)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model.value)
        for batch, texts in _sparse_batches(batches, text):
            parts = [encoder.encode_bytes(x) for x in texts]
            offsets = np.zeros(len(parts) + 1, "i8")
            np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
            if offsets[-1] > 2**31 - 1:
                raise ValueError("a batch has more than 2^31 ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
            flat = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), lists], names=[*kept, ids])

    return given.mapInArrow(run, schema)


def count_tokens(documents: DataFrame, text: str = "text", n_tokens: str = "n_tokens", keep: list[str] | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """As encode_corpus, with the number of ids of each row's text only."""
    kept = [c for c in (keep if keep is not None else documents.columns) if c not in (text, n_tokens)]
    model = documents.sparkSession.sparkContext.broadcast(sentencepiece_model(read_ranks(vocabulary)))
    given = documents.select(*kept, text)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(n_tokens, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model.value)
        for batch, texts in _sparse_batches(batches, text):
            counts = pa.array([encoder.count(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), counts], names=[*kept, n_tokens])

    return given.mapInArrow(run, schema)


def decode_corpus(encoded: DataFrame, ids: str = "ids", text: str = "text", keep: list[str] | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The texts of lists of ids, by the inverse mapping; a null list gives null, bytes that are no UTF-8 give U+FFFD."""
    kept = [c for c in (keep if keep is not None else encoded.columns) if c not in (text, ids)]
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    given = encoded.select(*kept, ids)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(text, T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inverse = tokens.value
        for batch in batches:
            lists = batch.column(len(kept)).to_pylist()
            texts = [None if x is None else b"".join([inverse[i] for i in x]).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), pa.array(texts, pa.string())], names=[*kept, text])

    return given.mapInArrow(run, schema)
