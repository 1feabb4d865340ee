"""Byte-level BPE encoding and decoding through a sentencepiece model.

A vocabulary of byte strings with ranks is written out as a sentencepiece BPE model,
without training: byte ``b`` is spelt as the character ``FIRST_CHARACTER + b``, a
piece's score is its negative rank, and nothing is normalised. Merging the pair with the
highest score is then merging the pair with the lowest rank. Texts are split by a
pattern, and every pre-token is encoded for itself. A pre-token that is in the
vocabulary as a whole is one id, also where merges would not lead there.
"""

import base64
import struct
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, types as T

from .pretokens import Encoder
from .shipping import in_arrow

#: Rows that are encoded or decoded before they are handed on.
ROWS = 1_000
# Letters without case mapping or composition that a normaliser could touch.
FIRST_CHARACTER = 0x4E00
_SPELT = {b: FIRST_CHARACTER + b for b in range(256)}

# Field numbers and enum values of sentencepiece's model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _BPE, _VOCAB_SIZE = 3, 2, 4
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a ``.tiktoken`` file, by rank."""
    with open(path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(number: int) -> bytes:
    number &= (1 << 64) - 1
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def spelt(piece: bytes) -> str:
    return piece.decode("latin-1").translate(_SPELT)


def serialised_model(ranks: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the id behind them is unknown."""
    pieces = [
        _bytes(_PIECE, spelt(piece).encode()) + _float(_SCORE, -rank) + _number(_TYPE, _NORMAL)
        for rank, piece in enumerate(ranks)
    ]
    pieces.append(_bytes(_PIECE, b"<unk>") + _float(_SCORE, 0) + _number(_TYPE, _UNKNOWN))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, len(pieces))
    trainer += _number(_UNK_ID, len(ranks)) + b"".join(
        _number(field, -1) for field in (_BOS_ID, _EOS_ID, _PAD_ID)
    )
    plain = _bytes(_NAME, b"identity") + b"".join(
        _number(field, 0) for field in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES)
    )
    model = b"".join(_bytes(_PIECES, piece) for piece in pieces)
    return model + _bytes(_TRAINER, trainer) + _bytes(_NORMALIZER, plain)


class Bpe:
    """Encodes and decodes with the vocabulary in ``path``; ids are 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        self.pieces = _pieces(path)
        self.whole = {piece: struct.pack("<I", i) for i, piece in enumerate(self.pieces)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.pieces))
        self.pattern = regex.compile(pattern)
        self.encoder = Encoder(self._every_match)

    def _every_match(self, text: str) -> bytes:
        return b"".join(map(self._match, self.pattern.findall(text)))

    def _match(self, match: str) -> bytes:
        piece = match.encode()
        known = self.whole.get(piece)
        if known is not None:
            return known
        return np.array(self.model.encode(spelt(piece)), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encoder.encode(text)

    def decode(self, ids: bytes) -> bytes:
        return decoded(self.pieces, ids)


def decoded(pieces: list[bytes], ids: bytes) -> bytes:
    return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


@cache
def _pieces(path: str) -> list[bytes]:
    return read_ranks(path)


@cache
def _bpe(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def encode_texts(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``documents`` with ``ids``: little-endian unsigned 32-bit integers, as binary.

    ``path`` names the vocabulary, which must be there on every machine. NULL and empty
    texts have no ids. Columns pass through, but an older ``ids`` is replaced.
    """
    rows = documents.drop("ids")
    text_at = rows.columns.index("text")
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.BinaryType())])

    def encode(batches):
        bpe = _bpe(path, pattern)
        bpe.encoder.forget()  # a task that was ended early may have left more
        for batch in _slices(batches):
            ids = [bpe.encode(text or "") for text in _texts(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], schema.names)
        bpe.encoder.forget()
        pa.default_memory_pool().release_unused()

    return in_arrow(rows, encode, schema)


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ``ids`` stand for (NULL: none)."""
    rows = encoded.drop("decoded")
    ids_at = rows.columns.index("ids")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])

    def decode(batches):
        pieces = _pieces(path)
        for batch in _slices(batches):
            texts = [decoded(pieces, ids.as_py() or b"") for ids in batch.column(ids_at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], schema.names)
        pa.default_memory_pool().release_unused()

    return in_arrow(rows, decode, schema)


def _slices(batches):
    """Batches of ``ROWS`` rows at most: results are held for one at a time, and idle workers keep what they held."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _texts(column: pa.Array):
    """One at a time, so that a batch is not held twice."""
    return (value.as_py() for value in column)
