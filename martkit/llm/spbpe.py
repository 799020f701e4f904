"""Byte-level BPE through a sentencepiece model that is written directly from a rank vocabulary.

Each byte becomes one letter, so a vocabulary entry becomes a piece; its score is its negative rank, so that
sentencepiece, which merges the neighbours with the best score first, merges in rank order. Normalisation is
the identity. Texts are cut by the vocabulary's pattern, each match is encoded alone, and decoding looks up the
bytes of each id. The vocabulary file is a parameter; every executor opens it under the same path.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from martkit.llm.common import release_memory, slices
from martkit.llm.tokens import Pieces, TextEncoder, gather

#: Letters that stand for bytes: one block of code points, none of them white space.
FIRST_LETTER = 0x100
LETTERS = {b: FIRST_LETTER + b for b in range(256)}
#: Text that is worked on at a time; its bytes and decimal ids are gathered through indices of some sixty times its size.
SLICE_BYTES = 250_000
#: Fixed values of the sentencepiece model format: piece types, model type, field numbers.
NORMAL, UNKNOWN, BPE = 1, 2, 2


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(entry) for entry, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def serialise_model(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; one unknown piece follows them."""

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)
        return _bytes(1, body)

    pieces = b"".join(piece(letters(entry), -rank, NORMAL) for rank, entry in enumerate(entries))
    unknown = len(entries)
    trainer = _number(3, BPE) + _number(4, unknown + 1) + _number(40, unknown) + b"".join(_number(f, -1) for f in (41, 42, 43))
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + piece("<unk>", 0.0, UNKNOWN) + _bytes(2, trainer) + _bytes(3, normaliser)


class Codec:
    """Encoder and decoder of one vocabulary, for columns of texts."""

    def __init__(self, path: str, pattern: str):
        entries = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(entries))
        self.pattern = regex.compile(pattern)
        self.units = TextEncoder(self._encode_units, most=200_000)
        self.bytes, self.decimals = Pieces(np.uint8), Pieces(np.uint8)
        for i in range(len(entries)):
            piece = self.model.id_to_piece(i)
            self.bytes.append(np.array([ord(c) - FIRST_LETTER for c in piece], np.uint8))
            self.decimals.append(np.frombuffer(b"%d " % i, np.uint8))

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        split = [self.pattern.findall(u) for u in units]
        distinct = list(dict.fromkeys(t for tokens in split for t in tokens))
        known = dict(zip(distinct, self.model.encode([letters(t.encode()) for t in distinct], num_threads=1), strict=True))
        return [known[tokens[0]] if len(tokens) == 1 else [i for t in tokens for i in known[t]] for tokens in split]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.units.encode(texts)

    def _each(self, table: Pieces, ids: np.ndarray, counts: np.ndarray) -> Iterator[memoryview]:
        sizes = table.lengths[ids]
        flat = memoryview(gather(table.flat, table.offsets[ids], sizes))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        for start, end in zip(ends, ends[1:], strict=False):
            yield flat[start:end]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[memoryview]:
        """The bytes of each text."""
        return self._each(self.bytes, ids, counts)

    def decimal_ids(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[memoryview]:
        """The ids of each text in decimal, each with a space behind it."""
        return self._each(self.decimals, ids, counts)


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker: building it takes a while, and within a task it remembers pieces it has encoded."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (array), decoded (bytes) of every whole text.

    Null text counts as empty: no ids, the hashes of nothing. Row by row, no shuffle; repeated rows and null ids
    pass through. With decoded False the bytes are decoded and hashed but not shipped back from Python; ``encode_digests``
    leaves out the ids as well.
    """
    return _encode(docs, path, pattern, ("ids", "decoded") if decoded else ("ids",))


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As encode_documents, without the ids and bytes themselves."""
    return _encode(docs, path, pattern, ())


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, whole: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id and text to batches of ids and digests; whole: which of ids and decoded come along."""
    coder = codec(path, pattern)
    for batch in batches:
        for rows in slices(batch, "text", SLICE_BYTES):
            ids, counts = coder.encode(rows.column("text").fill_null(""))
            decimals = [hashlib.sha256(x[:-1]).hexdigest() for x in coder.decimal_ids(ids, counts)]
            decoded = list(coder.decode(ids, counts))
            out = {
                "doc_id": rows.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(decimals, pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
            }
            if "ids" in whole:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                out["ids"] = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))
            if "decoded" in whole:
                out["decoded"] = pa.array([x.tobytes() for x in decoded], pa.binary())
            yield pa.RecordBatch.from_pydict(out)
        release_memory()
    # A worker that waits for its next task, of this job or another, holds no pieces.
    coder.units.forget()
    release_memory()


def _encode(docs: DataFrame, path: str, pattern: str, whole: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_batches(batches, path, pattern, whole)

    types = {"ids": "array<int>", "decoded": "binary"}
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {c} {types[c]}" for c in whole)
    return docs.select(docs["doc_id"].cast("bigint"), "text").mapInArrow(run, schema)
