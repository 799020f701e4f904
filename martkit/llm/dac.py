"""Token-id files of directly addressable codes: any token is read without decoding those before it.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id, level 1 the
second chunk of those that have one, and so on. A bitmap per level marks the ids that go on to the next level,
and a rank directory holds the number of marks before every 512th bit, so the place of an id's next chunk is one
directory entry plus a count within 64 bytes. A run of ids is a run in every level, so whole documents are
read by slices.

File layout (little endian): the magic, the length of a JSON header, the header (places of the sections), then
document ids, document starts, and per level codes, bitmap, directory. Files are written by the tasks below
the shared folder; the manifest names those of the tasks that succeeded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.llm.common import file_system, new_file, slices
from martkit.llm.tokens import TextEncoder
from martkit.session import scratch_path
from martkit.sources.layers import stored

MAGIC = b"DACIDS01"
RANK_BITS = 512
#: A file is closed after the document that brings it to this many ids.
FILE_TOKENS = 4_000_000
MANIFEST = "part int, file int, path string, docs long, tokens long"
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, bitmap, directory) per level; the last level's bitmap has no mark."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        marks = POPCOUNT[bits].reshape(-1, RANK_BITS // 8).sum(1, dtype=np.uint64)
        directory = np.concatenate([[0], np.cumsum(marks)]).astype(np.uint64)
        levels.append(((rest & 255).astype(np.uint8), bits, directory))
        if not more.any():
            return levels
        rest = rest[more] >> 8


def file_bytes(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A whole file; a null document id is kept as a mark in the header."""
    numbers = np.array([d or 0 for d in doc_ids], np.int64)
    sections = [("doc_ids", numbers), ("starts", np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64))]
    for level, arrays in enumerate(pack(ids)):
        sections += [(f"{what}{level}", a) for what, a in zip(("codes", "bits", "ranks"), arrays, strict=True)]
    places, at = {}, 0
    for name, a in sections:
        places[name] = [at, len(a), a.dtype.str]
        at += a.nbytes
    nulls = [i for i, d in enumerate(doc_ids) if d is None]
    head = json.dumps({"sections": places, "null_ids": nulls}).encode()
    body = b"".join(a.tobytes() for _, a in sections)
    return MAGIC + len(head).to_bytes(8, "little") + head + body


class TokenFile:
    """Random access to one file's ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        size = int.from_bytes(data[8:16], "little")
        head = json.loads(data[16 : 16 + size])
        body, self.parts = 16 + size, {}
        for name, (at, n, kind) in head["sections"].items():
            self.parts[name] = np.frombuffer(data, kind, n, body + at)
        self.levels = sum(name.startswith("codes") for name in self.parts)
        self.starts = self.parts["starts"].astype(np.int64)
        nulls = set(head["null_ids"])
        self.doc_ids = [None if i in nulls else d for i, d in enumerate(self.parts["doc_ids"].tolist())]

    def rank(self, level: int, i: int) -> int:
        """How many of the first i ids of a level go on to the next one."""
        block, bits = i // RANK_BITS, self.parts[f"bits{level}"]
        first, last = block * (RANK_BITS // 8), i // 8
        count = int(self.parts[f"ranks{level}"][block]) + int(POPCOUNT[bits[first:last]].sum())
        return count + (int(POPCOUNT[bits[last] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        value, level = 0, 0
        while True:
            value |= int(self.parts[f"codes{level}"][i]) << 8 * level
            if not self.parts[f"bits{level}"][i // 8] >> i % 8 & 1:
                return value
            i, level = self.rank(level, i), level + 1

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids from start to end, from one slice per level."""
        out = np.zeros(end - start, np.uint32)
        where = np.arange(end - start)
        for level in range(self.levels):
            out[where] |= self.parts[f"codes{level}"][start:end].astype(np.uint32) << np.uint32(8 * level)
            first = start // 8
            bits = np.unpackbits(self.parts[f"bits{level}"][first : (end + 7) // 8], bitorder="little")
            where = where[bits[start - first * 8 :][: end - start].astype(bool)]
            if not len(where):
                break
            start = self.rank(level, start)
            end = start + len(where)
        return out

    def document(self, i: int) -> np.ndarray:
        return self.tokens(self.starts[i], self.starts[i + 1])


class _Encoder:
    """Ids by the tokenizers library: its pre-tokenizer and its model, called in turn for distinct pieces.

    A piece of letters, with or without a space before it, is one pre-token, so the pre-tokenizer isn't asked.
    """

    def __init__(self, path: str):
        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # The letters that byte-level vocabularies write for bytes: printable ones stand for themselves.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.letters = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
        self.space = chr(self.letters[32])
        self.plain = tokenizer.normalizer is None and letters_alone(tokenizer, self.letters)
        self.tail = {c: self._ids(c) for c in ".,"}
        self.units = TextEncoder(self._encode_units)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        # A full stop or comma behind a letter, at a unit's end, is a piece of its own.
        tail, known, out = self.tail, {}, []
        tokenize, letters, space, plain = self.model.tokenize, self.letters, self.space, self.plain
        for unit in units:
            end = tail.get(unit[-1:])
            stem = unit[:-1] if end and unit[-2:-1].isalpha() else unit
            ids = known.get(stem)
            if ids is None:
                word = stem[1:] if stem[:1] == " " else stem
                if plain and word.isalpha():
                    if not stem.isascii():
                        spelled = stem.encode().decode("latin-1").translate(letters)
                    else:  # ASCII letters stand for themselves
                        spelled = space + word if len(word) < len(stem) else word
                    ids = [t.id for t in tokenize(spelled)]
                else:
                    ids = self._ids(stem)
                known[stem] = ids
            out.append(ids if stem is unit else ids + end)
        return out


def letters_alone(tokenizer: tokenizers.Tokenizer, letters: dict[int, int]) -> bool:
    """True if the pre-tokenizer maps bytes as expected and keeps a space and letters together."""
    probe = " añb"
    return [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == [probe.encode().decode("latin-1").translate(letters)]


@lru_cache(2)
def encoder(path: str) -> TextEncoder:
    """One per Python worker. The strings of added tokens are ordinary text."""
    return _Encoder(path).units


class PlainCall:
    """What the library gives for whole texts without its post-processor's tokens: ids of added tokens for their strings.

    Texts that hold such a string go to the library whole, all others piece by piece.
    """

    def __init__(self, path: str):
        self.tokenizer, self.units = tokenizers.Tokenizer.from_file(path), encoder(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self.units.encode(texts)
        ids, counts = self.units.encode(pc.if_else(pa.array(whole), "", texts))
        rows = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(whole):
            rows[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(rows), np.array([len(r) for r in rows])


@lru_cache(2)
def plain_call(path: str) -> PlainCall:
    """One per Python worker."""
    return PlainCall(path)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Encode every whole text, append end_id, write files in ascending doc_id order; returns the manifest.

    Ids are those of the library's call with add_special_tokens=False. Null text counts as empty; rows with a null id
    come first, rows with one id in the order of their texts. Documents are dealt to tasks by ranges of doc_id, each task writes its range's files, so files in the order
    (part, file) hold the corpus in order.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part, found = plain_call(tokenizer), TaskContext.get().partitionId(), []
        held: list = [[], [], [], 0]

        def flush() -> None:
            path, system, inner = new_file(folder, ".dac")
            with system.open_output_stream(inner) as out:
                out.write(file_bytes(held[0], held[1], np.concatenate(held[2])))
            found.append({"part": part, "file": len(found), "path": path, "docs": len(held[0]), "tokens": held[3]})
            held[:] = [[], [], [], 0]

        for batch in batches:
            for rows in slices(batch, "text", 4_000_000):
                ids, counts = units.encode(rows.column("text").fill_null(""))
                ends = np.cumsum(counts)
                held[0] += rows.column("doc_id").to_pylist()
                held[1] += (counts + 1).tolist()
                held[2].append(np.insert(ids, ends, end_id))
                held[3] += len(ids) + len(counts)
                if held[3] >= file_tokens:
                    flush()
        if held[0]:
            flush()
        fields = [("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema(fields))

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ordered.mapInArrow(write, MANIFEST), "token-files")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add to each file the number of ids in all files before it: sums within a part, then over the parts."""
    within = W.partitionBy("part").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("all"))
    starts = parts.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    inner = F.coalesce(F.sum("tokens").over(within), F.lit(0))
    return manifest.withColumn("inner", inner).join(starts, "part").withColumn("start", F.col("before") + F.col("inner")).drop("inner", "before")


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                system, inner = file_system(entry["path"])
                with system.open_input_file(inner) as stream:
                    tokens = TokenFile(stream.read())
                for first in range(0, entry["docs"], 2000):
                    which = range(first, min(first + 2000, entry["docs"]))
                    # One run of ids for all these documents, cut at their starts.
                    starts = tokens.starts[first : which.stop + 1]
                    run = tokens.tokens(starts[0], starts[-1]).astype("<u4")
                    ids = [run[a:b] for a, b in zip((starts[:-1] - starts[0]).tolist(), (starts[1:] - starts[0]).tolist(), strict=True)]
                    out = {
                        "doc_id": pa.array([tokens.doc_ids[i] for i in which], pa.int64()),
                        "start": pa.array([entry["start"] + int(tokens.starts[i]) for i in which], pa.int64()),
                        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(out)

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = with_starts(manifest).repartition(spread, "path")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return files.mapInArrow(read, schema)
