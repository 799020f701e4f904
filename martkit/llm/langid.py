"""Language by compression: the language whose dictionary makes a text smallest.

Each language gets a raw-content zstandard dictionary of text pieces in it. A text is cut into short blocks, so
that what a block repeats must come from a dictionary and not from the text itself; all blocks are encoded
with every dictionary and the smallest total wins. If the runner-up is hardly larger, the text is rejected.

The dictionaries are the model: ``dictionary_bytes`` per language, taken from pieces of a bounded number of
training texts (twice as many as fill a dictionary). Prediction is row by row over whole texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.llm.common import held_out, release_memory, slices

UNKNOWN = "und"
DICTIONARY_BYTES = 32_000
PIECE_CHARS = 300
LEVEL = 9
BLOCK_BYTES = 1024
#: A text is rejected when the runner-up is larger by less than this share of its size.
MARGIN = 0.002


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, the most frequent language first (it wins exact ties)."""

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    level: int = LEVEL
    block_bytes: int = BLOCK_BYTES
    margin: float = MARGIN

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        out = []
        for lang, content in self.dictionaries.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=self.level)
            compressor = zstandard.ZstdCompressor(
                level=self.level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            out.append((lang, compressor))
        return out

    def classify(self, text: bytes, compressors) -> tuple[str, float]:
        """(language, margin) of a lower-case text; margin is how much smaller the best is than the next, 0 to 1."""
        blocks = [text[i : i + self.block_bytes] for i in range(0, len(text), self.block_bytes)]
        best, least, runner_up = UNKNOWN, None, None
        for lang, compressor in compressors:
            size = sum([len(compressor.compress(b)) for b in blocks])
            if least is None or size < least:
                best, least, runner_up = lang, size, least
            elif runner_up is None or size < runner_up:
                runner_up = size
        if least is None:
            return UNKNOWN, 0.0
        return best, 1.0 if runner_up is None else 1.0 - least / runner_up


def learn_languages(
    docs: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES, piece_chars: int = PIECE_CHARS, **settings
) -> LanguageModel:
    """Learn from text and non-null lang of the rows that aren't held out.

    Which texts give a piece, and which piece, depends on a hash of the text alone, so equal tables give equal
    models in any order. What reaches the driver is bounded by dictionary_bytes and the number of languages.
    """
    train = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    h, place = F.xxhash64("text"), F.xxhash64(F.lit("place"), F.col("text"))
    # Texts are drawn by their hash, copies together, so the rate is one of different texts. Copies are counted in tasks.
    texts = train.groupBy("lang", h.alias("h")).agg(F.count(F.lit(1)).alias("copies"))
    totals = texts.groupBy("lang").agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("texts")).collect()
    if not totals:
        return LanguageModel(**settings)
    counts = {r["lang"]: r["rows"] for r in totals}
    wanted = 2 * (dictionary_bytes // piece_chars + 1)
    rates = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], min(1.0, wanted / r["texts"]))])
    room = F.greatest(F.char_length("text") - piece_chars, F.lit(0)) + 1
    pieces = (
        train.filter(F.pmod(h, F.lit(1 << 40)) < rates[F.col("lang")] * float(1 << 40))
        .select("lang", h.alias("h"), F.lower(F.substring("text", F.pmod(place, room).cast("int") + 1, F.lit(piece_chars))).alias("piece"))
        .distinct()
        .collect()
    )
    dictionaries = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        content = b""
        for row in sorted((r for r in pieces if r["lang"] == lang), key=lambda r: (r["h"], r["piece"])):
            content += row["piece"].encode() + b"\n"
            if len(content) >= dictionary_bytes:
                break
        if len(content) >= 8:  # zstandard takes no shorter one
            dictionaries[lang] = content[:dictionary_bytes]
    return LanguageModel(dictionaries, **settings)


def identify(docs: DataFrame, model: LanguageModel, prefix: str = "") -> DataFrame:
    """Add lang_pred, score (the margin) and accepted to docs, which must have a column text.

    Null texts and texts without a letter are ``und`` with score 0 and not accepted. ``prefix`` goes before the
    three new names where docs has columns of these names.
    """
    new = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType())]
    schema = T.StructType(docs.schema.fields + [T.StructField(prefix + n, kind) for n, kind in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = rows.column("text").fill_null("")
                lettered = pc.match_substring_regex(texts, r"\p{L}")
                found = [
                    model.classify(t.encode(), compressors) if ok else (UNKNOWN, 0.0)
                    for t, ok in zip(pc.utf8_lower(texts).to_pylist(), lettered.to_pylist(), strict=True)
                ]
                added = [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([margin for _, margin in found], pa.float64()),
                    pa.array([lang != UNKNOWN and margin >= model.margin for lang, margin in found], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=schema.names)
            release_memory()

    return docs.mapInArrow(run, schema)


def accepted_documents(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents whose language is clear, all columns as they are."""
    return identify(docs, model, "_found_").filter("_found_accepted").select(*docs.columns)
