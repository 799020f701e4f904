"""Exact duplicates by naming fixed-size blocks with integers, then pairs of names, up to one name per text.

DataFrame operations only. Every distinct block of the normalised texts gets an integer: blocks are made
distinct, sorted, and numbered. Then adjacent names are paired, distinct pairs are numbered in the same way,
and so on until each text has one name. Texts with as many blocks have the same tree of pairs, so two texts
are equal exactly when their block counts and their last names are equal: no hash decides.

Looking up a block's name by its whole content would shuffle the corpus a second time. Each lookup goes by
a pair of 64-bit hashes instead, and the names table shows beforehand whether that pair tells all distinct
blocks apart; should two blocks ever share it, the naming is repeated with other seeds.

The corpus is shuffled once, combined per task (a block that a third of all texts hold arrives once per
task); all later tables hold numbers only and are written to the shared folder, so names stay the same
whatever is computed again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import WHITESPACE, whole_text
from martkit.sources.layers import stored

BLOCK_BYTES = 4096
ADDRESS = ("h1", "h2")


def normalised(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, WHITESPACE, "")


def _addresses(block: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(seed), block), F.xxhash64(block, F.lit(seed + 1))


def _block(content: Column, i: Column, size: int) -> Column:
    return F.substring(content, i * size + 1, F.lit(size))


def _numbered(distinct: DataFrame, by: list[str], keep: list[Column | str], name: str) -> DataFrame:
    """Sort distinct rows and number them; the numbers are written down once."""
    named = distinct.sortWithinPartitions(*by).select(*keep, F.monotonically_increasing_id().alias("name"))
    return stored(named, name)


def content_names(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    addresses: Callable[[Column, int], tuple[Column, Column]] = _addresses,
) -> DataFrame:
    """One row per row of docs: row_id, doc_id, n_chars, text_sha256, n_blocks, name.

    Equal normalised texts, and only they, have equal (n_blocks, name). Null text counts as empty; the empty
    text is one empty block. Rows may repeat and doc_id may be null: row_id tells rows apart.
    """
    text = whole_text()
    base = docs.select("doc_id", F.char_length(text).alias("n_chars"), normalised(text).alias("norm")).select(
        "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), F.col("norm").cast("binary").alias("norm")
    )
    size = F.octet_length("norm")
    places = F.sequence(F.lit(0), F.greatest(F.ceil(size / block_bytes).cast("int"), F.lit(1)) - 1)
    seed = 1
    while True:
        blocks = base.select(F.explode(F.transform(places, lambda i: _block(F.col("norm"), i, block_bytes))).alias("block"))
        h1, h2 = addresses(F.col("block"), seed)
        names = _numbered(blocks.distinct(), ["block"], [h1.alias("h1"), h2.alias("h2")], "block-names")
        if names.groupBy(*ADDRESS).count().filter("count > 1").isEmpty():
            break
        seed += 2

    def address(i: Column) -> Column:
        a, b = addresses(_block(F.col("norm"), i, block_bytes), seed)
        return F.struct(a.alias("h1"), b.alias("h2"))

    rows = stored(
        base.select(
            F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_chars", "text_sha256",
            F.transform(places, address).alias("blocks"),
        ).withColumn("n_blocks", F.size("blocks")),
        "rows",
    )
    current = (
        rows.select("row_id", "n_blocks", F.posexplode("blocks").alias("pos", "at"))
        .select("row_id", "n_blocks", "pos", F.col("at.h1").alias("h1"), F.col("at.h2").alias("h2"))
        .join(names, list(ADDRESS))
        .select("row_id", F.col("n_blocks").alias("left"), "pos", "name")
    )
    current = stored(current, "names-0")
    longest = current.agg(F.max("left")).first()[0] or 1
    done = current.filter("left = 1").select("row_id", "name")
    level = 0
    while longest > 1:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = (
            current.filter("left > 1")
            .groupBy("row_id", "left", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"], "pair-names")
        halved = F.ceil(F.col("left") / 2).cast("int").alias("left")
        current = stored(pairs.join(names, ["a", "b"]).select("row_id", halved, "pos", "name"), f"names-{level}")
        done = done.unionByName(current.filter("left = 1").select("row_id", "name"))
        longest = (longest + 1) // 2
    return rows.drop("blocks").join(done, "row_id")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_chars, row_id.

    Of equal texts the row with the most code points in its original text stays, then the smallest doc_id
    (null last), then one of the repeated rows.
    """
    named = stored(content_names(docs, block_bytes), "named")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row_id"))
    groups = named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
        "n_chars",
        "row_id",
    )


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that stay, all columns; of rows that agree in id and text one stays."""
    text = whole_text()
    kept = exact_groups(docs, block_bytes).filter("kept")
    keys = ["__key_id", "__key_sha", "__key_chars"]
    kept = kept.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key_id"),
        F.col("text_sha256").alias("__key_sha"), F.col("n_chars").alias("__key_chars"),
    )
    keyed = docs.select(
        "*",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key_id"),
        F.sha2(normalised(text), 256).alias("__key_sha"),
        F.char_length(text).alias("__key_chars"),
    )
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)
