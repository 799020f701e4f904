"""Document fingerprints of closed syncmers. DataFrame operations only.

A text is a sequence of words. A k-mer is K words in a row, its inner substrings are S words in a row; it is
chosen when the smallest inner hash is its first or its last one. Whether a k-mer is chosen depends on its own
words alone, so an edit changes no anchor farther than K words away. The sequence is padded by K - 1 empty
words on both sides, so that a text of one word has anchors too.

A fingerprint is the ordered list of anchors, each with its place (index of the k-mer's first word). Two fingerprints
are matched by position: an anchor of one pairs with an equal one of the other, and pairs count only if they lie
as far apart as a neighbouring pair does. Likeness is the share of anchors in such pairs, of those of the fingerprint
with more, so the same passages in another order or scattered words count for little.

A null text counts as empty, an empty text has no anchors, and rows with null or repeated ids are rows like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.llm.common import whole_text

K = 8
S = 2
#: Rows of one group whose next documents are looked up together.
GROUP_ROWS = 2_000
COARSE = 256


def anchors(text: Column, k: int = K) -> Column:
    """Array of (hash, place) of a text's anchors, in order; the hash tells the anchor's words."""
    pad = F.array_repeat(F.lit(""), k - 1)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    padded = F.transform(
        F.array(words), lambda w: F.when(F.size(w) > 0, F.concat(pad, w, pad)).otherwise(F.array().cast("array<string>"))
    )
    # An array of one array binds what is used several times, so that it is computed once.
    inner = F.transform(padded, lambda p: F.transform(p, lambda w, i: F.xxhash64(w, F.get(p, i + 1))))
    found = F.transform(inner, lambda h: F.filter(F.transform(h, lambda x, i: _anchor(h, x, i, k)), lambda a: a.isNotNull()))
    return F.get(found, F.lit(0))


def _anchor(h: Column, x: Column, i: Column, k: int) -> Column:
    """The anchor that starts at word i, null if the k-mer there isn't chosen. h: hashes of all word pairs."""
    at = [x] + [F.get(h, i + j) for j in range(1, k - S + 1)]
    chosen = F.least(at[0], at[-1]) <= F.least(*at[1:-1])
    # Every second pair tells all words; k-mers that reach beyond the end are none.
    return F.when((i <= F.size(h) - k) & chosen, F.struct(F.xxhash64(*at[::S]).alias("hash"), i.alias("place")))


def fingerprint_text(found: Column) -> Column:
    """The anchors in order, each as eight hexadecimal digits of its hash, a colon and its place."""
    digits = lambda a: F.lower(F.lpad(F.hex(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.array_join(F.transform(found, lambda a: F.concat_ws(":", digits(a), a["place"])), " ")


def _once(value: Column, then) -> Column:
    """then(value), with value computed once: an array of one array binds it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _side(found: Column, side: int) -> Column:
    return F.transform(found, lambda a: F.struct(a["hash"].alias("hash"), a["place"].alias("place"), F.lit(side).alias("side")))


def _pairs(merged: Column, side: int) -> Column:
    """(place, other) of each anchor of one side that stands next to an equal one of the other side, in order of place.

    merged holds the anchors of both sides in order of hash, place and side, so equal anchors are neighbours: of two
    neighbours of the other side the following one is taken.
    """

    def pair(x: Column, i: Column) -> Column:
        def other(y: Column) -> Column:
            return F.when((y["hash"] == x["hash"]) & (y["side"] != side), y["place"])

        before = F.when(i > 0, other(F.get(merged, i - 1)))
        met = F.coalesce(other(F.get(merged, i + 1)), before)
        return F.when((x["side"] == side) & met.isNotNull(), F.struct(x["place"].alias("place"), met.alias("other")))

    return F.array_sort(F.filter(F.transform(merged, pair), lambda m: m.isNotNull()))


def _consistent(pairs: Column) -> Column:
    """The pairs whose distance between both places differs by less than K from that of the pair before or after."""

    def apart(m: Column, i: Column) -> Column:
        n = F.get(pairs, i)
        return F.abs((n["other"] - n["place"]) - (m["other"] - m["place"])) < K

    def stays(m: Column, i: Column) -> Column:
        before = F.when(i > 0, apart(m, i - 1))
        return F.coalesce(before, F.lit(False)) | F.coalesce(apart(m, i + 1), F.lit(False)) | (F.size(pairs) == 1)

    return F.filter(pairs, stays)


def _merged(a: Column, b: Column) -> Column:
    return F.array_sort(F.concat(_side(a, 0), _side(b, 1)))


def matched_places(a: Column, b: Column) -> Column:
    """Positional matching: (place in a, place in b) of the anchors of a that b has in a consistent place."""
    return _once(_merged(a, b), lambda merged: _once(_pairs(merged, 0), _consistent))


def likeness(a: Column, b: Column) -> Column:
    """Anchors matched by position, of those of the one with more; two empty fingerprints are alike.

    The smaller number counts, matched from a or from b, so likeness is symmetric, and 1 for equal fingerprints.
    """
    longer = F.greatest(F.size(a), F.size(b))

    def least(merged: Column) -> Column:
        sizes = [_once(_pairs(merged, side), lambda pairs: F.size(_consistent(pairs))) for side in (0, 1)]
        return F.least(*sizes)

    return F.when(longer == 0, F.lit(1.0)).otherwise(_once(_merged(a, b), least) / longer)


def _grouped(docs: DataFrame) -> DataFrame:
    """Add ``group``: ranges of descending doc_id of about GROUP_ROWS rows each, numbered in this order (null last).

    Quantiles of doc_id give at most COARSE ranges of about equal size, each cut evenly into as many groups as the
    row count needs. Ids may be any 64-bit numbers. What reaches the driver is the quantiles.
    """
    points = [i / COARSE for i in range(COARSE + 1)]
    row = docs.agg(F.percentile_approx("doc_id", points, F.lit(10_000)).alias("q"), F.count(F.lit(1)).alias("n")).first()
    bounds = sorted(set(row["q"] or [0]))
    finer = max(1, -(-row["n"] // (len(bounds) * GROUP_ROWS)))
    array = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    place = F.greatest(F.size(F.filter(array, lambda b: b <= F.col("doc_id"))), F.lit(1))
    # As doubles, for which no difference of ids is too large. They round, but never change the order.
    low = F.element_at(array, place).cast("double")
    high = F.coalesce(F.get(array, place).cast("double"), low)
    within = F.floor((F.col("doc_id").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * finer)
    number = (len(bounds) + 1 - place) * finer - F.least(F.greatest(within, F.lit(0)), F.lit(finer - 1))
    return docs.withColumn("group", F.coalesce(number, F.lit((len(bounds) + 1) * finer + 1)).cast("bigint"))


def with_next(docs: DataFrame, of: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, text, next_text: the text of the next row in descending doc_id, after the last one the first.

    With ``of``, also own and following: what it gives for both texts, computed once for each row. Null text counts as
    empty; rows with equal ids follow each other by their texts, null ids come last. Texts are shuffled into groups,
    ranges of them to a task, so tasks get about the same; between groups only their first texts are handed on.
    """
    rows = _grouped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")))
    rows = rows.repartitionByRange("group")
    first = W.partitionBy("group").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    last = W.partitionBy("group").orderBy(F.col("doc_id").asc_nulls_first(), F.desc("text"))
    led = {"next_text": F.lead("text").over(first)}
    inner = rows
    if of is not None:
        inner = rows.withColumn("own", of(F.col("text")))
        led["following"] = F.lead("own").over(first)
    inner = inner.withColumns(led).filter("next_text IS NOT NULL").drop("group")
    ends = {name: rows.withColumn("place", F.row_number().over(order)).filter("place = 1") for name, order in (("head", first), ("tail", last))}
    heads = ends["head"].select(F.col("group").alias("after"), F.col("text").alias("next_text"))
    # Group numbers alone are put in order: a row per group.
    numbers = rows.select("group").distinct()
    following = F.coalesce(F.lead("group").over(W.orderBy("group")), F.min("group").over(W.partitionBy(F.lit(0))))
    after = numbers.select("group", following.alias("after"))
    tails = ends["tail"].join(after, "group").join(heads, "after").select("doc_id", "text", "next_text")
    if of is not None:
        tails = tails.withColumns({"own": of(F.col("text")), "following": of(F.col("next_text"))})
    return inner.unionByName(tails)


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the text (rounded down, code points) replaced by as much of the start of another one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    An empty text has an empty fingerprint. With one row, the next document is the row itself.
    """
    return (
        with_next(docs, lambda text: anchors(text, k))
        .withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
        .select(
            "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            "own", anchors(F.col("edited"), k).alias("other"), "following",
        )
        .select(
            "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("own")).alias("fingerprint"),
            fingerprint_text(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )
