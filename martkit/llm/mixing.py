"""Mixing sources to target weights by weighted fair queueing. DataFrame operations only.

Documents stand in their source's queue in a shuffled order, twice one after the other, as no document is
taken more than twice. A document's virtual finish time is the number of source words up to its end, divided
by the source's target. All documents of all sources are range-sorted by finish time and the queue is cut
where the total budget is used up, so every source is served in proportion to its target.

Running sums never pass through one task: within a source they go by ranges of the shuffle key whose number
follows the source's row count, over all sources by the partitions of the range sort. Both levels add whole
words, so a rerun gives the same mix. Only numbers are shuffled, never texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.llm.common import WORD_PATTERN, whole_text
from martkit.sources.layers import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Rows of one source that one window group sums up.
RANGE_ROWS = 20_000


def shuffle_key(column: str = "doc_id") -> Column:
    return F.md5(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source, rank, weight, source_size, n_docs, target.

    ``sized`` has source and size. Sources rank by code point, null last; weights repeat along the ranks. The
    budget is ``share`` of all words. A target stops at ``most`` times its source's size and the excess goes
    to the others by weight until none is above. The table has a row per source, not per document.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    ranked = stored(ranked, "sources")
    # Sources by the fill at which they stop; the first one that the level of fill does not reach sets it.
    stop = F.col("source_size") * float(most) / F.col("weight")
    by_stop = W.orderBy("stop", "rank")
    before = F.coalesce(F.sum("source_size").over(by_stop.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * most
    total = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rest = F.sum("weight").over(by_stop.rowsBetween(0, W.unboundedFollowing))
    level = (
        ranked.withColumn("stop", stop)
        .select("stop", "rank", ((total * share - before) / rest).alias("level"))
        .filter("stop > level")
        .agg(F.min_by("level", F.struct("stop", "rank")))
        .first()[0]
    )
    cap = F.col("source_size") * float(most)
    return ranked.withColumn("target", cap if level is None else F.least(cap, F.col("weight") * F.lit(level)))


@dataclass(frozen=True)
class Cut:
    """Where the sorted queue ends: finish time and source rank of the last document, and its words taken."""

    finish: float
    rank: int
    words: int


def _in_queue(rows: DataFrame) -> DataFrame:
    """Add ``ends``, the words of the source up to and with each row in shuffled order."""
    digits = F.ceil(F.greatest(F.log2(F.col("n_docs") / RANGE_ROWS), F.lit(0.0)) / 4).cast("int")
    rows = rows.withColumn("range", F.substring(F.col("h"), F.lit(1), digits))
    sums = rows.groupBy("rank", "range").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("rank").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("rank", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    within = W.partitionBy("rank", "range").orderBy("h", "doc_id", "size", "text_hash")
    running = F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0))
    return rows.join(starts, ["rank", "range"]).withColumn("ends", F.col("start") + running).drop("range", "start")


def _cut(queue: DataFrame, budget: int, partitions: int) -> Cut | None:
    """Range-sort all turns by finish time and find the one that uses up the budget (None: all fit)."""
    turns = (
        queue.filter("size > 0")
        .select("rank", "size", F.explode(F.array(*[F.col(f"finish{k}") for k in range(1, MOST + 1)])).alias("finish"))
        .repartitionByRange(partitions, "finish", "rank")
    )
    turns = stored(turns.withColumn("part", F.spark_partition_id()), "turns")
    order = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = turns.groupBy("part").agg(F.sum("size").alias("words"))  # a row per partition
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(order), F.lit(0)))
    last = starts.filter((F.col("start") < budget) & (F.col("start") + F.col("words") >= budget)).first()
    if last is None:
        return None
    running = F.sum("size").over(W.orderBy("finish", "rank").rowsBetween(W.unboundedPreceding, 0))
    ends = turns.filter(F.col("part") == last["part"]).withColumn("ends", running + last["start"])
    row = ends.filter(F.col("ends") >= budget).orderBy("ends").first()
    return Cut(row["finish"], row["rank"], budget - (row["ends"] - row["size"]))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per row of docs: doc_id, source, text_hash, size, source_size, target, taken, turns.

    ``size`` counts the words of the whole text (null: 0), ``taken`` the words the mix takes of them, repeats
    counted; only the document at the cut can be taken in part. ``turns`` counts how often the document is
    in the mix, in whole or in part. Empty tables give no rows; sources without words take nothing.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            "doc_id", "source", F.xxhash64("text").alias("text_hash"), shuffle_key().alias("h"),
            F.regexp_count(whole_text(), F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
        ),
        "sized",
    )
    targets = stored(source_targets(sized, weights, share), "targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    known = targets.withColumnRenamed("source", "_source")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
    queue = _in_queue(rows)
    for k in range(MOST):
        words = F.col("source_size") * k + F.col("ends")
        queue = queue.withColumn(f"finish{k + 1}", F.when(F.col("target") > 0, words / F.col("target")))
    queue = stored(queue, "queue")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = _cut(queue, int(total * share), partitions) if total else None
    parts = []
    for k in range(1, MOST + 1):
        finish = F.col(f"finish{k}")
        if cut is None:
            words = F.when(finish.isNotNull(), F.col("size"))
        else:
            at = (finish == cut.finish) & (F.col("rank") == cut.rank)
            before = (finish < cut.finish) | ((finish == cut.finish) & (F.col("rank") < cut.rank))
            words = F.when(at & (F.col("size") > 0), F.least(F.lit(cut.words), F.col("size"))).when(before, F.col("size"))
        parts.append(F.coalesce(words, F.lit(0)).cast("bigint"))
    taken = sum(parts[1:], parts[0])
    turns = sum([(p > 0).cast("int") for p in parts[1:]], (parts[0] > 0).cast("int"))
    return queue.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", taken.alias("taken"), turns.alias("turns")
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """The documents of the mix, all columns, each as often as its turns (the last one whole)."""
    keys = {"__key_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))}
    keys["__key_source"] = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    turns = mix(docs, weights, share).filter("turns > 0").withColumns(keys)
    turns = turns.groupBy("__key_id", "__key_source", F.col("text_hash").alias("__key_hash")).agg(F.sum("turns").alias("__turns"))
    on = [*keys, "__key_hash"]
    keyed = docs.withColumns({**keys, "__key_hash": F.xxhash64("text")})
    joined = keyed.join(turns, on).dropDuplicates(on)
    times = F.explode(F.array_repeat(F.lit(0), F.col("__turns").cast("int")))
    return joined.withColumn("__turn", times).select(*docs.columns)
