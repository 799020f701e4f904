"""Collocations: phrases of two or three words that occur more often than their parts would by chance.

Phrases are counted length by length, and only where both shorter phrases within them are frequent enough to matter
themselves: a phrase can't be more frequent than a part of it. A Bloom filter of bounded size tells which are; it lets
through all that are and some that aren't, so counts are whole. Each task counts the phrases of its texts in a HAT-trie: under a word's number stands a container, a hash table of the
words that follow, and a container that grows too large bursts into one container per second word. When the trie
holds too many phrases its largest subtrees are given out whole, as a run in the order of the phrases, and counting goes
on without them. Runs are merged per prefix partition: those of a first word meet in a fixed number of partitions, dealt by the
rest of the phrase, so that no word's phrases are one task's work.

Everything after the counts is over phrases that are frequent enough to matter, by joins and small aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.llm.common import slices
from martkit.llm.ngramlm import LogFrequencyFilter, build_filter, mixed
from martkit.llm.words import Words, split_words
from martkit.sources.layers import stored

SPACES, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
#: A word's number within a phrase takes so many bits; 0 stands for no word.
WORD_BITS = 21
REST = (1 << 2 * WORD_BITS) - 1
#: Phrases that a container may hold before it bursts, and a trie before its largest subtrees go.
BURST, HELD = 8192, 1_000_000
#: Blocks of 64 KB of a filter at most: 32 MB.
FILTER_BLOCKS = 512
#: Partitions that the phrases of one first word are dealt to, and in which each language's best are looked for first.
SPLITS = 16
LEAST, COVERED_PERCENT, TOP = 10, 50, 2000


class Container:
    """Counts of what follows a first word: a table by rest of the phrase or, burst, one table per second word."""

    __slots__ = ("table", "children", "size")

    def __init__(self) -> None:
        self.table: dict[int, int] = {}
        self.children: dict[int, dict[int, int]] | None = None
        self.size = 0

    def add(self, rests: list[int], counts: list[int], burst: int) -> None:
        if self.children is None:
            table = self.table
            for rest, n in zip(rests, counts, strict=True):
                table[rest] = table.get(rest, 0) + n
            self.size = len(table)
            if self.size > burst:
                self.children, self.table = {}, {}
                self.size = 0
                self.add(list(table), list(table.values()), burst)
            return
        children, mask = self.children, (1 << WORD_BITS) - 1
        for rest, n in zip(rests, counts, strict=True):
            child = children.setdefault(rest >> WORD_BITS, {})
            third, before = rest & mask, len(child)
            child[third] = child.get(third, 0) + n
            self.size += len(child) - before

    def items(self) -> tuple[list[int], list[int]]:
        if self.children is None:
            return list(self.table), list(self.table.values())
        rests = [second << WORD_BITS | third for second, child in self.children.items() for third in child]
        return rests, [n for child in self.children.values() for n in child.values()]


def phrase_hashes(lang: str, hashes: np.ndarray, length: int) -> np.ndarray:
    """A number for the phrase of so many words at every place, from the hashes of words."""
    key = np.full(max(0, len(hashes) - length + 1), xxhash.xxh64_intdigest(lang), np.uint64)
    for k in range(length):
        key = mixed(key + hashes[k : k + len(key)])
    return key


class HatTrie:
    """Counts of phrases of one length in one task, by language and first word."""

    def __init__(self, length: int, shorter: LogFrequencyFilter, burst: int = BURST, held: int = HELD):
        self.length, self.shorter, self.burst, self.held, self.size = length, shorter, burst, held, 0
        self.numbers: dict[str, int] = {}
        self.roots: dict[tuple[str, int], Container] = {}

    def _keys(self, lang: str, words: Words) -> np.ndarray:
        """The numbers of the words of every phrase, packed from the top, if both shorter phrases pass the filter."""
        numbers, k = self.numbers, self.length
        distinct = words.distinct.to_pylist()
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)[words.codes]
        passed = self.shorter.levels(phrase_hashes(lang, hashes, k - 1)) > 0
        places = np.flatnonzero(passed[:-1] & passed[1:] & (words.pieces[: 1 - k] == words.pieces[k - 1 :]))
        of = np.array([numbers.setdefault(w, len(numbers) + 1) for w in distinct], np.int64)
        key = np.zeros(len(places), np.int64)
        for i in range(k):
            key |= of[words.codes[places + i]] << (2 - i) * WORD_BITS
        return key

    def add(self, lang: str, texts: pa.Array) -> None:
        """Count the phrases of texts without nulls; a phrase lies within one piece."""
        words, roots = split_words(texts, SPACES, STOPS), self.roots
        if len(words.codes) < self.length:
            return
        found, counts = np.unique(self._keys(lang, words), return_counts=True)
        firsts = found >> 2 * WORD_BITS
        cuts = np.flatnonzero(np.diff(firsts, prepend=0))
        rests, counts = (found & REST).tolist(), counts.tolist()
        for start, end, first in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rests)], firsts[cuts].tolist(), strict=False):
            container = roots.get((lang, first))
            if container is None:
                container = roots[lang, first] = Container()
            before = container.size
            container.add(rests[start:end], counts[start:end], self.burst)
            self.size += container.size - before

    @property
    def full(self) -> bool:
        return self.size > self.held or len(self.numbers) > (1 << WORD_BITS) * 3 // 4

    def spill(self, all_of_it: bool = False) -> Iterator[pa.RecordBatch]:
        """Give out the largest subtrees until half of the room is free, or all, as runs in the order of their phrases."""
        fresh = all_of_it or len(self.numbers) > (1 << WORD_BITS) // 2  # numbers start again with an empty trie
        room = 0 if fresh else self.held // 2
        taken: dict[str, list[tuple[int, Container]]] = {}
        for lang, first in sorted(self.roots, key=lambda r: -self.roots[r].size):
            if self.size <= room:
                break
            container = self.roots.pop((lang, first))
            self.size -= container.size
            taken.setdefault(lang, []).append((first, container))
        words = pa.array(self.numbers, pa.string()) if self.numbers else pa.array([], pa.string())
        for lang, subtrees in taken.items():
            keys, counts = [], []
            for first, container in subtrees:
                rests, n = container.items()
                keys.append(np.array(rests, np.int64) | first << 2 * WORD_BITS)
                counts += n
            yield from _run(lang, np.concatenate(keys), np.array(counts, np.int64), words)
        if fresh:
            self.numbers = {}


def _run(lang: str, keys: np.ndarray, counts: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, n) in the order of their words' letters."""
    parts = [keys >> 2 * WORD_BITS, keys >> WORD_BITS & (1 << WORD_BITS) - 1, keys & (1 << WORD_BITS) - 1]
    used = np.unique(np.concatenate(parts))
    used = used[used > 0]
    names = words.take(pa.array(used - 1))
    rank = np.zeros(int(used[-1]) + 1, np.int64)
    order = pc.array_sort_indices(names).to_numpy()
    rank[used[order]] = np.arange(1, len(used) + 1)
    names = names.take(pa.array(order))
    packed = (rank[parts[0]] << WORD_BITS | rank[parts[1]]) << WORD_BITS | rank[parts[2]]
    order = np.argsort(packed)
    counts, parts = counts[order], [rank[p][order] for p in parts]
    for start in range(0, len(counts), 100_000):
        some = [p[start : start + 100_000] for p in parts]
        columns = [names.take(pa.array(np.where(p > 0, p - 1, 0), mask=p == 0)) for p in some]
        phrase = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
        n = pa.array(counts[start : start + 100_000])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), phrase, n], names=["lang", "phrase", "n"])


def _narrow(docs: DataFrame) -> DataFrame:
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(lang.alias("lang"), text.alias("text"))


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    for batch in batches:
        for rows in slices(batch, "text", 4_000_000):
            langs, texts = rows.column("lang"), rows.column("text")
            for lang in langs.unique().to_pylist():
                yield lang, texts.filter(pc.equal(langs, lang))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of single words; the empty phrase counts all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_lang(batches):
            words = split_words(texts, SPACES, STOPS)
            n = np.append(np.bincount(words.codes, minlength=len(words.distinct)), len(words.codes))
            phrases = pa.concat_arrays([words.distinct, pa.array([""])])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), phrases, pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

    counts = _narrow(docs).mapInArrow(run, "lang string, phrase string, n long")
    return counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _filter(frequent: DataFrame) -> LogFrequencyFilter:
    """A Bloom filter of the phrases of (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = []
            for lang, phrase in zip(rows.column("lang").to_pylist(), rows.column("phrase").to_pylist(), strict=True):
                words = phrase.split(" ")
                keys.append(phrase_hashes(lang, np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64), len(words))[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], names=["key"])

    keys = frequent.filter("phrase <> ''").select("lang", "phrase").mapInArrow(run, "key long")
    return build_filter(stored(keys.withColumn("n", F.lit(1)), "keys"), 1, FILTER_BLOCKS)


def phrase_counts(docs: DataFrame, length: int, shorter: LogFrequencyFilter, burst: int = BURST, held: int = HELD) -> DataFrame:
    """(lang, phrase, n): contiguous occurrences, overlaps included, of phrases of ``length`` words whose shorter ones pass."""
    shipped = docs.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(length, shipped.value, burst, held)
        for lang, texts in _by_lang(batches):
            trie.add(lang, texts)
            if trie.full:
                yield from trie.spill()
        yield from trie.spill(all_of_it=True)

    runs = _narrow(docs).mapInArrow(run, "lang string, phrase string, n long")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, rest = F.substring_index("phrase", " ", 1), F.pmod(F.xxhash64("phrase"), F.lit(SPLITS))
    prefix = (F.pmod(F.xxhash64("lang", first), F.lit(1 << 16)) * SPLITS + rest).cast("int")
    dealt = runs.withColumn("prefix", prefix).repartition(parts, "prefix")
    return dealt.groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n")).select("lang", "phrase", "n")


def frequent_phrases(docs: DataFrame, least: int, most_words: int = 3, burst: int = BURST, held: int = HELD) -> DataFrame:
    """(lang, phrase, n) of the phrases of up to most_words words that occur least times; the empty one has all words."""
    if not 1 <= most_words <= 3:
        raise ValueError("phrases have one to three words")
    found = [stored(word_counts(docs).filter((F.col("n") >= least) | (F.col("phrase") == "")), "phrases")]
    for length in range(2, most_words + 1):
        counts = phrase_counts(docs, length, _filter(found[-1]), burst, held)
        found.append(stored(counts.filter(F.col("n") >= least), "phrases"))
    return reduce(DataFrame.unionByName, found)


def _cut_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exactly: products have up to 38 digits."""
    whole = [F.col(c).cast("decimal(19,0)") for c in (a, left, right)]
    square = (whole[0] * whole[0]).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), (whole[1] * whole[2]).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame, least: int = LEAST, covered_percent: int = COVERED_PERCENT, top: int = TOP, most_words: int = 3,
    burst: int = BURST, held: int = HELD,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A candidate has two words or more and a >= least occurrences. It is cut where a a / (l r) is lowest, l and r being the
    counts of the parts, and is dropped if a longer candidate holds its words and has covered_percent of its occurrences.
    Null text counts as empty, null lang as ``und``. Ties go by occurrences, then by the letters of the phrase. Repeated
    rows count as often as they come; other columns don't matter; a table without words gives no row.
    """
    frequent = frequent_phrases(docs, least, most_words, burst, held)
    words, phrases = F.split("phrase", " "), frequent.filter("phrase <> ''")
    candidates = phrases.select("lang", "phrase", F.col("n").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    k = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "words", k).select(
        "lang", "phrase", "a", "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words"))).alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", _cut_score("a", "l", "r"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The phrases of two words or more inside longer candidates, with the most occurrences of one of these.
    length = F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("length")
    inside = candidates.filter(F.size("words") > 2).select("lang", "a", "words", length)
    place = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("place")
    inside = inside.select("lang", "a", "words", "length", place)
    inside = inside.select("lang", "a", F.concat_ws(" ", F.slice("words", F.col("place"), F.col("length"))).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = best.join(covered, ["lang", "phrase"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {int(covered_percent)} * a"))
    ranked = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPLITS))).orderBy(*order)
    ranked = ranked.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    totals = frequent.filter("phrase = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
