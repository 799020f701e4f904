"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count enters the filter as its level, the number of doublings above a floor: the n-gram is stored once for every level
from 1 up to its own. A reader asks for level 1, 2, ... until one is missing, and the last one found gives the count back
within a factor of two. Counts are read too high with a small chance and never too low, so that a shorter n-gram that
is missing settles the longer ones around it.

The floor is a fixed share of the training tokens. Counts of one order add up to the number of tokens at most and a level
takes at least one floor's worth of them, so the filter of one order holds at most 1 / FLOOR_SHARE entries whatever the
corpus, and every worker gets a copy: 42 MB for each of both orders at the most. N-grams below the floor keep their exact
counts in buckets of keys, dealt over the tasks; a text asks the buckets for what the filters lack. Words outside the
vocabulary take part by their hashes. Orders are counted one after the other; an n-gram is counted where the shorter ones
in it may have LEAST_COUNT occurrences.

A token's probability is a mean of what its count, its bigram's and its trigram's say, with weights that are found by
leaving one occurrence out: every training token votes for the order that would have told it best without it. Contexts
that were not seen have no say. The counts of tokens themselves are exact: those of the most frequent ones are sent along,
all others meet theirs in a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import frequent_floor, release_memory, slices
from martkit.llm.words import split_words
from martkit.sources.layers import stored

SPACES = b" \t\n\x0b\x0c\r"
#: Counts that are sent to every task, the highest ones.
VOCABULARY = 1 << 18
#: The filters have n-grams whose count is at least this share of the training tokens; other counts from LEAST_COUNT on are
#: looked up in the buckets that hold them.
FLOOR_SHARE = 2.0**-25
LEAST_COUNT = 2
#: A stored level takes so many bits, found by so many probes: one in a hundred absent ones seems present.
ENTRY_BITS, PROBES = 10, 5
BLOCK_BYTES = 1 << 16
#: Text that is worked on at a time; NumPy and Arrow hold some thirty times as much for a moment.
SLICE_BYTES = 2_000_000
#: Keys that a task holds before it counts them, and tokens to a partition of the counts.
HELD_KEYS = 1_000_000
PART_TOKENS = 4_000_000
ID_BITS = 20
#: Blocks at most for the filter that tells which n-grams below the floor are worth asking for; full, it lets more through.
MORE_BLOCKS = 320
#: Kinds of counts: words outside the vocabulary; n-grams of vocabulary words alone, and those with another word.
WORDS, PAIRS, OTHER_PAIRS, TRIPLES, OTHER_TRIPLES = range(1, 6)
KINDS = 6
CODES = ("one", "two", "three")
#: Which of the codes a kind answers.
ORDER = {WORDS: 0, PAIRS: 1, OTHER_PAIRS: 1, TRIPLES: 2, OTHER_TRIPLES: 2}
#: Stands where a level would, for an n-gram whose count is asked for.
ASKED_FOR = 255
END = ""  # stands for the end token in tables of words


def held_out(column: str = "doc_id") -> Column:
    """True for texts that are not learned from: crc32 of the id as text, modulo 10, is 0 (null id: learned from)."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 10 == 0, F.lit(False))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64-bit numbers (the finaliser of SplitMix64), so keys stay exact."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmixed(x: np.ndarray) -> np.ndarray:
    """What ``mixed`` was given."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return (x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))).astype(np.int64)


# --- the filter -------------------------------------------------------------------------------------


def _bit(hashed: np.ndarray, probe: int) -> np.ndarray:
    """The place within its block that a probe of a hashed key reads."""
    step = (hashed >> np.uint64(32)) | np.uint64(1)
    return (hashed + np.uint64(probe) * step) & np.uint64(8 * BLOCK_BYTES - 1)


def _hashed(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))


class LogFrequencyFilter(NamedTuple):
    """The bits of all blocks. A key's block is set by its upper bits."""

    bits: np.ndarray
    floor: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key, 0 for those that are not stored."""
        out = np.zeros(len(keys), np.int64)
        if not len(self.bits):
            return out
        at = np.arange(len(keys))
        base = (keys >> np.uint64(40)) % np.uint64(len(self.bits) // BLOCK_BYTES) * np.uint64(BLOCK_BYTES)
        level = 0
        while len(at):
            level += 1
            hashed = _hashed(keys[at], level)
            for i in range(PROBES):
                place = _bit(hashed, i)
                hit = (self.bits[base[at] + (place >> np.uint64(3))] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                at, hashed = at[hit], hashed[hit]
            out[at] = level
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count that a level stands for: the middle of its doubling in logarithms, 0 if absent."""
        level = self.levels(keys)
        return np.where(level > 0, self.floor * 2.0 ** (level - 0.5), 0.0)


def build_filter(counts: DataFrame, floor: int, most_blocks: int | None = None) -> LogFrequencyFilter:
    """The filter of (key, n), n at least floor. Tasks set the bits of their blocks; the driver puts blocks together.

    Entries that would fill more than ``most_blocks`` share these: none is lost, but more absent ones seem present.
    """
    spark = counts.sparkSession
    leveled = counts.select("key", (F.length(F.bin(F.call_function("div", "n", F.lit(floor))))).alias("level"))
    entries = leveled.agg(F.sum("level")).first()[0] or 0
    blocks = -(-entries * ENTRY_BITS // (8 * BLOCK_BYTES))
    blocks = min(blocks, most_blocks or blocks)
    if not blocks:
        return LogFrequencyFilter(np.empty(0, np.uint8), floor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for rows in batches:
            block, keys, level = (rows.column(c).to_numpy() for c in ("block", "key", "level"))
            keys = keys.view(np.uint64)
            order = np.argsort(block, kind="stable")
            block, keys, level = block[order], keys[order], level[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)], strict=True):
                bitmap = made.setdefault(int(block[start]), np.zeros(8 * BLOCK_BYTES, bool))
                for k in range(1, int(level[start:end].max()) + 1):
                    hashed = _hashed(keys[start:end][level[start:end] >= k], k)
                    for i in range(PROBES):
                        bitmap[_bit(hashed, i)] = True
        for number, bitmap in made.items():
            packed = np.packbits(bitmap, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed], pa.binary())], names=["block", "bits"])

    block = (F.shiftrightunsigned("key", 40) % blocks).alias("block")
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks)
    dealt = leveled.select(block, "key", "level").repartition(parts, "block")
    bits = np.zeros(blocks * BLOCK_BYTES, np.uint8)
    for row in dealt.mapInArrow(run, "block long, bits binary").toLocalIterator():
        bits[row["block"] * BLOCK_BYTES : (row["block"] + 1) * BLOCK_BYTES] = np.frombuffer(row["bits"], np.uint8)
    return LogFrequencyFilter(bits, floor)


# --- counting ---------------------------------------------------------------------------------------


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "text", SLICE_BYTES)
        release_memory()


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens; the end token, one for every row, is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _spread(batches):
            words = split_words(rows.column("text").fill_null(""), SPACES)
            found = pa.concat_arrays([words.distinct, pa.array([END])])
            n = np.append(np.bincount(words.codes, minlength=len(words.distinct)), len(rows))
            yield pa.RecordBatch.from_arrays([found, pa.array(n, pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The words of highest count, the end token among them: word i has number i + 1; 0 stands for every other one."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts = pa.array(words, pa.string()), np.concatenate([[0], counts])
        self.end = words.index(END) + 1 if END in words else 0

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, "pa.Array", np.ndarray]:
        """Numbers of all tokens and the number of tokens of each text, ends included; the distinct words and the code of
        each token in them (-1 for ends)."""
        words = split_words(texts, SPACES)
        found = pc.fill_null(pc.index_in(words.distinct, self.words), -1).to_numpy() + 1
        sizes = np.bincount(words.texts, minlength=len(texts)) + 1
        ids, codes = np.full(sizes.sum(), self.end, np.int64), np.full(sizes.sum(), -1, np.int64)
        places = np.arange(len(words.codes)) + words.texts
        ids[places], codes[places] = found[words.codes] if len(found) else 0, words.codes
        return ids, sizes, words.distinct, codes


def contexts(end: int, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each one (the end token at a text's start) and the one before that (0 at the start)."""
    before = np.concatenate([[end], ids[:-1]])
    earlier = np.concatenate([[0], before[:-1]])
    earlier[np.cumsum(sizes) - sizes] = 0
    return before, earlier


def bigram_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mixed(before << ID_BITS | ids)


def trigram_keys(earlier: np.ndarray, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mixed((earlier << ID_BITS | before) << ID_BITS | ids)


class Ngrams(NamedTuple):
    """Keys of the n-grams that end in each token. Those of vocabulary words alone are one-to-one, others are hashes."""

    pair: np.ndarray
    triple: np.ndarray
    other_pair: np.ndarray  # whether one of its words is outside the vocabulary
    other_triple: np.ndarray
    first: np.ndarray  # whether the token is the first of its text: no trigram ends there


class Slice(NamedTuple):
    """Tokens of some texts: the number of the first row, the documents (an Arrow stream), their sizes in tokens and whether
    they are learned from, the vocabulary number of each token, the hashes of those that have none."""

    number: int
    docs: bytes
    sizes: np.ndarray
    learned: np.ndarray
    ids: np.ndarray
    names: np.ndarray

    def ngrams(self, end_number: int) -> Ngrams:
        """By the vocabulary's number of the end token."""
        before, earlier = contexts(end_number, self.ids, self.sizes)
        first = np.zeros(len(self.ids), bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        pair, triple = bigram_keys(before, self.ids), trigram_keys(earlier, before, self.ids)
        other = self.ids == 0
        other_pair = other | (before == 0)
        other_triple = (other_pair | (earlier == 0)) & ~first
        if len(self.names):
            word = mixed(self.ids)
            word[other] = self.names
            end = word[-1:]  # every text has one
            last = np.concatenate([end, word[:-1]])
            one_more = np.concatenate([end, last[:-1]])
            pair[other_pair] = mixed(mixed(last[other_pair]) + word[other_pair])
            triple[other_triple] = mixed(mixed(mixed(one_more[other_triple]) + last[other_triple]) + word[other_triple])
        return Ngrams(pair, triple, other_pair, other_triple, first)

    def asked(self, found: Ngrams, levels: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, keys, places) of all counts to ask for: those of words without a number, and of n-grams marked in levels."""
        other = self.ids == 0
        if other.any():
            yield WORDS, self.names, np.flatnonzero(other)
        two, three = levels == ASKED_FOR
        for kind, keys, which in (
            (PAIRS, found.pair, two & ~found.other_pair), (OTHER_PAIRS, found.pair, two & found.other_pair),
            (TRIPLES, found.triple, three & ~found.other_triple), (OTHER_TRIPLES, found.triple, three & found.other_triple),
        ):
            places = np.flatnonzero(which)
            if len(places):
                yield kind, keys[places], places


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: all lowest bytes, then all second ones, and so on."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _unpacked(data: pa.Buffer, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def _docs(data: pa.Buffer) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def tokenized(docs: DataFrame, learned: Column, shipped) -> DataFrame:
    """(slice, docs, ids, names): the texts as vocabulary numbers, so that they are cut into words once for all counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _spread(batches):
            ids, sizes, distinct, codes = shipped.value.tokens(rows.column("text").fill_null(""))
            other = ids == 0
            # Other words: distinct ones of each text with their numbers.
            text = np.repeat(np.arange(len(sizes)), sizes)
            words, times = np.unique((text << 32 | codes)[other & (codes >= 0)], return_counts=True)
            bounds = pa.array(np.searchsorted(words >> 32, np.arange(len(sizes) + 1)), pa.int32())
            found, places = np.unique(codes[other], return_inverse=True)
            hashes = [xxhash.xxh64_intdigest(distinct[c].as_py() if c >= 0 else END) for c in found.tolist()]
            arrays = [
                rows.column("row"), rows.column("doc_id"), rows.column("learned"), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(bounds, distinct.take(pa.array(words & 0xFFFFFFFF))),
                pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64())),
            ]
            batch = pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "learned", "size", "word", "times"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            blobs = sink.getvalue().to_pybytes(), _packed(ids.astype(np.int32)), np.array(hashes, np.uint64)[places].tobytes()
            number = pa.array([rows.column("row")[0].as_py()], pa.int64())
            yield pa.RecordBatch.from_arrays([number, *(pa.array([b], pa.binary()) for b in blobs)], names=["slice", "docs", "ids", "names"])

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("bigint").alias("doc_id"), "text", learned.alias("learned")
    )
    return stored(numbered.mapInArrow(run, "slice long, docs binary, ids binary, names binary"), "tokenized")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for rows in batches:
        for i in range(len(rows)):
            number, docs, ids, names = (rows.column(c)[i] for c in ("slice", "docs", "ids", "names"))
            of = _docs(docs.as_buffer())
            sizes, learned = of.column("size").to_numpy(), of.column("learned").to_numpy(zero_copy_only=False)
            numbers = _unpacked(ids.as_buffer(), sizes.sum(), np.int32).astype(np.int64)
            yield Slice(number.as_py(), docs.as_py(), sizes, learned, numbers, np.frombuffer(names.as_buffer(), np.uint64))
        release_memory()


class NgramModel(NamedTuple):
    """What is learned: exact counts of all tokens, the two filters, and the counts of n-grams below their floor."""

    token_counts: DataFrame
    hot_floor: int
    train_tokens: int
    distinct: int
    vocabulary: Vocabulary
    bigrams: LogFrequencyFilter
    trigrams: LogFrequencyFilter
    #: Filters of one level of the n-grams below the floor: what isn't in them isn't asked for.
    more_bigrams: LogFrequencyFilter
    more_trigrams: LogFrequencyFilter
    #: Exact counts by bucket, see _counted; None if the filters and the vocabulary hold everything.
    rest: DataFrame | None
    shards: int
    weights: tuple[float, float, float]

    @property
    def base(self) -> float:
        """What base counts are divided by."""
        return self.train_tokens + 0.1 * (self.distinct + 1)


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value for each run of values that starts at a cut."""
    values = np.ascontiguousarray(values)
    ends = (np.append(cuts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _ranges(kind: int, shards: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, order, cuts): keys in this order are cut into ranges; the bucket of each range that has any, and its start."""
    shard = (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.uint16 if shards < 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    shard = shard[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    return kind * shards + shard[cuts], order, cuts


def _dealt(kind: int, shards: int, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(bucket, keys, values), a row for each range that has any keys."""
    bucket, order, cuts = _ranges(kind, shards, keys)
    return bucket, _blobs(keys[order], cuts), _blobs(values[order], cuts)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    keys, n = np.concatenate([k for k, _ in held]), np.concatenate([v for _, v in held])
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(n[order], starts)


def _counted(texts: DataFrame, shipped, gates, total: int, shards: int) -> DataFrame:
    """(bucket, keys, n): counts of LEAST_COUNT and more in the tokenized texts learned from, each bucket's keys in order.

    Without gates: bigrams, and all counts of words outside the vocabulary. With the filters of bigrams: the trigrams whose
    bigrams may be among them. Keys travel as one binary value per task and bucket, not as a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held = shipped.value, {}

        def counted() -> Iterator[pa.RecordBatch]:
            for kind, keys in held.items():
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _dealt(kind, shards, found, n.astype(np.uint32))], names=["bucket", "keys", "n"])
            held.clear()

        def hold(kind: int, keys: np.ndarray) -> None:
            if len(keys):
                held.setdefault(kind, []).append(keys)

        for rows in _read(batches):
            found = rows.ngrams(vocabulary.end)
            mine = np.repeat(rows.learned, rows.sizes)
            if gates is None:
                hold(WORDS, rows.names[mine[rows.ids == 0]])
                hold(PAIRS, found.pair[mine & ~found.other_pair])
                hold(OTHER_PAIRS, found.pair[mine & found.other_pair])
            else:
                pair = gates.value[0].levels(found.pair) > 0
                pair[~pair] = gates.value[1].levels(found.pair[~pair]) > 0
                whole = pair & np.concatenate([[False], pair[:-1]]) & ~found.first & mine
                hold(TRIPLES, found.triple[whole & ~found.other_triple])
                hold(OTHER_TRIPLES, found.triple[whole & found.other_triple])
            if sum(len(k) for keys in held.values() for k in keys) > HELD_KEYS:
                yield from counted()
        yield from counted()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh = {}, {}
        for rows in batches:
            for bucket, keys, n in zip(rows.column("bucket").to_pylist(), rows.column("keys"), rows.column("n"), strict=True):
                more = np.frombuffer(keys.as_buffer(), np.uint64).copy(), np.frombuffer(n.as_buffer(), np.uint32).astype(np.int64)
                held.setdefault(bucket, []).append(more)
                fresh[bucket] = fresh.get(bucket, 0) + len(more[0])
                if fresh[bucket] > HELD_KEYS:
                    held[bucket], fresh[bucket] = [_merged(held[bucket])], 0
        for bucket in sorted(held):
            keys, n = _merged(held.pop(bucket))
            often = n >= (1 if bucket // shards == WORDS else LEAST_COUNT)
            out = [pa.array([bucket], pa.int64()), *(pa.array([x[often].tobytes()], pa.binary()) for x in (keys, n))]
            yield pa.RecordBatch.from_arrays(out, names=["bucket", "keys", "n"])

    schema = "bucket long, keys binary, n binary"
    parts = _parts(texts, total)
    return stored(texts.mapInArrow(run, schema).repartition(parts, "bucket").mapInArrow(add, schema), "ngrams", keep_shuffles=False)


def _parts(docs: DataFrame, total: int) -> int:
    """Partitions that hold a bounded number of tokens each."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART_TOKENS + 1)


def _rows(counted: DataFrame, shards: int, kinds: tuple[int, ...], least: int, below: int | None = None) -> DataFrame:
    """(key, n) of the counts of some kinds from least on, and below another number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for keys, n in zip(rows.column("keys"), rows.column("n"), strict=True):
                keys, n = np.frombuffer(keys.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int64)
                some = (n >= least) & (n < (below or 1 << 62))
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(n[some])], names=["key", "n"])

    kind = F.call_function("div", "bucket", F.lit(shards))
    return counted.filter(kind.isin(*kinds)).mapInArrow(run, "key long, n long")


def _votes(counts: DataFrame, shipped, bigrams, total: int, floor: int) -> np.ndarray:
    """How many training tokens vote for each order, by (key, n) of the stored n-grams of one order.

    With bigrams None the rows are bigrams, else trigrams, whose votes are taken from the order that had them. Tokens in no
    row vote for their own count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value.counts
        for rows in batches:
            keys, n = unmixed(rows.column("key").to_numpy().view(np.uint64)), rows.column("n").to_numpy()
            mask = (1 << ID_BITS) - 1
            earlier, before, ids = keys >> 2 * ID_BITS, keys >> ID_BITS & mask, keys & mask

            def without(count: np.ndarray, of: np.ndarray) -> np.ndarray:
                return np.where(count - 1 >= floor, (count - 1) / np.maximum(of - 1, 1), 0.0)

            one = (known[ids] - 1) / max(total - 1, 1)
            pairs = n if bigrams is None else np.minimum(bigrams.value.counts(bigram_keys(before, ids)), known[ids])
            two = without(pairs, known[before])
            votes = np.zeros(3)
            if bigrams is None:
                votes[1] = n[two > one].sum()
            else:
                three = without(n, np.maximum(bigrams.value.counts(bigram_keys(earlier, before)), n))
                best = three > np.maximum(one, two)
                votes[2] = n[best].sum()
                votes[1] = -n[best & (two > one)].sum()
            votes[0] = -votes[1] - votes[2]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in votes], names=["one", "two", "three"])

    found = counts.mapInArrow(run, "one double, two double, three double").agg(F.sum("one"), F.sum("two"), F.sum("three")).first()
    return np.array([v or 0.0 for v in found])


def _learned(docs: DataFrame, learned: Column, vocabulary: int, floor_share: float) -> tuple[NgramModel, DataFrame]:
    """The model, as yet without the votes of n-grams that aren't in the filters, and the tokenized texts of all rows."""
    counts = stored(token_counts(docs.filter(learned)), "tokens", keep_shuffles=False)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hot_floor = frequent_floor(counts, "n", vocabulary)
    hot = counts.filter((F.col("n") >= hot_floor) | (F.col("word") == END)).orderBy(F.desc("n"), "word").toPandas()
    known = Vocabulary(hot["word"].tolist(), hot["n"].to_numpy(np.int64))
    floor = max(LEAST_COUNT, math.ceil(total * floor_share))
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast(known)
    shards = 2 * _parts(docs, total)
    texts = tokenized(docs, learned, shipped)

    def filters(counted: DataFrame, *kinds: int) -> tuple[LogFrequencyFilter, LogFrequencyFilter]:
        none = LogFrequencyFilter(np.empty(0, np.uint8), 1)
        more = _rows(counted, shards, kinds, LEAST_COUNT, floor).withColumn("n", F.lit(1))
        return build_filter(_rows(counted, shards, kinds, floor), floor), build_filter(more, 1, MORE_BLOCKS) if floor > LEAST_COUNT else none

    pairs = _counted(texts, shipped, None, total, shards)
    of_two = filters(pairs, PAIRS, OTHER_PAIRS)
    triples = _counted(texts, shipped, context.broadcast(of_two), total, shards)
    of_three = filters(triples, TRIPLES, OTHER_TRIPLES)
    sent = context.broadcast(of_two[0])
    votes = np.array([float(total), 0.0, 0.0])
    votes += _votes(_rows(pairs, shards, (PAIRS,), floor), shipped, None, total, floor)
    votes += _votes(_rows(triples, shards, (TRIPLES,), floor), shipped, sent, total, floor)
    rest = pairs.unionByName(triples) if floor > LEAST_COUNT or len(hot) < distinct else None
    model = NgramModel(
        counts, hot_floor, total, distinct, known, of_two[0], of_three[0], of_two[1], of_three[1], rest, shards, tuple(votes.tolist())
    )
    return model, texts


def _weighed(model: NgramModel, found: DataFrame) -> NgramModel:
    """The model with the votes of all n-grams made weights; found has the counts of the texts learned from."""
    votes = np.array(model.weights)
    if model.rest is not None:
        votes += _other_votes(found, model)
    return model._replace(weights=tuple((np.maximum(votes, 1.0) / np.maximum(votes, 1.0).sum()).tolist()))


def learn_ngrams(docs: DataFrame, vocabulary: int = VOCABULARY, floor_share: float = FLOOR_SHARE) -> NgramModel:
    """Learn from the text of every row of docs; null counts as empty. A table without rows gives an empty model."""
    model, texts = _learned(docs, F.lit(True), vocabulary, floor_share)
    return _weighed(model, None if model.rest is None else look_up(texts, model))


def learn_and_score(docs: DataFrame, learned: Column, vocabulary: int = VOCABULARY, floor_share: float = FLOOR_SHARE) -> DataFrame:
    """``score_texts`` of all rows by what the rows marked as learned give (never null); texts are cut and counts looked up
    once for both."""
    model, texts = _learned(docs, learned, vocabulary, floor_share)
    found = look_up(texts, model)
    return _scored(found, _weighed(model, found))


# --- looking up -------------------------------------------------------------------------------------


ASKED = "bucket long, slice long, kind int, keys binary, vals binary, docs binary, names binary"


def look_up(texts: DataFrame, model: NgramModel) -> DataFrame:
    """Tokenized texts with what is known of the n-grams that end in each token, see ``_known``: the levels that the filters
    have, and the exact counts of other ones.

    The filters answer first. What they lack is asked for: keys go to the tasks that hold the counts of their buckets, counts
    go back to their slices, in the order of the keys. Places in the texts don't travel: a slice's keys and their order follow
    from its numbers, and are worked out again when the counts come back.
    """
    sent = model._replace(token_counts=None, rest=None)
    shipped, shards, asks = texts.sparkSession.sparkContext.broadcast(sent), model.shards, model.rest is not None
    end_number = model.vocabulary.end

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value

        def levels_of(keys: np.ndarray, which: np.ndarray, stored: LogFrequencyFilter, more: LogFrequencyFilter) -> np.ndarray:
            """The levels of some keys, or the mark of those that may have a count below the floor."""
            levels = np.zeros(len(keys), np.uint8)
            levels[which] = stored.levels(keys[which])
            absent = np.flatnonzero(which & (levels == 0))
            levels[absent[more.levels(keys[absent]) > 0]] = ASKED_FOR
            return levels

        for rows in _read(batches):
            found = rows.ngrams(end_number)
            two = levels_of(found.pair, np.ones(len(rows.ids), bool), known.bigrams, known.more_bigrams)
            pair = two > 0
            deep = pair & np.concatenate([[False], pair[:-1]]) & ~found.first
            levels = np.stack([two, levels_of(found.triple, deep, known.trigrams, known.more_trigrams)])
            slot = rows.number * 0x9E3779B1 % (shards * KINDS)
            whole = {
                "bucket": slot, "slice": rows.number, "kind": 0, "keys": _packed(rows.ids.astype(np.int32)), "vals": _packed(levels.reshape(-1)),
                "docs": rows.docs, "names": rows.names.tobytes() if asks else b"",
            }
            yield pa.RecordBatch.from_pylist([whole], schema=asked_schema)
            if not asks:
                continue
            for kind, keys, _ in rows.asked(found, levels):
                bucket, order, cuts = _ranges(kind, shards, keys)
                n = len(bucket)
                arrays = [
                    pa.array(bucket), pa.array([rows.number] * n, pa.int64()), pa.array([kind] * n, pa.int32()), _blobs(keys[order], cuts),
                    *[pa.nulls(n, pa.binary())] * 3,
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=asked_schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, n = None, None, None
        for rows in batches:
            out = []
            for i in range(len(rows)):
                bucket, number, kind = (rows.column(c)[i].as_py() for c in ("bucket", "slice", "kind"))
                if number is None:
                    at, keys, n = bucket, *(np.frombuffer(rows.column(c)[i].as_py(), t) for c, t in (("keys", np.uint64), ("vals", np.int64)))
                elif kind == 0:
                    yield rows.slice(i, 1)
                elif bucket == at and len(keys):
                    asked = np.frombuffer(rows.column("keys")[i].as_buffer(), np.uint64)
                    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                    counts = np.where(keys[place] == asked, n[place], 0).astype(np.int32)
                    if counts.any():
                        out.append({"bucket": bucket, "slice": number, "kind": kind, "vals": _packed(counts)})
            yield pa.RecordBatch.from_pylist(out, schema=asked_schema)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, answers = None, {}

        def joined() -> pa.RecordBatch:
            sizes = _docs(pa.py_buffer(whole["docs"])).column("size").to_numpy()
            total = sizes.sum()
            ids, levels = _unpacked(pa.py_buffer(whole["keys"]), total, np.int32), _unpacked(pa.py_buffer(whole["vals"]), 2 * total, np.uint8).reshape(2, total)
            codes = [ids.copy(), *np.where(levels == ASKED_FOR, 0, -levels.astype(np.int32))]
            if answers:
                rows = Slice(whole["slice"], whole["docs"], sizes, None, ids.astype(np.int64), np.frombuffer(whole["names"], np.uint64))
                for kind, keys, places in rows.asked(rows.ngrams(end_number), levels):
                    bucket, order, cuts = _ranges(kind, shards, keys)
                    n = np.zeros(len(keys), np.int32)
                    for of, start, end in zip(bucket.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=True):
                        if of in answers:
                            n[order[start:end]] = _unpacked(pa.py_buffer(answers[of]), end - start, np.int32)
                    codes[ORDER[kind]][places] = -n if kind == WORDS else n
            packed = {name: _packed(np.ascontiguousarray(code, np.int32)) for name, code in zip(CODES, codes, strict=True)}
            return pa.RecordBatch.from_pylist([{"docs": whole["docs"]} | packed], schema=found_schema)

        for rows in batches:
            for i in range(len(rows)):
                if rows.column("kind")[i].as_py() == 0:
                    if whole is not None:
                        yield joined()
                    whole, answers = rows.slice(i, 1).to_pylist()[0], {}
                else:
                    answers[rows.column("bucket")[i].as_py()] = rows.column("vals")[i].as_py()
        if whole is not None:
            yield joined()

    asked_schema = pa.schema(
        [("bucket", pa.int64()), ("slice", pa.int64()), ("kind", pa.int32())] + [(c, pa.binary()) for c in ("keys", "vals", "docs", "names")]
    )
    found_schema = pa.schema([(c, pa.binary()) for c in ("docs", *CODES)])
    found = texts.mapInArrow(ask, ASKED)
    if asks:
        parts = _parts(texts, model.train_tokens)
        none = F.lit(None)
        counts = model.rest.select(
            "bucket", none.cast("bigint").alias("slice"), F.lit(0).alias("kind"), "keys", F.col("n").alias("vals"),
            *[none.cast("binary").alias(c) for c in ("docs", "names")],
        )
        met = found.unionByName(counts).repartition(parts, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("slice"))
        found = met.mapInArrow(answer, ASKED).repartition(parts, "slice").sortWithinPartitions("slice", "kind")
    return stored(found.mapInArrow(put, ", ".join(f"{c} binary" for c in found_schema.names)), "found", keep_shuffles=False)


class Known(NamedTuple):
    """Counts of the tokens of a slice: of the token, of the one before, of the n-grams, and of the bigram before."""

    docs: pa.RecordBatch
    sizes: np.ndarray
    codes: list[np.ndarray]
    one: np.ndarray
    before: np.ndarray
    two: np.ndarray
    context: np.ndarray
    three: np.ndarray


def _known(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, floor: int) -> Iterator[Known]:
    for rows in batches:
        for i in range(len(rows)):
            docs = _docs(rows.column("docs")[i].as_buffer())
            sizes = docs.column("size").to_numpy()
            # The number of a vocabulary word, else minus the count; minus the level in a filter, else the exact count.
            codes = [_unpacked(rows.column(name)[i].as_buffer(), sizes.sum(), np.int32) for name in CODES]
            one = np.where(codes[0] > 0, vocabulary.counts[np.maximum(codes[0], 0)], -codes[0])
            before = np.concatenate([vocabulary.counts[vocabulary.end : vocabulary.end + 1], one[:-1]])

            def count(code: np.ndarray) -> np.ndarray:
                """The count that a level stands for, the middle of its doubling in logarithms, or the exact one."""
                return np.where(code < 0, floor * 2.0 ** (-code - 0.5), code)

            two = np.minimum(count(codes[1]), np.minimum(one, before))
            context = np.concatenate([[0.0], two[:-1]])
            context[np.cumsum(sizes) - sizes] = 0
            three = np.where((two > 0) & (context > 0), np.minimum(count(codes[2]), np.minimum(two, context)), 0.0)
            yield Known(docs, sizes, codes, one, before, two, context, three)


def _other_votes(found: DataFrame, model: NgramModel) -> np.ndarray:
    """What the training tokens vote whose n-grams are below the floor or have a word outside the vocabulary."""
    vocabulary, total, floor = model.vocabulary, model.train_tokens, model.bigrams.floor
    shipped = found.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in _known(batches, shipped.value, floor):
            other = k.codes[0] <= 0
            other_two = other | np.concatenate([[False], other[:-1]])
            other_three = other_two | np.concatenate([[False], other_two[:-1]])
            mine = np.repeat(k.docs.column("learned").to_numpy(zero_copy_only=False), k.sizes)

            def without(count: np.ndarray, of: np.ndarray) -> np.ndarray:
                return np.where(count - 1 >= LEAST_COUNT, (count - 1) / np.maximum(of - 1, 1), 0.0)

            one = (k.one - 1) / max(total - 1, 1)
            two, three = without(k.two, k.before), without(k.three, np.maximum(k.context, k.three))
            # The filters' n-grams of vocabulary words have voted.
            by_two = mine & ((k.codes[1] > 0) | other_two) & (two > one)
            by_three = mine & ((k.codes[2] > 0) | other_three) & (three > np.maximum(one, two))
            votes = np.array([0.0, by_two.sum() - (by_three & (two > one)).sum(), by_three.sum()])
            votes[0] = -votes[1] - votes[2]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in votes], names=["one", "two", "three"])

    votes = found.mapInArrow(run, "one double, two double, three double").agg(F.sum("one"), F.sum("two"), F.sum("three")).first()
    return np.array([v or 0.0 for v in votes])


# --- scoring ----------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, model: NgramModel) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Null or empty text is the end token alone. Repeated rows and null ids pass through; other columns don't matter. For the
    base score, words outside the vocabulary are matched with their counts by a join, one row per word of a text.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.vocabulary)
    return _scored(look_up(tokenized(docs, F.lit(False), shipped), model), model)


def _scored(looked_up: DataFrame, model: NgramModel) -> DataFrame:
    shipped = looked_up.sparkSession.sparkContext.broadcast(model.vocabulary)
    floor, divisor, (one, two, three) = model.bigrams.floor, model.base, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in _known(batches, shipped.value, floor):
            p = (k.one + 0.1) / divisor
            pair_said, triple_said = k.before > 0, k.context > 0
            said = one * p + two * k.two / np.where(pair_said, k.before, 1) + three * k.three / np.where(triple_said, k.context, 1.0)
            score = np.log10(said / (one + two * pair_said + three * triple_said))
            inside = k.codes[0] > 0
            base = np.where(inside, np.log10(p), 0.0)
            starts = np.cumsum(k.sizes) - k.sizes
            arrays = [
                k.docs.column("row"), k.docs.column("doc_id"), k.docs.column("size"),
                pa.array(np.add.reduceat(inside, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts)),
                k.docs.column("word"), k.docs.column("times"),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "word", "times"])

    schema = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, word array<string>, times array<bigint>"
    found = stored(looked_up.mapInArrow(run, schema), "scored")
    others = found.filter(F.size("word") > 0).select("row", F.inline(F.arrays_zip("word", "times")))
    rare = model.token_counts.filter(F.col("n") < model.hot_floor)
    met = others.join(rare, "word", "left")
    log = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.1)) / F.lit(model.base))
    more = met.groupBy("row").agg(
        F.sum(F.col("times") * log).alias("logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known")
    )
    return found.drop("word", "times").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("logs", F.lit(0.0))).alias("base_score"), "score",
    )
