"""How two tokenizers cut the same bytes: groups of tokens between shared ends, and the pairs of tokens that overlap.

Both token sequences of a text cover its bytes, with a space before it. A byte offset where tokens of both end is a
shared cut. Cuts are found by divide and conquer: the shared end next to the middle of an interval is looked for
by bisection, outwards from the middle, and both halves are searched in turn. What was passed on the way to the cut
holds none and is not looked at again, so every token is probed once. An interval without a cut is a leaf group.

Neither vocabulary has an entry that goes on behind a space, so a text is first cut before single spaces, and what a
piece gives is kept per worker. Texts in which a space touches other white space are aligned whole.

How often a pair of ids is linked in the corpus is counted over stored pairs; the frequent pairs are then looked
up in a table of bounded size that every task gets, all others meet their counts in a join.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import frequent_floor, slices
from martkit.llm.tokens import SPACES, Pieces
from martkit.sources.layers import stored

#: Ids of both vocabularies are below 2 ** ID_BITS; a pair is one number.
ID_BITS = 20
#: Pairs that are sent to every task, the most frequent ones (17 bytes each); the counts of all others are joined.
SENT_PAIRS = 400_000
#: Pieces up to so many characters are remembered, and so many of them in a worker.
UNIT_CHARS, UNITS = 64, 500_000
TOUCHING = f"[{SPACES}] | [{SPACES}]"
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)
MEASURED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of the given lengths, which may be 0."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(counts)])])


def shared_ends(a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The tokens of a, in order, whose end is an end of b too.

    a and b are rising ends of tokens over the same bytes, of one text or of several one after the other; starts are the
    first tokens in a of each text. Zones of tokens that may hold a cut are searched all at once, each outwards from its
    middle: a step probes one more token of every zone, and a cut leaves two zones in its place.
    """
    low, high = starts, np.append(starts[1:], len(a))
    middle = (low + high) // 2
    left, right = middle - 1, middle  # what lies between them has been probed
    found = []
    while len(low):
        to_right = (right < high) & ((left < low) | (right - middle <= middle - 1 - left))
        at = np.where(to_right, right, left)
        left, right = left - ~to_right, right + to_right
        hit = b[np.searchsorted(b, a[at])] == a[at]
        found.append(at[hit])
        on = ~hit & ((left >= low) | (right < high))
        new_low, new_high = np.concatenate([low[hit], right[hit]]), np.concatenate([left[hit] + 1, high[hit]])
        some = new_low < new_high
        new_low, new_high = new_low[some], new_high[some]
        new_middle = (new_low + new_high) // 2
        low, high, middle = np.append(low[on], new_low), np.append(high[on], new_high), np.append(middle[on], new_middle)
        left, right = np.append(left[on], new_middle - 1), np.append(right[on], new_middle)
    return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)


class Runs(Pieces):
    """Rows of variable length that also come many at a time."""

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.count + len(lengths) > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.empty_like(self.offsets)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.flat[self.used : self.used + len(flat)] = flat
        new = slice(self.count, self.count + len(lengths))
        self.offsets[new], self.lengths[new] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(flat)
        self.count += len(lengths)


class Aligner:
    """Both tokenizers and what is known of the pieces met so far."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = tokenizers.Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        # The letters that byte-level vocabularies write for bytes: printable ones stand for themselves.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [i for i in range(256) if i not in printable]
        byte_of = {chr(i): i for i in printable} | {chr(256 + k): i for k, i in enumerate(others)}
        self.a_bytes, self.b_bytes, self.decimals = Runs(np.uint8), Runs(np.uint8), Runs(np.uint8)
        entries = sorted((i, entry) for entry, i in self.a.get_vocab().items())
        assert [i for i, _ in entries] == list(range(len(entries))) and len(entries) < 1 << ID_BITS
        for _, entry in entries:
            data = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
            self.a_bytes.append(np.frombuffer(data, np.uint8))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces):
            data = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()
            self.b_bytes.append(np.frombuffer(data, np.uint8))
        for i in range(max(len(entries), len(pieces))):
            self.decimals.append(np.frombuffer(b"%d," % i, np.uint8))
        self.space = self.b.piece_to_id("\u2581")
        # Texts are cut before single spaces only if both cut there: no piece goes on behind a space, and pre-tokens start with it.
        pre_tokens = [p for p, _ in self.a.pre_tokenizer.pre_tokenize_str(" a b. c")]
        self.cuttable = not any("\u2581" in p.lstrip("\u2581") for p in pieces) and len(pre_tokens) == 4
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[str, int] = {}
        self.numbers = Runs(np.int64)  # valid, n_a, n_b, n_groups of each piece
        self.texts, self.links = Runs(np.uint8), Runs(np.int64)

    def _remember(self, units: list[str], b_lists: list[list[int]]) -> np.ndarray:
        """Align pieces, all at once; returns their slots. Pieces whose bytes a tokenizer doesn't give back aren't valid."""
        a_lists = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(units)) for ids in (a_lists, b_lists))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((a_lists, n_a), (b_lists, n_b)))
        data = [u.encode() for u in units]
        sizes = np.fromiter(map(len, data), np.int64, len(units))
        valid = (_sums(self.a_bytes.lengths[a], n_a) == sizes) & (_sums(self.b_bytes.lengths[b], n_b) == sizes)
        for _ in range(2):  # of pieces of the right length, those with other bytes go in a second round
            a, b = a[np.repeat(valid, n_a)], b[np.repeat(valid, n_b)]
            n_a, n_b, sizes = (np.where(valid, x, 0) for x in (n_a, n_b, sizes))
            whole = np.frombuffer(b"".join(compress(data, valid)), np.uint8)
            differ = (self.a_bytes.rows(a) != whole) | (self.b_bytes.rows(b) != whole)
            if not differ.any():
                break
            valid = valid & (_sums(differ, sizes) == 0)
        a_ends, b_ends = np.cumsum(self.a_bytes.lengths[a]), np.cumsum(self.b_bytes.lengths[b])
        starts = (np.cumsum(n_a) - n_a)[valid]
        cuts = shared_ends(a_ends, b_ends, starts)
        # Tokens in the order of the groups' text: of each group those of a, then those of b.
        b_cuts = np.searchsorted(b_ends, a_ends[cuts])
        a_group, b_group = np.searchsorted(cuts, np.arange(len(a))), np.searchsorted(b_cuts, np.arange(len(b)))
        a_place = np.arange(len(a)) + np.concatenate([[0], b_cuts + 1])[a_group]
        b_place = np.arange(len(b)) + cuts[b_group] + 1
        tokens = np.empty(len(a) + len(b), np.int64)
        tokens[a_place], tokens[b_place] = a, b
        widths = self.decimals.lengths[tokens]
        text, behind = self.decimals.rows(tokens), np.cumsum(widths) - 1
        text[behind[a_place[cuts]]], text[behind[b_place[b_cuts]]] = ord("|"), ord(";")
        # Every end of either sequence ends one overlap.
        ends = np.union1d(a_ends, b_ends)
        linked = np.searchsorted(a_ends, ends)
        links = a[linked] << ID_BITS | b[np.searchsorted(b_ends, ends)]
        unit = np.repeat(np.arange(len(units)), n_a)
        n_groups, n_links = np.bincount(unit[cuts], minlength=len(units)), np.bincount(unit[linked], minlength=len(units))
        first = self.numbers.count
        self.numbers.extend(np.stack([valid, n_a, n_b, n_groups], 1).ravel(), np.full(len(units), 4))
        self.texts.extend(text, _sums(widths, n_a + n_b))
        self.links.extend(links, n_links)
        return np.arange(first, first + len(units))

    def _lookup(self, words: list[str]) -> np.ndarray:
        """The slot of each distinct word with a space before it."""
        slots = self.slots
        missing = [w for w in words if w not in slots]
        fresh = {}
        if missing:
            b_lists = self.b.encode(missing, num_threads=1)
            new = self._remember([" " + w for w in missing], [ids if w else [self.space] for w, ids in zip(missing, b_lists, strict=True)])
            fresh = dict(zip(missing, new.tolist(), strict=True))
            slots.update((w, i) for w, i in fresh.items() if len(w) <= UNIT_CHARS)
        return np.fromiter((slots[w] if w in slots else fresh[w] for w in words), np.int64, len(words))

    def slots_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the pieces of all texts, one text after the other, and how many each text has; none for empty texts."""
        if len(self.slots) > UNITS or self.links.used > 8 * UNITS or self.texts.used > 32 * UNITS:
            self._reset()
        spaced = pc.binary_join_element_wise("", texts, " ")
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        uneven = pc.match_substring_regex(spaced, TOUCHING).to_numpy(zero_copy_only=False) | (not self.cuttable)
        parts = pc.split_pattern(texts.filter(pa.array(filled & ~uneven)), " ")
        words = parts.flatten().dictionary_encode()
        known = self._lookup(words.dictionary.to_pylist())
        slots = known[words.indices.to_numpy()] if len(known) else np.empty(0, np.int64)
        counts = np.zeros(len(texts), np.int64)
        counts[filled & ~uneven] = np.diff(parts.offsets.to_numpy())
        if whole := np.flatnonzero(filled & uneven).tolist():
            places = np.concatenate([[0], np.cumsum(counts)])[whole]
            found = [texts[i].as_py() for i in whole]
            slots = np.insert(slots, places, self._remember([" " + t for t in found], self.b.encode(found, num_threads=1)))
            counts[whole] = 1
        return slots, counts


@lru_cache(2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per Python worker."""
    return Aligner(byte_path, piece_path)


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, with_groups: bool = False) -> DataFrame:
    """ALIGNED of every row (and ``groups``, the text itself): its counts, and its distinct pairs with their numbers.

    Row by row, no shuffle. Null or empty texts, and those that a tokenizer doesn't give back byte by byte, have no tokens:
    zeros, no pairs and an empty text for the digest. Repeated rows and null ids pass through; other columns don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        for batch in batches:
            for rows in slices(batch, "text", 2_000_000):
                texts = rows.column("text").fill_null("")
                slots, counts = both.slots_of(texts)
                numbers = both.numbers.flat.reshape(-1, 4)[slots]
                valid = _sums(numbers[:, 0], counts) == counts
                slots, numbers = slots[np.repeat(valid, counts)], numbers[np.repeat(valid, counts)]
                counts = np.where(valid, counts, 0)
                n_a, n_b, n_groups = (_sums(numbers[:, k], counts) for k in (1, 2, 3))
                n_links = _sums(both.links.lengths[slots], counts)
                ends = np.concatenate([[0], np.cumsum(_sums(both.texts.lengths[slots], counts))]).tolist()
                flat = memoryview(both.texts.rows(slots))
                groups = [bytes(flat[start : end - 1]) if end > start else b"" for start, end in zip(ends, ends[1:], strict=False)]
                # Distinct pairs of each text: sort by text and pair, count runs.
                linked = np.repeat(np.arange(len(texts)), n_links) << (2 * ID_BITS) | both.links.rows(slots)
                linked, times = np.unique(linked, return_counts=True)
                bounds = np.searchsorted(linked >> (2 * ID_BITS), np.arange(len(texts) + 1)).astype(np.int32)
                pairs = linked & ((1 << 2 * ID_BITS) - 1)
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                arrays = [
                    rows.column("row"), rows.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)),
                    pa.array(digests, pa.string()), pa.ListArray.from_arrays(bounds, pa.array(pairs, pa.int64())),
                    pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())),
                ]
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                if with_groups:
                    arrays, names = [*arrays, pa.array([g.decode() for g in groups], pa.string())], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("bigint").alias("doc_id"), "text")
    return numbered.mapInArrow(run, ALIGNED + (", groups string" if with_groups else ""))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many rows a pair is linked, and whether no pair of its first id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", ID_BITS)), "pair-counts")
    tops = counts.groupBy("a").agg(F.max("n").alias("top"))
    return stored(counts.join(tops, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-counts")


def link_measures(aligned: DataFrame, counts: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """MEASURED of every row: n_best, the links whose pair is among its first id's most frequent, and the sum of all
    links' counts.

    At most ``sent_pairs`` counts, the highest ones, go to every task; rows with other pairs meet those counts by a join
    of which the table of counts is one side, so results don't depend on the limit.
    """
    spark = aligned.sparkSession
    floor = frequent_floor(counts, "n", sent_pairs)
    sent = counts.filter(F.col("n") >= floor).orderBy("pair").toPandas()
    table = spark.sparkContext.broadcast((sent["pair"].to_numpy(np.int64), sent["n"].to_numpy(np.int64), sent["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, best = table.value
        for rows in batches:
            lists = rows.column("pairs")
            sizes = pc.list_value_length(lists).to_numpy()
            pairs, times = lists.flatten().to_numpy(), rows.column("times").flatten().to_numpy().astype(np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                known = keys[at] == pairs
            else:
                at, known = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            counted, is_best = (numbers[at] * known, best[at] & known) if len(keys) else (at, known)
            bounds = pa.array(np.concatenate([[0], np.cumsum(_sums(~known, sizes))]), pa.int32())
            arrays = [
                *(rows.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
                pa.array(_sums(is_best * times, sizes), pa.int64()), pa.array(_sums(counted * times, sizes), pa.int64()),
                pa.ListArray.from_arrays(bounds, pa.array(pairs[~known], pa.int64())),
                pa.ListArray.from_arrays(bounds, pa.array(times[~known], pa.int64())),
            ]
            names = [f.split()[0] for f in MEASURED.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "other_pairs", "other_times"])

    found = stored(aligned.mapInArrow(run, MEASURED + ", other_pairs array<bigint>, other_times array<bigint>"), "measured")
    others = found.filter(F.size("other_pairs") > 0).select("row", F.inline(F.arrays_zip("other_pairs", "other_times")))
    met = others.join(counts.filter(F.col("n") < floor).withColumnRenamed("pair", "other_pairs"), "other_pairs")
    more = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("other_times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("other_times")).alias("more_sum"),
    )
    return found.drop("other_pairs", "other_times").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )


def alignments(docs: DataFrame, byte_path: str, piece_path: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = stored(align_documents(docs, byte_path, piece_path), "aligned")
    return link_measures(aligned, pair_counts(aligned), sent_pairs)
