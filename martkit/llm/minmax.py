"""Near-duplicates by min-max hashing: of each permutation both the smallest and the largest hash are kept.

A document is its set of word shingles. Both extremes of a permutation agree between two sets with the chance of
their Jaccard similarity, so K permutations give a signature of 2 K values for half of the hash evaluations.
Bands of values make buckets; documents that share a bucket are candidates, and a link needs the full sets.

Work is kept linear where groups are large. Documents with equal sets are one node. In a bucket all members are
compared with one pivot, the member that meets most others over all its buckets; what is linked becomes one
component, and only pairs of different components are left to compare. A pivot's pairs are then all done, so it leaves
the bucket and another one's turn comes. What is left, mostly texts with a common passage that are no copies, is bounded
by the shingles they can have in common at all. Pairs within the bound are compared: in small buckets pair by pair, while
the sets of large ones are dealt in blocks, and two blocks that meet in a bucket are multiplied in one task, so that a pair
of a large group is a number in a matrix and never a row. So no pair of a bucket is skipped that could join two components,
and links inside a component don't change the result. With the default bands a pair at the threshold shares no bucket with
chance 3e-6.

Whatever is computed from the texts once is written to the shared folder. Texts of candidates are read again
to compare full sets; a pivot's text goes to blocks of members, never all members to one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import release_memory, slices
from martkit.sources.layers import stored

PERMUTATIONS = 80
BAND_VALUES = 5
PERCENT = 80
#: Members that are compared with one copy of their pivot's text.
BLOCK_MEMBERS = 128
#: After so many pivots for each bucket what remains is compared pair by pair or block by block.
STAR_ROUNDS = 2
#: Buckets with more members than this after that are compared block by block.
MOST_PAIRED = 64
#: Sets, and shingles, that a block of them has on average at most; the shingles that two blocks have in common are
#: multiplied so many at a time.
BLOCK_SETS, BLOCK_SHINGLES = 512, 200_000
COLUMNS = 2048
#: Four bits of each signature value estimate a pair's similarity before texts are fetched. A pair is left out if its
#: estimate is so many standard deviations below the threshold (chance 5e-6 for a pair at the threshold); pairs with a
#: set below LEAST_ESTIMATED, whose estimates spread more, are all compared.
DEVIATIONS = 4.4
LEAST_ESTIMATED = 20
#: Rows that are sent to every task instead of shuffling the texts towards them (about 50 bytes each).
SENT_ROWS = 200_000
#: Text that is worked on at a time; NumPy and Arrow hold some thirty times as much for a moment.
SLICE_BYTES = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * MIX


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``size`` words.

    A text of fewer words has its whole sequence as one shingle; without words the set is empty. Words are what
    stands between ASCII white space, A-Z in lower case.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
    ends = ends - ends[0]
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.empty(0, bool)
    words = known[codes[real]] if len(codes) else np.empty(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(real)])[ends]
    joined = words.copy()
    for k in range(1, size):
        rest = max(0, len(words) - k)
        joined[:rest] = _mixed(joined[:rest]) + words[k:]
    joined = _mixed(joined)
    out = []
    for start, end in zip(ends.tolist(), ends[1:].tolist(), strict=False):
        if end - start >= size:
            out.append(np.unique(joined[start : end - size + 1]))
        elif end > start:
            whole = xxhash.xxh64_intdigest(words[start:end].tobytes(), seed=1)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _constants(permutations: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, (2, permutations), np.int64).astype(np.uint64)


def signatures(sets: list[np.ndarray], permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row per non-empty set: the smallest hash of each permutation, then the largest of each."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    xors, factors = _constants(permutations)
    for k in range(permutations):
        hashed = (flat ^ xors[k]) * (factors[k] | np.uint64(1))
        out[:, k] = np.minimum.reduceat(hashed, starts)
        out[:, permutations + k] = np.maximum.reduceat(hashed, starts)
    return out


def band_keys(signature: np.ndarray, values: int = BAND_VALUES) -> np.ndarray:
    """A 64-bit key per band, of its number and values."""
    bands = signature.shape[1] // values
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for column in range(band * values, (band + 1) * values):
            key = _mixed(key) + signature[:, column]
        keys[:, band] = _mixed(key)
    return keys.view(np.int64)


def nibbles(signature: np.ndarray) -> np.ndarray:
    """Four bits of each value, sixteen values to a 64-bit number. Values are mixed first, as extremes share bits."""
    low = np.zeros((len(signature), -signature.shape[1] % 16), np.uint64)
    values = np.concatenate([_mixed(signature) >> np.uint64(60), low], 1).reshape(len(signature), -1, 16)
    return np.bitwise_or.reduce(values << np.arange(0, 64, 4, dtype=np.uint64), 2).view(np.int64)


def _may_be_similar(a: Column, b: Column, least: Column, values: int, percent: int) -> Column:
    """False for pairs whose estimated similarity is far below the threshold. a and b are arrays of nibbles."""
    p = percent / 100 + (1 - percent / 100) / 16
    enough = values * p - DEVIATIONS * math.sqrt(values * p * (1 - p))
    differing = F.lit(0)
    for i in range(-(-values // 16)):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return (least < LEAST_ESTIMATED) | (F.lit(values) - differing >= enough)


def sketch(docs: DataFrame, size: int, permutations: int = PERMUTATIONS, values: int = BAND_VALUES) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key (null for an empty set), bands, nibbles, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(rows.column("text").fill_null(""), size)
                full = [s for s in sets if len(s)]
                signed = signatures(full, permutations) if full else np.empty((0, 2 * permutations), np.uint64)
                keys, bits = iter(band_keys(signed, values)), iter(nibbles(signed))
                found = [(next(keys), next(bits)) if len(s) else (None, None) for s in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                arrays = [
                    rows.column("doc_id"), rows.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()), pa.array([k for k, _ in found], pa.list_(pa.int64())),
                    pa.array([b for _, b in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", "n_shingles", "set_key", "bands", "nibbles"])
            release_memory()

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return narrow.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<bigint>, nibbles array<bigint>")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (id, text_hash, ...) with the texts. Its rows are sent to all tasks if counted to be few; beyond, both are
    shuffled."""
    if wanted.count() <= SENT_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("__key_hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("__key_hash") == F.col("text_hash"))
    return texts.join(wanted, same)


def compare(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs (pivot, node) those whose full sets are similar.

    Members are dealt in blocks, each with one copy of its pivot's text.
    """
    counts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = pairs.join(counts, "pivot").select("pivot", block.alias("block"), "node")
    pivots = members.select("pivot", "block").distinct().withColumn("node", F.col("pivot"))
    wanted = members.withColumn("member", F.lit(True)).unionByName(pivots.withColumn("member", F.lit(False)))
    wanted = stored(wanted.join(nodes.select("node", F.col("doc_id").alias("id"), "text_hash"), "node"), "wanted")
    dealt = _texts_of(docs, wanted).select("pivot", "block", "member", "node", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "pivot", "block").sortWithinPartitions("pivot", "block", "member", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, last = None, None, None
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(rows.column("text"), size)
                places = rows.select(["pivot", "block", "member", "node"]).to_pylist()
                linked = []
                for row, found in zip(places, sets, strict=True):
                    if not row["member"]:
                        at, own = (row["pivot"], row["block"]), found
                    elif (key := (*at, row["node"])) != last:  # a repeated row comes once more
                        last = key
                        if _similar(own, found, percent):
                            linked.append((row["pivot"], row["node"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in linked], pa.int64()), pa.array([n for _, n in linked], pa.int64())],
                    names=["pivot", "node"],
                )
            release_memory()

    return dealt.mapInArrow(run, "pivot long, node long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of links (pivot, node); comp is the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of the label, until none changes:
    rounds grow with the logarithm of the longest path. Minima are combined per task, so a node with very many links
    is no burden.
    """
    both = links.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        met = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("met"))
        lower = labels.join(met, "node").select("node", F.col("comp").alias("old"), F.least("comp", "met").alias("comp"))
        of = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        jumped = lower.join(of, "comp").select("node", "old", F.least("comp", "next").alias("comp"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "comp")
        if jumped.filter("old <> comp").isEmpty():
            return labels


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, nibbles, mass) of all buckets with two members or more; mass: memberships that a node meets."""
    buckets = nodes.select(F.explode("bands").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = stored(buckets.join(shared, "bucket"), "members")
    mass = members.groupBy("node").agg(F.sum("m").alias("mass"))
    bits = nodes.select("node", "nibbles")
    return stored(members.drop("m").join(mass, "node").join(bits, "node"), "members")


def _candidate(percent: int) -> Column:
    """Whether a pair (n, nibbles) and (other, bits) is worth comparing, by sizes and by estimate."""
    least = F.least("n", "other")
    sizes = 100 * least >= percent * F.greatest("n", "other")
    return sizes & _may_be_similar(F.col("nibbles"), F.col("bits"), least, 2 * PERMUTATIONS, percent)


def _linked_nodes(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(node, comp) of the nodes that have links; None if there are no candidates."""
    members = _members(nodes).withColumn("comp", F.col("node"))
    links, labels, rounds = None, None, 0
    while True:
        if labels is not None:
            # What is left: buckets with members of several components.
            named = members.drop("comp").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            mixed = named.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
            members = stored(named.join(mixed.select("bucket"), "bucket", "left_semi"), "members")
        if members.isEmpty():
            return labels
        last, met = rounds >= STAR_ROUNDS, None
        if last:
            pairs, met = _leftover(docs, members, nodes, size, percent)
        else:
            # First the node that meets most others, which is the centre of a group if there is one; then any.
            turn = F.col("mass") if rounds == 0 else F.xxhash64(F.lit(rounds), "bucket", "node")
            best = members.groupBy("bucket").agg(F.max_by(F.struct("node", "n", "comp", "nibbles"), F.struct(turn, "node")).alias("best"))
            top = best.select(
                "bucket", F.col("best.node").alias("pivot"), F.col("best.n").alias("other"), F.col("best.comp").alias("c"),
                F.col("best.nibbles").alias("bits"),
            )
            rest = stored(members.join(top, "bucket").filter(F.col("node") != F.col("pivot")), "rest")
            pairs, members = rest.filter(F.col("c") != F.col("comp")), rest.drop("pivot", "other", "c", "bits")
            pairs = pairs.filter(_candidate(percent))
        pairs = stored(pairs.select("pivot", "node").distinct(), "pairs")
        found = compare(docs, nodes, pairs, size, percent)
        found = stored(found if met is None else found.unionByName(met), "found")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            return labels
        rounds += 1


def _leftover(docs: DataFrame, members: DataFrame, nodes: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pivot, node) twice: the pairs of small buckets that are yet to be compared, each once, and the links of large ones.

    Only pairs of different components count. Members of a bucket may all have a passage in common and yet be no copies; there
    are too many pairs of those to compare all texts. So it is counted how many shingles of each node any other node that is
    left has: no intersection can be larger. Nodes, and pairs, for which this is too little are done.
    """
    left = members.select("node", "comp", "mass", "nibbles", "n").dropDuplicates(["node"])
    wanted = stored(left.join(nodes.select("node", F.col("doc_id").alias("id"), "text_hash"), "node").select("node", "id", "text_hash"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                sets = [s.view(np.int64) for s in shingle_sets(rows.column("text"), size)]
                yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = _texts_of(docs, wanted).select("node", "text").mapInArrow(run, "node long, shingles array<bigint>")
    sets = stored(sets.dropDuplicates(["node"]), "sets")
    rows = sets.select("node", F.explode("shingles").alias("shingle"))
    others = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    shared = rows.join(others, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    known = left.join(shared, "node").filter(100 * F.col("shared") >= percent * F.col("n")).join(nodes.select("node", "bands"), "node")
    b = members.select("bucket", "node").join(known, "node")
    # Of each bucket's nodes those in its largest component needn't meet each other.
    main = b.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("bucket")
    main = main.agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("m").alias("m")).filter("parts > 1")
    b = stored(b.join(main.drop("parts"), "bucket"), "meetings")
    few, many = b.filter(F.col("m") <= MOST_PAIRED).drop("m"), b.filter(F.col("m") > MOST_PAIRED)
    return _small_buckets(few, percent), _large_buckets(many, sets, percent)


def _small_buckets(b: DataFrame, percent: int) -> DataFrame:
    """(pivot, node): the pairs of different components that may be similar."""
    a = b.select(
        "bucket", F.col("node").alias("pivot"), F.col("n").alias("other"), F.col("comp").alias("c"), (F.col("comp") == F.col("main")).alias("in_main"),
        F.col("shared").alias("s"), F.col("bands").alias("of"), F.col("nibbles").alias("bits"),
    )
    # The smaller set of a similar pair has few shingles of its own: 2 n <= (1 + 1 / threshold) shared.
    a = a.filter(2 * percent * F.col("other") <= (100 + percent) * F.col("s"))
    most = F.least("shared", "s")
    enough = 100 * most >= percent * (F.col("n") + F.col("other") - most)
    smaller = (F.col("other") < F.col("n")) | ((F.col("other") == F.col("n")) & (F.col("pivot") < F.col("node")))
    # A pair is taken in the first bucket both were put in. If one of them has left it, it was pivot there, and the pair
    # has been compared; if a whole bucket is left out, all in it are one component; a large one is compared by itself.
    once = F.get(F.array_intersect("of", "bands"), F.lit(0)) == F.col("bucket")
    wanted = (F.col("c") != F.col("comp")) & smaller & enough & _candidate(percent) & once
    outside = a.filter("NOT in_main").join(b, "bucket").filter(wanted)
    inside = a.filter("in_main").join(b.filter("comp <> main"), "bucket").filter(wanted)
    return outside.select("pivot", "node").unionByName(inside.select("pivot", "node"))


def _large_buckets(b: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, node): links between different components, enough of them to join what any link joins.

    A node belongs to its largest bucket. What belongs to one, its largest component by itself, is cut into blocks; two blocks
    with members in a common bucket meet in one task, in which all full sets of one are compared with those of the other.
    """
    own = b.groupBy("node", "comp", "n").agg(F.max_by(F.struct("bucket", "main"), F.struct("m", "bucket")).alias("home"))
    own = own.select("node", "comp", "n", F.col("home.bucket").alias("home"), F.when(F.col("comp") == F.col("home.main"), F.col("comp")).alias("main"))
    group = F.xxhash64("home", F.coalesce("main", F.lit(-1)))
    own = own.withColumn("part", group)
    needed = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    cuts = own.groupBy("part").agg(needed.alias("blocks"))
    number = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = stored(own.join(cuts, "part").select("node", "comp", "main", F.xxhash64("part", number).alias("block")), "blocks")
    x = b.select("bucket", "node").join(dealt, "node").select("bucket", "block", "main").distinct()
    y = x.select("bucket", F.col("block").alias("other"), F.col("main").alias("other_main"))
    alike = F.coalesce(F.col("main") == F.col("other_main"), F.lit(False))
    tiles = x.join(y, "bucket").filter((F.col("block") <= F.col("other")) & ~alike).select("block", "other").distinct()
    tiles = stored(tiles, "tiles")
    sides = tiles.select("block", "other", F.lit(True).alias("first"), F.col("block").alias("of"))
    sides = sides.unionByName(tiles.filter("block <> other").select("block", "other", F.lit(False).alias("first"), F.col("other").alias("of")))
    placed = stored(dealt.select(F.col("block").alias("of"), "node", "comp").join(sets, "node"), "placed")
    met = sides.join(placed, "of").select("block", "other", "first", "node", "comp", "shingles")

    def run(rows: pa.Table) -> pa.Table:
        a = rows.filter(rows.column("first")).sort_by("node").combine_chunks()
        b = rows.filter(pc.invert(rows.column("first"))).sort_by("node").combine_chunks()
        links = _links_between(a, b if len(b) else a, percent)
        return pa.table({"pivot": pa.array([p for p, _ in links], pa.int64()), "node": pa.array([n for _, n in links], pa.int64())})

    return met.groupBy("block", "other").applyInArrow(run, "pivot long, node long")


def _shared_counts(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many shingles each set of a has in common with each of b, and the sizes of both."""
    sizes = [pc.list_value_length(t.column("shingles")).to_numpy().astype(np.int64) for t in (a, b)]
    flat = [pc.list_flatten(t.column("shingles")).to_numpy() for t in (a, b)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    entries = []
    for values, n in zip(flat, sizes, strict=True):
        at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
        hit = np.flatnonzero(common[at] == values) if len(common) else np.empty(0, np.int64)
        hit = hit[np.argsort(at[hit], kind="stable")]
        entries.append((at[hit], np.repeat(np.arange(len(n)), n)[hit], len(n)))
    shared = np.zeros((len(a), len(b)), np.int64)
    for start in range(0, len(common), COLUMNS):
        both = []
        for column, row, n in entries:
            lo, hi = np.searchsorted(column, [start, start + COLUMNS])
            has = np.zeros((n, min(COLUMNS, len(common) - start)), np.float32)
            has[row[lo:hi], column[lo:hi] - start] = 1
            both.append(has)
        shared += (both[0] @ both[1].T).astype(np.int64)
    return shared, *sizes


def _links_between(a: pa.Table, b: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of a (node, comp, shingles) with b that join components, each only if those before it don't."""
    shared, n, other = _shared_counts(a, b)
    comps = [t.column("comp").to_numpy() for t in (a, b)]
    similar = 100 * shared >= percent * (n[:, None] + other[None, :] - shared)
    similar &= comps[0][:, None] != comps[1][None, :]
    nodes, parent, links = [t.column("node").to_numpy() for t in (a, b)], {}, []

    def top(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    for i, j in zip(*(x.tolist() for x in np.nonzero(similar)), strict=True):
        x, y = top(int(comps[0][i])), top(int(comps[1][j]))
        if x != y:
            parent[x] = y
            links.append((int(nodes[0][i]), int(nodes[1][j])))
    return links


def near_groups(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_shingles, component_id, keep_hash.

    component_id is the smallest doc_id (null last) among the documents that links reach, itself included;
    keep_hash is the text_hash of one document with that id. Null or wordless texts have an empty set and are alone.
    """
    sketched = stored(sketch(docs, size), "sketch")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    whole = F.struct("doc_id", "text_hash", "n_shingles", "bands", "nibbles")
    full = sketched.filter("set_key IS NOT NULL")
    nodes = full.groupBy("set_key").agg(F.min_by(whole, order).alias("of"))
    nodes = stored(nodes.select("set_key", "of.*", F.monotonically_increasing_id().alias("node")), "nodes")
    labels = _linked_nodes(docs, nodes, size, percent)
    named = nodes.select("set_key", "node", "doc_id", "text_hash")
    if labels is None:
        named = named.withColumn("comp", F.col("node"))
    else:
        named = named.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = stored(named, "named")
    least = named.groupBy("comp").agg(F.min(order).alias("least"))
    of_set = named.join(least, "comp").select("set_key", F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("keep_hash"))
    alone = sketched.filter("set_key IS NULL").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.col("text_hash").alias("keep_hash")
    )
    return full.join(of_set, "set_key").select("doc_id", "text_hash", "n_shingles", "component_id", "keep_hash").unionByName(alone)


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each component, all columns; of rows that agree in id and text one stays."""
    keys = ["__key_id", "__key_hash"]
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    groups = near_groups(docs, size, percent)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keep_hash")))
    kept = kept.select(number.alias("__key_id"), F.col("text_hash").alias("__key_hash"))
    keyed = docs.select("*", number.alias("__key_id"), F.xxhash64("text").alias("__key_hash"))
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)
