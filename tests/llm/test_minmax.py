"""Near-duplicates against all pairs, on odd documents, large groups, chains and the test corpus."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import near_components, shingles
from pyspark.sql import functions as F

from martkit.llm import minmax


def check(docs, size):
    rows = docs.collect()
    component, counts = near_components(rows, size)
    members = defaultdict(list)
    for r, c in zip(rows, component, strict=True):
        members[c].append(r)
    least = {c: min(((r.doc_id is None, r.doc_id) for r in m), key=lambda x: (x[0], x[1] or 0))[1] for c, m in members.items()}
    wanted = sorted(repr((r.doc_id, n, least[c])) for r, c, n in zip(rows, component, counts, strict=True))
    found = minmax.near_groups(docs, size).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(repr(tuple(r)) for r in found) == wanted
    kept = minmax.drop_near_copies(docs, size)
    assert kept.columns == docs.columns
    # One of each component; wordless documents are alone, and one of rows that agree in id and text stays.
    alone = {(r.doc_id, r.text) for r, n in zip(rows, counts, strict=True) if not n}
    assert kept.count() == len({c for c, n in zip(component, counts, strict=True) if n}) + len(alone)


@pytest.mark.parametrize("size", [2, 5])
def test_odd_documents(odd_docs, size):
    check(odd_docs, size)


def test_no_documents(no_docs):
    assert minmax.near_groups(no_docs).count() == 0 and minmax.drop_near_copies(no_docs).count() == 0


def edited(words, share, rng):
    return [f"new{rng.random()}" if rng.random() < share else w for w in words]


def test_groups_chains_and_shared_passages(spark):
    """A star of copies whose centre isn't the smallest id, a chain, exact copies, a passage that all texts share."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    centre = [f"c{i}" for i in range(200)]
    texts = [edited(centre, 0.04, rng) for _ in range(60)] + [centre] + [centre] * 20
    link = [f"l{i}" for i in range(300)]
    for _ in range(12):
        texts.append(link)
        link = edited(link, 0.04, rng)
    texts += [[f"u{rng.random()}" for _ in range(rng.choice([1, 2, 80, 300]))] + passage for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6), 2)


@pytest.mark.parametrize("rounds", [0, 4])
def test_more_rounds_give_the_same(spark, monkeypatch, rounds):
    """With other numbers of pivots before what is left is joined, and with texts shuffled instead of sent."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(base, 0.12, rng) for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    monkeypatch.setattr(minmax, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(minmax, "SENT_ROWS", 0)
    monkeypatch.setattr(minmax, "BLOCK_MEMBERS", 3)
    check(docs, 2)


@pytest.mark.parametrize("sets, paired", [(512, 64), (40, 2)])
def test_a_group_that_no_link_joins(spark, monkeypatch, sets, paired):
    """Texts a little less similar than the threshold, which only full sets can tell; three that are linked among them. Pairs of
    the group don't become rows."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    texts = [edited(base, 0.045, rng) for _ in range(300)]
    texts += [edited(texts[7], 0.02, rng), edited(texts[8], 0.02, rng), edited(texts[8], 0.02, rng)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(6)
    pairs, stored = [], minmax.stored

    def counted(df, name):
        out = stored(df, name)
        pairs.extend([out.count()] if name == "pairs" else [])
        return out

    monkeypatch.setattr(minmax, "stored", counted)
    monkeypatch.setattr(minmax, "BLOCK_SETS", sets, raising=False)
    monkeypatch.setattr(minmax, "BLOCK_SHINGLES", 300 * sets, raising=False)
    monkeypatch.setattr(minmax, "MOST_PAIRED", paired, raising=False)
    monkeypatch.setattr(minmax, "COLUMNS", 100, raising=False)
    found = minmax.near_groups(docs, 2).groupBy("component_id").agg(F.collect_list("doc_id").alias("ids")).filter("size(ids) > 1")
    named, (component, _) = found.collect(), near_components(docs.collect(), 2)
    wanted = defaultdict(list)
    for r, c in zip(docs.collect(), component, strict=True):
        wanted[c].append(r.doc_id)
    assert sorted(sorted(r.ids) for r in named) == sorted(sorted(m) for m in wanted.values() if len(m) > 1)
    assert {7, 300} <= {i for r in named for i in r.ids}
    assert max(pairs) < 15_000  # of 45,753


def test_links_between_blocks():
    """Exact counts, only links between components, and no more of them than join all."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**62, 400)

    def block(n, start):
        sets = [np.unique(np.concatenate([rng.choice(base, 370, False), rng.integers(0, 2**62, 12)])) for _ in range(n)]
        return pa.table({"node": range(start, start + n), "comp": [start + i // 2 for i in range(n)], "shingles": sets})

    a, b = block(9, 0), block(7, 100)
    x, y = ([set(s) for s in t.column("shingles").to_pylist()] for t in (a, b))
    shared, n, other = minmax._shared_counts(a, b)
    assert shared.tolist() == [[len(s & t) for t in y] for s in x]
    assert (n.tolist(), other.tolist()) == ([len(s) for s in x], [len(t) for t in y])
    assert len(minmax._links_between(a, b, 80)) == 5 + 4 - 1 and minmax._links_between(a, b, 99) == []
    assert all(p // 2 != q // 2 for p, q in minmax._links_between(a, a, 80))
    empty = a.slice(0, 0)
    assert minmax._shared_counts(empty, b)[0].shape == (0, 7)


def test_corpus(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), 2)


def test_sets_and_signatures():
    texts = ["", " ", "a b c", " A  b\tc\n", "a", "A\x0b", "b\x0cc d\r e", "É é É é", None]
    sets = minmax.shingle_sets(pa.array([t or "" for t in texts]), 2)
    assert [len(s) for s in sets] == [len(shingles(t, 2)) for t in texts]
    assert sets[2].tolist() == sets[3].tolist() and sets[4].tolist() == sets[5].tolist()
    # Both extremes agree as often as the sets are similar.
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    both = minmax.signatures([np.unique(a), np.unique(b)], 2000)
    share = (both[0] == both[1]).reshape(2, -1).mean(1)
    assert abs(share - 800 / 1200).max() < 0.04


@pytest.mark.parametrize("n", range(7))
def test_a_column_of_few_words(n):
    """Fewer words in all texts of a slice than a shingle has."""
    words = [f"w{i}" for i in range(n)]
    for texts in ([" ".join(words)], ["", *words[:1], " ".join(words[1:]), ""]):
        sets = minmax.shingle_sets(pa.array(texts), 5)
        assert [len(s) for s in sets] == [len(shingles(t, 5)) for t in texts]
    # The same set as beside other texts.
    alone, beside = minmax.shingle_sets(pa.array([" ".join(words)]), 5), minmax.shingle_sets(pa.array([" ".join(words), "x " * 9]), 5)
    assert alone[0].tolist() == beside[0].tolist()


def test_a_table_of_few_words(spark):
    for n in range(1, 6):
        docs = spark.createDataFrame([(1, " ".join("abcde"[:n]))], "doc_id bigint, text string")
        assert [r.n_shingles for r in minmax.near_groups(docs).collect()] == [1]
        assert minmax.drop_near_copies(docs).count() == 1


def test_components(spark):
    links = [(5, 1), (5, 9), (9, 12), (20, 21), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35)]
    found = minmax.components(spark.createDataFrame(links, "pivot bigint, node bigint"))
    assert {r.node: r.comp for r in found.collect()} == {1: 1, 5: 1, 9: 1, 12: 1, 20: 20, 21: 20} | dict.fromkeys(range(30, 36), 30)
    star = spark.range(1, 3000).select(F.lit(9000).alias("pivot"), F.col("id").alias("node"))
    assert minmax.components(star).filter("comp <> 1").count() == 0
