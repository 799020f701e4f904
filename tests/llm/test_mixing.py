"""The mix against a plain fair queue; targets against repeated resharing."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from martkit.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshared(sizes, weights, budget):
    """Stop at twice the size and reshare the excess by weight until none is above."""
    target, open_ = {}, set(sizes)
    while open_:
        rest = budget - sum(target.values())
        unit = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit >= 2 * sizes[s]}
        if not full:
            return target | {s: weights[s] * unit for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return target


def brute(rows):
    sources = sorted({r.source for r in rows if r.source is not None}) + [None] * any(r.source is None for r in rows)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    total = sum(sizes.values())
    targets = reshared(dict(sizes), weights, 1.5 * total)
    turns = []
    for s in sources:
        mine = [r for r in rows if r.source == s]
        mine.sort(key=lambda r: (hashlib.md5((str(r.doc_id) if r.doc_id is not None else "null").encode()).hexdigest(), words(r.text)))
        at = 0
        for again in (0, 1):
            for k, r in enumerate(mine):
                at += words(r.text)
                if words(r.text):
                    turns.append((at / targets[s], sources.index(s), words(r.text), (s, k)))
    left, taken = int(1.5 * total), defaultdict(int)
    for _, _, n, key in sorted(turns):
        taken[key] += min(n, left)
        left -= min(n, left)
    out = []
    for s in sources:
        mine = [r for r in rows if r.source == s]
        mine.sort(key=lambda r: (hashlib.md5((str(r.doc_id) if r.doc_id is not None else "null").encode()).hexdigest(), words(r.text)))
        out += [(r.doc_id, words(r.text), sizes[s], round(targets[s], 6), taken[s, k]) for k, r in enumerate(mine)]
    return sorted(map(repr, out))


def rounded(df):
    rows = df.select("doc_id", "size", "source_size", F.round("target", 6), "taken").collect()
    return sorted(repr(tuple(r)) for r in rows)


def test_odd_documents(odd_docs):
    assert rounded(mixing.mix(odd_docs)) == brute(odd_docs.collect())


def test_hot_source(spark, monkeypatch):
    """A third of the rows in one source, and ranges of few rows."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    docs = spark.range(900).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS source", "repeat('w ', CAST(id * 37 % 50 AS INT)) AS text"
    )
    found = mixing.mix(docs)
    assert rounded(found) == brute(docs.collect())
    by_source = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 50 for r in by_source.collect())
    assert found.filter("taken > 2 * size").count() == 0
    assert rounded(mixing.mix(docs.repartition(5))) == rounded(found)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == found.agg(F.sum("turns")).first()[0]


def test_nothing_to_mix(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    empty = spark.sql("SELECT 1L AS doc_id, CAST(NULL AS STRING) AS text, 'a' AS source")
    row = mixing.mix(empty).first()
    assert (row["size"], row["source_size"], row["target"], row["taken"]) == (0, 0, 0.0, 0)


def test_native(odd_docs):
    plan = mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
