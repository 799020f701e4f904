"""Exact groups against a plain dictionary, with small blocks, and with hashes that collide."""

import hashlib
from collections import defaultdict

import pytest
from brute import norm
from pyspark.sql import functions as F

from martkit.llm import blocks


def brute(rows):
    """Multiset of (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r.text)].append(r)
    out = []
    for key, members in groups.items():
        ranked = sorted(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(m.doc_id, ranked[0].doc_id, len(members), m is ranked[0], sha) for m in ranked]
    return sorted(map(repr, out))


@pytest.mark.parametrize("size", [3, 64, 4096])
def test_groups(odd_docs, size):
    docs = odd_docs if size > 3 else odd_docs.filter("text IS NULL OR length(text) < 100")
    found = blocks.exact_groups(docs, size).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(docs.collect())


def test_colliding_addresses_are_seen(odd_docs):
    """Addresses that are too weak for seed 1 are noticed and replaced by others."""
    asked = []

    def weak(block, seed):
        asked.append(seed)
        return (F.octet_length(block) % 2, F.lit(0)) if seed == 1 else blocks._addresses(block, seed)

    named = blocks.content_names(odd_docs, 64, weak)
    assert {1, 3} <= set(asked)
    texts = odd_docs.select(F.sha2(blocks.normalised(F.coalesce("text", F.lit(""))), 256).alias("s")).distinct().count()
    assert named.select("n_blocks", "name").distinct().count() == texts


def test_drop(odd_docs):
    kept = blocks.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    found = [norm(r.text) for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == {norm(r.text) for r in odd_docs.collect()}


def test_no_documents(no_docs):
    assert blocks.exact_groups(no_docs).count() == 0 and blocks.drop_exact_copies(no_docs).count() == 0


def test_native(odd_docs):
    plan = blocks.exact_groups(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
