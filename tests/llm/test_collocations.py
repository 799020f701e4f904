"""Phrases against plain counters, with containers that burst and tries that spill."""

import re
from collections import Counter

import pyarrow as pa
import pytest

from martkit.llm import collocations as c


def brute(rows, least=10, percent=50, top=2000):
    counts, totals = {}, Counter()
    for r in rows:
        lang = r.lang if r.lang is not None else "und"
        f = counts.setdefault(lang, Counter())
        text = "".join(x.lower() if "A" <= x <= "Z" else x for x in r.text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            f.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        mine = []
        for p, a in candidates.items():
            longer = [n for q, n in candidates.items() if len(q) > len(p) and p in [q[i : i + len(p)] for i in range(len(q) - len(p) + 1)]]
            if any(100 * n >= percent * a for n in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def found(df, **options):
    return sorted(tuple(r) for r in c.collocations(df, **options).collect())


@pytest.mark.parametrize("options", [{}, {"burst": 2, "held": 40}])
def test_odd_documents(odd_docs, options):
    rows = odd_docs.select("text", "lang").collect()
    assert found(odd_docs, least=1, **options) == brute(rows, least=1)
    assert found(odd_docs, least=2, top=3, covered_percent=80, **options) == brute(rows, 2, 80, 3)


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = brute(df.select("text", "lang").collect())
    assert len(wanted) > 50
    assert found(df.repartition(5), burst=50, held=5000) == found(df) == wanted


def test_scores_are_exact(spark):
    """Counts whose products pass 64 bits."""
    df = spark.createDataFrame([(10**15 + 7, 10**15 + 9, 10**15 + 33)], "a long, l long, r long")
    a, left, right = df.first()
    assert df.select(c._cut_score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_spilled_runs_are_sorted(spark):
    texts = ["b a b a c", "a b c é z, b a"]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    words = c._filter(c.word_counts(docs))
    trie = c.HatTrie(2, words, burst=1, held=4)
    trie.add("en", pa.array(texts))
    assert trie.full and any(x.children is not None for x in trie.roots.values())
    some = [r for b in trie.spill() for r in b.to_pylist()]
    assert trie.size <= 2 and some
    rest = [r for b in trie.spill(all_of_it=True) for r in b.to_pylist()]
    for run in (some, rest):
        assert [r["phrase"].split() for r in run] == sorted(r["phrase"].split() for r in run)
    assert sorted((r["phrase"], r["n"]) for r in some + rest) == [("a b", 2), ("a c", 1), ("b a", 3), ("b c", 1), ("c é", 1), ("é z", 1)]


def test_full_filter(spark, odd_docs, monkeypatch):
    """A filter that is far too small lets more through and changes nothing."""
    monkeypatch.setattr(c, "FILTER_BLOCKS", 1)
    assert found(odd_docs, least=2) == brute(odd_docs.select("text", "lang").collect(), least=2)


def test_empty_table(no_docs):
    assert found(no_docs) == []


def test_a_long_text(spark):
    """Five megabytes in one text."""
    text = "one two three four five. " * 200_000
    rows = found(spark.createDataFrame([(text, "en")], "text string, lang string"))
    n = 200_000  # pairs of words are covered by the phrases of three
    phrases = ["one two three", "three four five", "two three four"]
    assert rows == [("en", i, p, n, n, n, 5 * n, 1_000_000) for i, p in enumerate(phrases, 1)]
