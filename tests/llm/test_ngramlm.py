"""Scores against plain counters, and the filter against the counts it holds."""

import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.llm import ngramlm
from martkit.sources import layers
from martkit.sources.layers import stored


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def is_held_out(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 10 == 0


def brute(rows):
    counts = Counter(t for r in rows if not is_held_out(r.doc_id) for t in [*words(r.text), ngramlm.END])
    n, v = sum(counts.values()), len(counts)
    found = []
    for r in rows:
        tokens = [*words(r.text), ngramlm.END]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        found.append((r.doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return found


def by_text(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[4]))


def check(df, **options):
    rows = df.select("doc_id", "text").collect()
    scored = ngramlm.score_texts(df, ngramlm.learn_ngrams(df.filter(~ngramlm.held_out()), **options)).collect()
    found = by_text([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored])
    wanted = by_text(brute(rows))
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert np.allclose([r[4] for r in found], [r[4] for r in wanted], rtol=1e-9, atol=1e-9)
    return scored


@pytest.mark.parametrize("vocabulary", [ngramlm.VOCABULARY, 20, 0])
def test_odd_documents(odd_docs, vocabulary):
    """Base scores don't depend on how many counts are sent along."""
    assert all(math.isfinite(r.score) for r in check(odd_docs, vocabulary=vocabulary))


def test_documents(spark, sf_dir):
    scored = check(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary=500)
    held = [r for r in scored if is_held_out(r.doc_id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # what was learned helps with other texts


def test_scores_by_hand(spark):
    """The model's score from exact counts, for counts that their level gives back within a factor of two."""
    texts = ["a b c d"] * 40 + ["a b x"] * 3 + ["q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = ngramlm.learn_ngrams(df)
    scored = {r.doc_id: r for r in ngramlm.score_texts(df, model).collect()}
    uni, bi, tri = Counter(), Counter(), Counter()
    for t in texts:
        s = [ngramlm.END, *t.split(), ngramlm.END]
        uni.update(s[1:])
        bi.update(zip(s, s[1:], strict=False))
        tri.update(zip(s, s[1:], s[2:], strict=False))

    def level(n):
        return 2 * 2 ** (math.floor(math.log2(n / 2)) + 0.5) if n >= 2 else 0.0

    for i in (0, 41, 43):
        s, total = [ngramlm.END, *texts[i].split(), ngramlm.END], 0.0
        for k in range(1, len(s)):
            p = (uni[s[k]] + 0.1) / model.base
            pair = min(level(bi[s[k - 1], s[k]]), uni[s[k]], uni[s[k - 1]])
            one, two, three = model.weights
            said, of = one * p + two * pair / uni[s[k - 1]], one + two
            if k > 1:
                context = min(level(bi[s[k - 2], s[k - 1]]), uni[s[k - 1]], uni[s[k - 2]])
                if context:
                    triple = min(level(tri[tuple(s[k - 2 : k + 1])]) if pair else 0.0, pair, context)
                    said, of = said + three * triple / context, 1.0
            p = said / of
            total += math.log10(p)
        assert scored[i].score == pytest.approx(total, rel=1e-9)


def test_weights(spark):
    """Votes are those of every token on its own, with one occurrence left out."""
    texts = ["a b c d e", "b c a e d"] * 50 + ["x y", "q r s"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, two, three = ngramlm.learn_ngrams(df).weights
    assert abs(one + two + three - 1) < 1e-9 and three > 0.1 and two > 0.1
    rng = random.Random(3)
    shuffled = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(20))) for i in range(300)]
    assert ngramlm.learn_ngrams(spark.createDataFrame(shuffled, "doc_id long, text string")).weights[0] > 0.8  # contexts tell little


def test_keys():
    x = np.arange(0, 1 << 62, (1 << 62) // 1000)
    assert (ngramlm.unmixed(ngramlm.mixed(x)) == x).all()


def test_filter_never_reads_low(spark):
    n = 30_000
    df = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 100 + 3).alias("n"))
    df = df.withColumn("key", F.xxhash64("key"))
    found = ngramlm.build_filter(df, 3)
    rows = df.collect()
    levels = found.levels(np.array([r.key for r in rows]).view(np.uint64))
    exact = np.array([(r.n // 3).bit_length() for r in rows])
    assert (levels >= exact).all() and (levels == exact).mean() > 0.97
    others = found.levels(ngramlm.mixed(np.arange(100_000) + (1 << 50)))
    assert (others > 0).mean() < 0.02


def test_the_filter_is_bounded(spark):
    """A level takes at least a floor's worth of occurrences."""
    for n, floor in [(1, 1), (5, 2), (1000, 7), (1 << 40, 3)]:
        assert (n // floor).bit_length() <= n / floor


def test_empty_table(no_docs):
    assert ngramlm.score_texts(no_docs, ngramlm.learn_ngrams(no_docs)).collect() == []


@pytest.mark.parametrize("vocabulary, floor_share", [(ngramlm.VOCABULARY, 1.0), (3, 1.0), (3, 2.0**-25), (0, 0.02)])
def test_ngrams_outside_the_filters(spark, vocabulary, floor_share):
    """N-grams below the floor, or with words outside the vocabulary, have their counts all the same."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice([f"a{k} b{k} c{k}", f"b{k} d{k}", f"e{rng.randrange(30)}"]) for k in rng.choices(range(12), k=8)) for _ in range(60)]
    texts += ["", None, "a0 b0 c0 unseen"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = df.filter("doc_id < 40 OR doc_id = 60")
    model = ngramlm.learn_ngrams(train, vocabulary, floor_share)
    counts = [Counter(), Counter(), Counter()]
    for i in [*range(40), 60]:
        s = [ngramlm.END, *texts[i].split(), ngramlm.END]
        for k in range(3):
            counts[k].update(tuple(s[j : j + k + 1]) for j in range(k == 0, len(s) - k))
    uni, bi, tri = counts
    total = sum(uni.values())
    floor = model.bigrams.floor

    def read(n):
        return n if 2 <= n < floor else floor * 2 ** (math.floor(math.log2(n / floor)) + 0.5) if n >= floor else 0

    def known(s, k):
        two = [min(read(bi[tuple(s[j - 1 : j + 1])]), uni[s[j],], uni[s[j - 1],]) if j else 0 for j in (k - 1, k)]
        context = two[0] if k > 1 else 0
        three = min(read(tri[tuple(s[k - 2 : k + 1])]), context, two[1]) if k > 1 and two[1] else 0
        return two[1], context, three

    one, two, three = model.weights
    both = [ngramlm.score_texts(df, model), ngramlm.learn_and_score(df, F.expr("doc_id < 40 OR doc_id = 60"), vocabulary, floor_share)]
    for scored in both:
        scored = {r.doc_id: r.score for r in scored.collect()}
        for i, text in enumerate(texts):
            s, wanted = [ngramlm.END, *(text or "").split(), ngramlm.END], 0.0
            for k in range(1, len(s)):
                n2, context, n3 = known(s, k)
                before = uni[s[k - 1],]
                said = one * (uni[s[k],] + 0.1) / model.base + two * n2 / (before or 1) + three * n3 / (context or 1)
                wanted += math.log10(said / (one + two * (before > 0) + three * (context > 0)))
            assert scored[i] == pytest.approx(wanted, rel=1e-9)
    if floor_share == 1.0:  # all counts are exact: votes are those of every token on its own
        votes = [0, 0, 0]
        for i in [*range(40), 60]:
            s = [ngramlm.END, *texts[i].split(), ngramlm.END]
            for k in range(1, len(s)):
                n2, context, n3 = known(s, k)
                said = [(uni[s[k],] - 1) / (total - 1)]
                said += [(n - 1) / max(of - 1, 1) if n > 2 else 0 for n, of in ((n2, uni[s[k - 1],]), (n3, context))]
                votes[2 if said[2] > max(said[:2]) else 1 if said[1] > said[0] else 0] += 1
        assert model.weights == pytest.approx([max(v, 1) / sum(max(v, 1) for v in votes) for v in votes])


def test_asking_ships_no_places(spark, monkeypatch):
    """What is stored of a look-up are counts in the order of the tokens, and its shuffles aren't kept."""
    sent = {}
    monkeypatch.setattr(ngramlm, "stored", lambda df, name, **options: sent.setdefault(name, (df, options)) and stored(df, name, **options))
    texts = [" ".join(f"w{i * 7 + j}" for j in range(9)) for i in range(100)] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    assert ngramlm.learn_ngrams(df, vocabulary=10, floor_share=1.0).rest is not None
    assert sent["found"][0].columns == ["docs", "one", "two", "three"]
    assert all(sent[name][1] == {"keep_shuffles": False} for name in ("tokens", "ngrams", "found"))


def test_shuffle_files_of_a_stored_table_go(spark):
    """None are left of a write without keep_shuffles, and the setting is as it was."""
    before = spark.conf.get(layers.SHUFFLE_CLEANUP, None)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = blocks.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    df = spark.range(10_000).withColumn("x", F.col("id") % 7).repartition(5, "x")
    had = files()
    stored(df, "kept")
    assert files() - had
    had = files()
    gone = stored(df, "gone", keep_shuffles=False)
    for _ in range(50):  # they are removed in the background
        if not (left := files() - had):
            break
        time.sleep(0.1)
    assert not left and gone.count() == 10_000
    assert spark.conf.get(layers.SHUFFLE_CLEANUP, None) == before
