"""The clause grammar: what its machines write, what is learned, accuracy on held-out rows."""

import math
import time

import pytest
from pyspark.sql import functions as F

from martkit.llm import toxicity
from martkit.llm.common import held_out

LEXICON = {"idiot": 5.0, "lowei*": 6.0}


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


def test_clauses():
    score = toxicity.ClauseScorer(LEXICON).clause
    assert score("such an idiot") == 5.0 and score("idiotic things") == 0.0
    assert score("you idiot") == 6.0 == score("an idiot like you")
    assert score("loweiung here") == 6.0
    assert score("not an idiot") == pytest.approx(2.0)
    assert score("he wrote idiot") == pytest.approx(0.6 * (5 + 1))  # "he" is a target
    assert score("wrote idiot") == pytest.approx(3.0)
    assert score("kill time") == 0.0 and score("I will kill you") == 4.0
    assert score("kill that idiot and you") == 5.0 + 5.0


def test_clauses_are_apart():
    scorer = toxicity.ClauseScorer(LEXICON)
    assert scorer.features("not this. an idiot")[1] == 5.0
    assert scorer.features("an idiot, such an IDIOT! idiots")[2] == pytest.approx(1.0986, abs=1e-3)
    assert scorer.features("") == (0.0, 0.0, 0.0)
    assert toxicity.ClauseScorer({}).features("idiot") == (0.0, 0.0, 0.0)


def test_composition_equals_running_in_turn():
    first = toxicity.Transducer({("start", "a"): ("two", "b", 2.0, 1.0), ("two", "a"): ("start", "c", 0.5, 0.0)})
    second = toxicity.Transducer({("start", "b"): ("start", "x", 3.0, 0.0), ("start", "c"): ("end", "y", 1.0, 7.0)})
    both, state, out = toxicity.Composed(first, second), ("start", "start"), []
    for symbol in "aaba":
        state, *written = both.step(state, symbol)
        out.append(tuple(written))
    assert out == [("x", 6.0, 1.0), ("y", 0.5, 7.0), ("b", 1.0, 0.0), ("b", 2.0, 1.0)]


def test_learning_and_accuracy(tables):
    docs, labels = tables
    model = toxicity.learn_toxicity(docs, labels)
    assert {w.rstrip("*")[:4] for w in model.lexicon} >= {"idio", "moro", "scum", "clow"}
    marked = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter(held_out())
    rows = marked.select("score", "predicted", "toxic").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    clean, toxic = [r for r in rows if not r.toxic], [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    # Labels of rows that are held out change nothing.
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn_toxicity(docs.repartition(3), turned).lexicon == model.lexicon


def test_words_in_more_clean_than_toxic_texts(spark):
    """With few toxic rows a word may have strong evidence and still be in more clean texts, as quoted ones."""
    rows = [(i, i < 300, i < 40 or 300 <= i < 345) for i in range(2300)]
    rows = [(i, " ".join([f"text{'abcdefghij'[i % 10]}", *["glorp"] * word, f"n{i}"]), int(toxic)) for i, toxic, word in rows]
    made = spark.createDataFrame([(4 * i, *r) for i, *r in rows], "doc_id bigint, text string, toxic int")
    allowed = made.withColumn("doc_id", F.col("doc_id") + F.when(held_out(), 1).otherwise(0))
    model = toxicity.learn_toxicity(allowed.select("doc_id", "text"), allowed.select("doc_id", "toxic"))
    assert any(w in model.lexicon for w in ("glorp", "glor*", "glorp*")) and len(model.lexicon) <= 2


def test_entries_that_return(spark):
    """Spark's test lets through what the lexicon's own test does, and hardly more."""
    counts = [(f"w{i}", p, n) for i, (p, n) in enumerate((p, n) for p in range(0, 60, 3) for n in range(0, 90, 7) if p + n)]
    table = spark.createDataFrame(counts, "entry string, p long, n long")
    for positive, negative in ((130, 870), (500, 500), (60, 9000)):
        found = {r.entry for r in table.filter(toxicity._may_be_toxic(positive, negative, 5.0)).collect()}
        assert found == {e for e, *c in counts if toxicity._lexicon([(e, *c)], positive, negative, 5.0)} and found


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (2, 0), (2, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn_toxicity(odd_docs, labels)
    scored = toxicity.score_toxicity(odd_docs, model)
    assert scored.count() == odd_docs.count() and scored.filter("NOT score BETWEEN 0 AND 1 OR isnan(score)").count() == 0
    none = toxicity.learn_toxicity(no_docs, labels.limit(0))
    assert none.lexicon == {} and toxicity.score_toxicity(no_docs, none).count() == 0


def test_long_text():
    """Time grows with the text, not with its square, and clauses are those of a plain split."""
    scorer = toxicity.ClauseScorer(LEXICON)
    parts = ["a plain sentence here. ", "you idiot! ", "not an idiot, really; ", "lowei and (more) ", "words [x] | ", '"kill" you\n']
    for n in (7, 400):
        text = "".join(parts[(i * i + i // 3) % len(parts)] for i in range(n))
        clauses = [s for c in toxicity.CLAUSE.findall(text) if (s := scorer.clause(c)) > 0]
        assert scorer.features(text) == pytest.approx((sum(clauses) ** 0.5, max(clauses), math.log1p(len(clauses))))
    for piece in ("you idiot went home\n", "such an idiot. "):
        text = piece * (5_000_000 // len(piece))
        began = time.monotonic()
        assert scorer.features(text)[2] == pytest.approx(math.log1p(text.count("idiot")))
        assert time.monotonic() - began < 30
