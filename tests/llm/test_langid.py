"""Language by compression: accuracy on rows that were held out, and what is never learned from."""

import zlib

import pytest
from pyspark.sql import functions as F

from martkit.llm import langid
from martkit.llm.common import held_out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.learn_languages(docs)


def test_held_out_rows(odd_docs):
    for r in odd_docs.select("doc_id", held_out().alias("out")).collect():
        assert r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_accuracy(docs, model):
    found = langid.identify(docs, model, "p_").filter(held_out())
    right = found.agg(F.avg((F.col("p_lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.filter("NOT p_score BETWEEN 0 AND 1").count() == 0
    assert langid.accepted_documents(docs, model).count() > 0.98 * docs.count()


def test_only_allowed_rows_teach(docs, model):
    """Other labels on held-out rows, other ids of learned ones in the same part: the same model."""
    changed = docs.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang")))
    assert langid.learn_languages(changed.repartition(5)) == model
    assert set(model.dictionaries) == {"en", "de", "fr", "es"}
    assert all(len(d) <= langid.DICTIONARY_BYTES for d in model.dictionaries.values())


def test_copies_of_one_text(spark):
    """A small language with one text copied very often still fills its dictionary, and comes first by its rows."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.col("lang"), F.sha1(F.concat_ws("-", "n", i)))))
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("small").alias("lang"), F.greatest(F.col("id") - 59_000, F.lit(0)).alias("n"))
    rows = rows.unionByName(spark.range(1000).select((F.col("id") + 60_000).alias("doc_id"), F.lit("large").alias("lang"), F.col("id").alias("n")))
    model = langid.learn_languages(rows.select("doc_id", "lang", words.alias("text")))
    assert [(lang, len(d)) for lang, d in model.dictionaries.items()] == [(x, langid.DICTIONARY_BYTES) for x in ("small", "large")]


def test_odd_documents(odd_docs, no_docs, model):
    found = langid.identify(odd_docs, model, "p_").collect()
    assert len(found) == odd_docs.count()
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.p_lang_pred, r.p_score, r.p_accepted) == ("und", 0.0, False)
        else:
            assert r.p_lang_pred in model.dictionaries and 0 <= r.p_score <= 1
    assert langid.accepted_documents(odd_docs, model).columns == odd_docs.columns
    assert langid.identify(no_docs, model, "p_").count() == 0


def test_nothing_learned(no_docs, odd_docs):
    model = langid.learn_languages(no_docs)
    assert model.dictionaries == {}
    assert {r.p_lang_pred for r in langid.identify(odd_docs, model, "p_").collect()} == {"und"}


def test_narrow_margins_are_rejected(spark, model):
    strict = langid.LanguageModel(model.dictionaries, margin=0.9)
    text = spark.createDataFrame([("the and of that this with from",)], "text string")
    assert not langid.identify(text, strict).first().accepted
