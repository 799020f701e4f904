"""Secret scans against plain regular expressions; trigram queries against what they must not miss."""

import re
import time

import pytest
from pyspark.sql import functions as F

from martkit.llm import secrets

TEXTS = [
    None, "", "no secret here", "password=abc token=secret:longvalue123", 'API_KEY : "abcdef+/=.-_1234"',
    "apikey='x' secret=  12345678", "Passwd:\x20\x20abcdefgh password = abcdefg", "AKIA1234567890ABCD AKIAX AKIAAKIA12345678",
    "f" * 31 + " " + "0123456789abcdef" * 2 + "g" + "a" * 40, "é🎉 token=éabcdefgh token:abcdefghé 日本", "TOKEN\n=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY----- gh" + "p_" + "a1" * 20, "xoxb-" + "12345-abcdef-ABCDEFGHIJ eyJhbGci.eyJzdWIi.c2ln",
    "secret" * 50 + "=abcdefgh", "ſecret=abcdefgh toKen=abcdefgh", "token=" + "q" * 3000,
]


def brute(text, rules=secrets.BASE_RULES + secrets.MORE_RULES):
    spans = []
    for place, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.I | re.A if r.ignore_case else 0):
            if len(m.group(r.group)) >= r.least:
                spans.append((m.start(), place, m.end(), r.kind))
    return [(a, b, k) for a, _, b, k in sorted(spans)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3]), (3, TEXTS[3]), (3, TEXTS[4])]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kinds", F.lit("clash"))


def test_spans(docs):
    found = secrets.scan(docs).collect()
    wanted = sorted(repr((r.doc_id, brute(r.text))) for r in docs.collect())
    # Under re.A case is ignored for ASCII letters alone, as in the scan.
    assert sorted(repr((r.doc_id, [tuple(s) for s in r.spans])) for r in found) == wanted


def test_no_candidate_is_missed():
    """Every match of a rule satisfies the rule's query."""
    for rule in secrets.BASE_RULES + secrets.MORE_RULES:
        query = secrets.trigram_query(rule)
        for text in TEXTS:
            for m in re.finditer(rule.pattern, text or "", re.I | re.A if rule.ignore_case else 0):
                held = m.group().lower()
                assert query is None or any(all(t in held for t in ands) for ands in query)


def test_queries():
    found = {r.kind: secrets.trigram_query(r) for r in secrets.BASE_RULES}
    assert found["hex"] is None and found["access"] == (frozenset({"aki", "kia"}),)
    assert frozenset({"tok", "oke", "ken"}) in found["assign"] and len(found["assign"]) == 6
    assert secrets.trigram_query(secrets.Rule("x", "a(bc|de)?f[0-9]+ghi")) == (frozenset({"ghi"}),)
    assert secrets.trigram_query(secrets.Rule("x", "abc|x.z")) is None


def test_index(docs):
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = secrets.postings(keyed, ["tok", "aki"]).collect()
    assert {(r.trigram, r.doc_id) for r in rows if r.doc_id is not None} == {
        (t, i) for i, x in [*enumerate(TEXTS), (3, TEXTS[3]), (3, TEXTS[4])] for t in ("tok", "aki") if t in (x or "").lower()
    }
    met = {r.doc_id: set(r.kinds) for r in secrets.candidates(keyed, secrets.BASE_RULES[:2]).filter("doc_id IS NOT NULL").collect()}
    assert met[7] == {"access"} and "assign" in met[4] and not {1, 8} & set(met)


def test_odd_documents(odd_docs, no_docs):
    assert secrets.scan(odd_docs).count() == odd_docs.count() and secrets.scan(no_docs).count() == 0
    plan = secrets.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_secrets_in_one_text(spark):
    """Time grows with the text, not with its square; counts around the block size of the running sums."""
    line = "id 0123456789abcdef0123456789abcdef token=abc é secret: longenough{}\n"
    for n in (1, secrets.BLOCK // 2, secrets.BLOCK, secrets.BLOCK + 1, 3 * secrets.BLOCK):
        text = "".join(line.format(i) for i in range(n))
        found = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
        assert [tuple(s) for s in found.spans] == brute(text)
    text = "".join(line.format(i) for i in range(50_000))
    began = time.monotonic()
    found = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert time.monotonic() - began < 60
    assert len(found.spans) == 100_000 and [tuple(s) for s in found.spans] == brute(text)
