"""The pipeline against the same decisions made one after the other in plain Python."""

import base64
import hashlib
from collections import Counter

import public_tokenizers as public
import tiktoken
from brute import near_components, norm
from pyspark.sql import functions as F

import corpus_pipeline
from martkit.llm import langid, mixing
from martkit.sources.layers import stored


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding",
    ]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({"size": F.lit("clash"), "_more": F.lit(1)})
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], sf_dir), "test-stage"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].columns == docs.columns
    before = [s.collect() for s in steps]
    # Language: the rows that the model accepts.
    model = langid.learn_languages(docs)
    compressors = model.compressors()
    clear = []
    for r in before[0]:
        margin = model.classify(r.text.lower().encode(), compressors)[1] if any(c.isalpha() for c in r.text) else -1
        if margin >= model.margin:
            clear.append(r.doc_id)
    assert sorted(r.doc_id for r in before[1]) == sorted(clear)
    # Exact copies: of each text the longest original, then the smallest id.
    best = {}
    for r in before[1]:
        key = norm(r.text)
        best[key] = min(best.get(key, r), r, key=lambda x: (-len(x.text), x.doc_id))
    assert sorted(r.doc_id for r in before[2]) == sorted(r.doc_id for r in best.values())
    # Near copies: the smallest id of each component, shingles of five words.
    component, _ = near_components(before[2], 5)
    least = {}
    for r, c in zip(before[2], component, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in before[3]) == sorted(least.values())
    # Mixing: as often as the mix takes a document (its rows are tested against a plain queue elsewhere).
    turns = {r.doc_id: r.turns for r in mixing.mix(steps[3]).collect()}
    assert Counter(r.doc_id for r in before[4]) == Counter({d: n for d, n in turns.items() if n})
    # Token ids.
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before[4]}
    assert Counter(r.doc_id for r in before[5]) == Counter(r.doc_id for r in before[4])
    for r in before[5]:
        assert r.ids == encoding.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and found.count() > 0
