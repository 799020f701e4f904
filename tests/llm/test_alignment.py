"""Token groups against set intersections over whole texts, pair counts against plain counters."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from martkit.llm import alignment

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts):
    """Both libraries on each whole text; cuts are the intersection of all ends."""
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    words = {i: e for e, i in a.get_vocab().items()}
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [i for i in range(256) if i not in letters]
    table = {chr(i): i for i in letters} | {chr(256 + k): i for k, i in enumerate(others)}
    found = []
    for text in texts:
        whole = " " + (text or "")
        a_ids = a.encode(whole, add_special_tokens=False).ids
        b_ids = b.encode(text or "")
        a_parts = [bytes(table.get(c, 0) for c in words[i]) for i in a_ids]
        b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if not text or b"".join(a_parts) != whole.encode() or b"".join(b_parts) != whole.encode():
            found.append((0, 0, "", Counter()))
            continue

        def spans(parts, ids):
            at = 0
            for p, i in zip(parts, ids, strict=True):
                yield at, at + len(p), i
                at += len(p)

        sa, sb = list(spans(a_parts, a_ids)), list(spans(b_parts, b_ids))
        cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups, start = [], 0
        for cut in cuts:
            inside = [[str(i) for s, e, i in side if start <= s and e <= cut] for side in (sa, sb)]
            groups.append(",".join(inside[0]) + "|" + ",".join(inside[1]))
            start = cut
        links = Counter((i, j) for s, e, i in sa for t, f, j in sb if s < f and t < e)
        found.append((len(sa), len(sb), ";".join(groups), links))
    counts = Counter(p for *_, links in found for p in links)
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(n, top.get(i, 0))
    return [
        (
            n_a, n_b, groups.count(";") + 1 if groups else 0, sum(links.values()), sum(k for p, k in links.items() if counts[p] == top[p[0]]),
            sum(k * counts[p] for p, k in links.items()), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, groups, links in found
    ]


def difference(df, rows, **options):
    found = sorted(map(repr, (tuple(r) for r in alignment.alignments(df, A, B, **options).select(COLUMNS).collect())))
    wanted = sorted(repr((r.doc_id, *w)) for r, w in zip(rows, brute([r.text for r in rows]), strict=True))
    return [pair for pair in zip(found, wanted, strict=True) if pair[0] != pair[1]]


@pytest.mark.parametrize("sent_pairs", [alignment.SENT_PAIRS, 50, 0])
def test_odd_documents(spark, odd_docs, sent_pairs):
    """Null, empty and long texts, repeated rows; with all pairs sent, some and none."""
    assert difference(odd_docs, odd_docs.select("doc_id", "text").collect(), sent_pairs=sent_pairs) == []


def test_odd_texts(spark):
    """Special tokens' strings, white space of all kinds, the letter that stands for a space, no spaces, random letters."""
    rng = random.Random(5)
    letters = "ab zé日 \t\n▁🎉<0x0A>.' "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["<|endoftext|> a <s> b </s> <unk><0x0A>", " lead", "trail ", "  ", " ", "a\t b", "a b c　d", "x" * 3000, "日本語" * 400, "it's don't 's", "A▁b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert difference(df, df.collect()) == []


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.length("text") < 1200)
    assert difference(df, df.select("doc_id", "text").collect(), sent_pairs=1000) == []


def test_empty_table(spark, no_docs):
    assert alignment.alignments(no_docs, A, B).collect() == []


def test_groups_are_kept(spark, odd_docs):
    rows = alignment.align_documents(odd_docs, A, B, with_groups=True).filter("n_a > 0").collect()
    assert rows and all(r.groups_sha256 == hashlib.sha256(r.groups.encode()).hexdigest() and r.groups.count(";") + 1 == r.n_groups for r in rows)


def cuts(a, b):
    return alignment.shared_ends(np.array(a), np.array(b), np.array([0])).tolist()


def test_shared_ends():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (sorted(rng.sample(range(1, 40), rng.randrange(1, 20))) + [40] for _ in range(2))
        assert cuts(a, b) == [a.index(x) for x in sorted(set(a) & set(b))]
    # Three texts one after the other.
    a, b = np.array([2, 5, 7, 9, 10]), np.array([3, 5, 6, 8, 9, 10])
    assert alignment.shared_ends(a, b, np.array([0, 2, 4])).tolist() == [1, 3, 4]
    assert alignment.shared_ends(a[:0], b[:0], np.empty(0, np.int64)).tolist() == []


def test_a_text_without_a_cut_is_linear():
    """Two long sequences whose ends meet only at the last byte, and at the last but two."""
    a, b = list(range(2, 200_001, 2)), [*range(1, 200_000, 2), 200_000]
    assert cuts(a, b) == [len(a) - 1]
    assert cuts(a, sorted([*b, 199_998])) == [len(a) - 2, len(a) - 1]
