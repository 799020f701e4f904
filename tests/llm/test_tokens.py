"""Both encoders against tiktoken on whole and odd texts; id files; documents through Spark."""

import base64
import hashlib
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from martkit.llm import dac, spbpe, tokens
from martkit.llm.tokens import TextEncoder

RANKS, JSON = public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "   ", "a  b", "a   b", "a \nb", "a\n b", "a\n  b \n\n c", "\n\n", "\t x\ty", " x", "x ", "x  ",
    "it's 'tis don't I'LL", "foo...bar ?!. x, y.", "日本語 текст 🎉🎉 naïve", "a" * 500, "1234 5 .5 5.,", "é.é, é.",
    "<|endoftext|> <|endoftext|>x", "\x00\x01 x", "foo.\nBar baz\n", " \n", "x .\n.", "a  b c d\x1ce\x85f",
]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def split(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def test_encoders_agree_with_tiktoken(reference):
    wanted = [reference.encode_ordinary(t) for t in ODD]
    codec = spbpe.codec(RANKS, public.PATTERN)
    assert split(codec, ODD) == wanted
    assert split(dac.encoder(JSON), ODD) == wanted
    decoded = [bytes(x).decode() for x in codec.decode(*codec.encode(pa.array(ODD)))]
    assert decoded == ODD


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab.,'é1 日s "), max_size=40), min_size=1, max_size=5))
def test_any_text(reference, texts):
    wanted = [reference.encode_ordinary(t) for t in texts]
    assert split(spbpe.codec(RANKS, public.PATTERN), texts) == wanted
    assert split(dac.encoder(JSON), texts) == wanted


def test_what_is_held_is_bounded():
    asked = []
    encoder = TextEncoder(lambda units: [asked.append(u) or [1] for u in units], most=10)
    for i in range(30):
        encoder.encode(pa.array([f"w{i} x{i} y{i}"]))
        assert len(encoder.slots) <= 10 + 8


def test_id_files_hold_what_the_plain_call_gives(spark, tmp_path):
    """Also for strings of added tokens, which the library gives their ids."""
    library = tokenizers.Tokenizer.from_file(JSON)
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "é<|endoftext|><|endoftext|> \n x", "<|endoftext", "plain again"]
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert wanted[len(ODD)] == [64, 220, 50256, 275]
    assert split(dac.plain_call(JSON), texts) == wanted and split(dac.plain_call(JSON), texts[len(ODD) :]) == wanted[len(ODD) :]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    manifest = dac.write_token_files(docs, JSON, end_id=2, folder=str(tmp_path))
    found = dac.read_documents(manifest, with_ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.ids) for r in found] == [(i, [*ids, 2]) for i, ids in enumerate(wanted)]


def test_model_bytes_are_a_sentencepiece_model():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=spbpe.serialise_model([b"a", b"b", b"ab", b" "]))
    assert model.get_piece_size() == 5 and model.unk_id() == 4
    assert model.encode(spbpe.letters(b"abb a")) == [2, 1, 3, 0]


@pytest.mark.parametrize("count", [0, 1, 511, 512, 513, 5000])
def test_random_access(count):
    ids = np.random.default_rng(count).choice([3, 200, 256, 50_000, 70_000, 2**31], count).astype(np.uint32)
    file = dac.TokenFile(dac.file_bytes([7, None], [count // 3, count - count // 3], ids))
    assert [file.token(i) for i in range(count)] == ids.tolist()
    assert file.document(0).tolist() == ids[: count // 3].tolist() and file.document(1).tolist() == ids[count // 3 :].tolist()
    assert file.doc_ids == [7, None]
    for start, end in ((0, count), (count // 4, count // 2), (count, count)):
        assert file.tokens(start, end).tolist() == ids[start:end].tolist()


def test_id_files(spark, odd_docs, reference, tmp_path):
    manifest = dac.write_token_files(odd_docs, JSON, end_id=2, folder=str(tmp_path), file_tokens=500)
    found = dac.read_documents(manifest, with_ids=True).orderBy("start").collect()
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    at = 0
    for row, got in zip(rows, found, strict=True):
        ids = [*reference.encode_ordinary(row.text or ""), 2]
        assert (got.doc_id, got.start, got.n_tokens, got.ids) == (row.doc_id, at, len(ids), ids)
        assert got.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_documents(spark, odd_docs, no_docs, reference):
    found = spbpe.encode_documents(odd_docs, RANKS, public.PATTERN).collect()
    wanted = []
    for r in odd_docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        text = (r.text or "").encode()
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        wanted.append((r.doc_id, len(ids), digest, hashlib.sha256(text).hexdigest(), ids, text))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, bytes(r.decoded)) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert spbpe.encode_digests(no_docs, RANKS, public.PATTERN).count() == 0
    assert dac.read_documents(dac.write_token_files(no_docs, JSON, 2)).count() == 0


def test_rows_are_appended_at_once():
    """Many rows give what each row by itself gives, beyond the room there was."""
    rows = [list(range(i % 7)) for i in range(40_000)]
    one, many = tokens.Pieces(np.uint32), tokens.Pieces(np.uint32)
    assert [one.append(r) for r in rows[:5]] == list(many.extend(rows[:5]))
    assert [one.append(r) for r in rows[5:]] == list(many.extend(rows[5:]))
    assert list(many.extend([])) == []
    which = np.array([0, 39_999, 6, 13, 6])
    assert one.used == many.used and one.rows(which).tolist() == many.rows(which).tolist()


def test_a_batch_is_encoded_in_bounded_memory():
    """The indices by which ids and bytes are gathered take many times the text; they are made for little text at a time."""
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 5000, 60_000))) for _ in range(12)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(12)), "text": texts})
    for _ in spbpe.encode_batches(iter([batch.slice(0, 1)]), RANKS, public.PATTERN, ("ids",)):
        pass
    tracemalloc.start()
    counts = [n for out in spbpe.encode_batches(iter([batch]), RANKS, public.PATTERN, ("ids",)) for n in out.column("n_tokens").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(counts) == 12 and peak < 20 * batch.nbytes  # 11 times; 42 times for slices of 4 MB


def test_a_worker_holds_little():
    """Neither while it encodes a large batch nor, of remembered pieces, when its task has ended."""
    held = spbpe.codec(RANKS, public.PATTERN).units
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": ["some words and 12 more, of the usual kind " * 250] * 300})
    tracemalloc.start()
    rows = sum(len(out) for out in spbpe.encode_batches(iter([batch]), RANKS, public.PATTERN, ("ids",)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300 and peak < 15e6
    assert not held.slots and not held.pieces.count
