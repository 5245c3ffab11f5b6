"""Against the public library that defines the tokens."""

import base64
import hashlib

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from freight.llm.byte_bpe import decode, encode, encode_documents, token_digests, vocabulary  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")
HARD = ["", " ", "  ", "a", " a", "  a", "\n\na b", "it's 're'll 'x ''s 's's don't''ll", " 's \t's", "a'b'll", "x" * 5000, "ab" * 3000,
        "1a2 ３٤", "  \n ", "a \n", "é è́ ñ", "日本語 文字。", "😀😀 ok", "\x1c\x1d a\x85b", "'", "''", "'s", "!'s", "1's"]


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hard_texts(known):
    words = vocabulary(PATH)
    ids, offsets, counts = words.encode(HARD)
    at = 0
    for text, n in zip(HARD, counts.tolist(), strict=True):
        mine = ids[at : at + n].tolist()
        assert mine == known.encode_ordinary(text), text
        assert words.decode(ids[at : at + n], offsets[at : at + n], len(text.encode())) == text.encode()
        at += n


signs = st.sampled_from("aes t'rvlmd1 2\n\t!?. é日😀'")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(signs, max_size=200), st.text(max_size=30)), min_size=1, max_size=5))
def test_any_texts(known, texts):
    texts = [regex.sub(r"\p{Cs}|\p{Cn}", "", text) for text in texts]
    ids, _, counts = vocabulary(PATH).encode(texts)
    wanted = [known.encode_ordinary(text) for text in texts]
    assert counts.tolist() == [len(x) for x in wanted]
    assert ids.tolist() == [i for x in wanted for i in x]


def test_frames(spark, known):
    rows = [(1, "it's here"), (2, None), (3, ""), (3, "it's here"), (None, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("TOKENS", encode(F.col("text"), PATH).getField("ids"))
    found = {(r.doc_id, r.n_tokens): (r.ids_sha256, r.decoded_sha256) for r in token_digests(docs, PATH).collect()}
    for key, text in rows:
        ids = known.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        assert found[key, len(ids)] == digest
    empty = token_digests(docs.limit(0), PATH)
    assert empty.count() == 0
    again = encode_documents(docs, PATH, into="tokens")
    assert again.select(decode(again["tokens"], PATH).cast("string").alias("t")).where("t = \"it's here\"").count() == 2
