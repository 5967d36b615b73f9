import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tabrail.llm import bpe

ODD = ["", " ", "  ", "a  b", "x\n\ny", "\n a", "a \n", "a\n b", "don't we'll", " lead", "trail ", "\t\tx", "é 𝄞 12345", "\x1c x", "a\x1cb c", "  x",
       "aaaa " * 9, "the" * 3000, "<|endoftext|>", "1 2  3", "é x"]


@pytest.fixture(scope="module")
def lib():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.RANK_FILE), special_tokens={})


def test_same_ids_as_the_library(lib):
    enc, r = bpe.Encoder(), random.Random(3)
    texts = ODD + ["".join(r.choice(" \n\tabcdethe nd.,!12éß　") for _ in range(r.randrange(60))) for _ in range(3000)]
    for t in texts:
        ids = enc.encode(t)
        assert ids == lib.encode_ordinary(t), repr(t)
        assert enc.decode(ids) == t.encode()


def test_long_pretokens_and_both_vocabulary_files(lib):
    enc = bpe.Encoder()
    for t in ("a" * 100_000, "ab" * 40_000, "".join(random.Random(1).choice("abcdefgh") for _ in range(30_000))):
        assert enc.encode(t) == lib.encode_ordinary(t)
    assert bpe.load_ranks(P.path("byte_bpe_50k.json")) == bpe.load_ranks(bpe.RANK_FILE)


def test_rows(spark, lib):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, None, 2), (0, "x", 3), (0, "x", 3)], "doc_id long, text string, n_tokens int")
    for r in bpe.encode_documents(df, with_ids=True).collect():
        if r.doc_id is not None and r.doc_id > 0:
            ids = lib.encode_ordinary(ODD[r.doc_id])
            assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(ODD[r.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0)).count() == 0
