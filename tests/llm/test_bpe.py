import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from sparkfed.llm import bpe

from .helpers import empty, frame, odd_documents

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codecs():
    ranks = bpe.read_ranks(PATH)
    return bpe.Codec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_encode(codecs):
    own, theirs = codecs
    rng = random.Random(3)
    parts = ["a", "aa", "b", "ab", "the", "é", "ß", " ", "  ", "\n", "\t", "日本", "😀", "1", "!!", "'s", "\x1c", "\xa0", "=", "=" * 10, "a" * 19, " \n ", " x"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 10, 40, 200])))
        assert ids(own.encode(text)) == theirs.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5003, "ab" * 3001, "=-" * 2000 + "a" * 999, "".join(random.Random(8).choice("abcdefghij") for _ in range(9000))])
def test_long_matches(codecs, text):
    assert ids(codecs[0].encode(text)) == codecs[1].encode_ordinary(text)


def test_join_is_the_encoding_of_both(codecs):
    own, rng = codecs[0], random.Random(9)
    for _ in range(400):
        a, b = (bytes(rng.choice(b"abcde \n\xc3\xa9") for _ in range(rng.randint(1, 60))) for _ in range(2))
        assert own.join(own.merge(a), own.merge(b)) == own.merge(a + b)


def test_units():
    for text in ("a b", " a  b", "a\n b \n", "  ", "", "x \n y", "\t z"):
        assert "".join(bpe.units(text)) == text


def test_table(spark, codecs):
    rows = odd_documents()
    df = frame(spark, rows).withColumnRenamed("kept", "ids")
    got = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        assert ids(bytes(r["ids"])) == codecs[1].encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(empty(spark), PATH, P.PATTERN).count() == 0
