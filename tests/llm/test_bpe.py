import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from visitledger.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    with open(PATH, "rb") as file:
        data = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    peer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Coder(data, public_tokenizers.PATTERN), peer


def test_same_ids_as_the_peer(pair):
    coder, peer = pair
    rng = random.Random(3)
    alphabets = ("a", "ab", "aA", "xyz0", "éè", "=-", "* \n", "thehi", "ßa", "中文", "_.", "\u00a0 ", "🙂a", "'s't ll")
    for _ in range(3000):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        ids = np.frombuffer(coder.encode(text), "<u4").tolist()
        assert ids == peer.encode_ordinary(text)
        assert coder.decode(coder.encode(text)).decode() == text


def test_alphabet_is_one_to_one():
    assert len(set(bpe.byte_alphabet().values())) == 256 and bpe.byte_alphabet()[ord("A")] == "A"


def test_spans_cover_the_text(pair):
    coder, peer = pair
    for text in ("", "plain words", "é中文🙂 x", "🙂" * 9):
        ids = coder.encode(text)
        starts, ends = coder.spans(text, ids)
        assert len(starts) == len(ids) // 4
        if text:
            assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all()
        for i, (first, last) in enumerate(zip(starts, ends, strict=True)):
            token = coder.decode(ids[4 * i:4 * i + 4])
            assert token in text[first:last].encode()


def test_frames(spark, odd, none, documents, pair):
    coder, peer = pair
    vocab = bpe.vocabulary(spark, PATH)
    coded = bpe.encode(odd, vocab, public_tokenizers.PATTERN, offsets=True)
    assert coded.columns == [*odd.columns, "tokens"]
    rows = coded.select("text", "tokens.*", bpe.decoded(F.col("tokens.ids"), vocab, public_tokenizers.PATTERN).alias("back"),
                        bpe.decode_text(F.substring("tokens.ids", 1, 4), vocab, public_tokenizers.PATTERN).alias("head"))
    for r in rows.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == peer.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode() and r.n_tokens == len(r.starts) == len(r.ends)
        assert (r.text or "").startswith(r.head.rstrip("\ufffd"))
    assert bpe.encode(none, vocab, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(odd, vocab, public_tokenizers.PATTERN, out="Mark")


def test_bounded_cache(pair, monkeypatch):
    coder, peer = pair
    monkeypatch.setattr(bpe, "CACHE_CHARS", 20)
    for text in ("some words here", "other words there", "some words here"):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == peer.encode_ordinary(text)
