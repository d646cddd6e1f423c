import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from visitledger.llm import packing
from visitledger.llm.packing import Costs, layout, powers
from visitledger.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pair():
    from tokenizers import Tokenizer

    with open(PATH, "rb") as file:
        return packing.Encoder(file.read()), Tokenizer.from_file(PATH)


def peer_ids(peer, text):
    return peer.encode(text or "", add_special_tokens=False).ids


def test_same_ids_as_the_library(pair, monkeypatch):
    coder, peer = pair
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)
    rng = random.Random(6)
    alphabets = ("a", "aB", "xyz09", "éÈñß", "=-'", "* \n\t", "theHI", "İıŉſĸ", "中文 ", "_.", "   ", "🙂a", "'s't ll", "é̈ ",
                 "ΣσςΑ ", "\r\x0b\x0c\x1c\x85 a", "ǅǄ", "가 가", "<|endoftext|> ", "µª²½Å")
    for _ in range(3000):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert coder.encode(text).tolist() == peer_ids(peer, text), repr(text)
    for text in ("a <|endoftext|> b", "x<|startoftext|>y", "Don't we'LL they're 'S", "́̈ ͅx", None, ""):
        assert coder.encode(text).tolist() == peer_ids(peer, text), repr(text)


def test_long_texts_are_encoded_piecewise(pair, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 37)
    text = " \n".join(f"word{i}. Über{i}!\ttab" for i in range(400)) + "x" * 300
    assert pair[0].encode(text).tolist() == peer_ids(pair[1], text)


def test_new_words_are_cut_and_coded_together(pair, monkeypatch):
    """One call of the pattern and one of the model for all new plain words of a group, none for known ones; same ids as
    the library, also for letters whose lower case has to be the library's, when stores grow and when they start afresh."""
    rng = random.Random(9)
    letters = [chr(c) for c in [*range(0x21, 0x7f), *range(0xc0, 0x17f)] if chr(c) not in "×÷"]
    texts = ["".join(letters), " ".join(letters), "", " ", "\n\t ", *["'ll " + " ".join("".join(rng.choices(letters, k=rng.randint(1, 9)))
             for _ in range(300)) + rng.choice(["", " ", "\n", " 中文 ", " <|x|> "]) for _ in range(60)]]
    want = [peer_ids(pair[1], t) for t in texts]
    with open(PATH, "rb") as file:
        coder = packing.Encoder(file.read())
    calls, cut = [], coder.cut
    coder.cut = lambda text: calls.append(text) or cut(text)
    assert [i.tolist() for i in coder.encode_all(texts)] == want and len(calls) == 1
    assert [i.tolist() for i in coder.encode_all(texts)] == want and len(calls) == 1
    monkeypatch.setattr(packing, "CACHE_WORDS", 700)
    monkeypatch.setattr(packing, "SLICE", 5000)
    coder.words, coder.pieces = packing._Ids(), packing._Ids()
    assert [i.tolist() for i in coder.encode_all(texts)] == want and len(calls) > 1


def test_a_full_store_keeps_the_words_at_hand(pair, monkeypatch):
    """Words of every text are encoded once, however often rare ones fill the store; same ids as the library."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    with open(PATH, "rb") as file:
        coder = packing.Encoder(file.read())
    counts, fill, fill_pieces = {"words": [], "pieces": []}, coder._fill, coder._fill_pieces
    monkeypatch.setattr(coder, "_fill", lambda new: counts["words"].append(len(new)) or fill(new))
    monkeypatch.setattr(coder, "_fill_pieces", lambda new: counts["pieces"].append(len(new)) or fill_pieces(new))
    for n in range(30):
        text = " ".join(["The end.", "中文", *(f"common{chr(97 + i)}" for i in range(17)), *(f"rare{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + i)}" for i in range(20))])
        assert coder.encode(text).tolist() == peer_ids(pair[1], text)
    assert counts["words"] == [40] + 29 * [20]
    assert counts["pieces"] == [40] + 29 * [20]


def brute(places, penalty, costs, last):
    """Cost by the same rules over every pair of places."""
    at, best = [0, *places], [0]
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            n = at[j] - at[i]
            if n <= costs.width:
                options.append(best[i] + (0 if n & (n - 1) == 0 else costs.width - n))
            if n > costs.width and i == j - 1 or last and j == len(at) - 1 and n <= costs.width:
                options.append(best[i] + costs.inside * (len(powers(n, costs.width)) - 1))
        best.append(min(options) + penalty[j - 1])
    return best[-1]


def test_layout_is_cheapest():
    rng = random.Random(8)
    for _ in range(600):
        costs = Costs(rng.choice([4, 8, 16]), rng.randint(0, 3), rng.randint(3, 8))
        places = np.cumsum([rng.randint(1, rng.choice([3, 9, 25])) for _ in range(rng.randint(1, 30))])
        penalty = np.array([rng.choice([0, costs.sentence]) for _ in places])
        last = rng.random() < 0.5
        cuts, cost = layout(places, penalty, costs, last)
        assert cost == brute(places.tolist(), penalty.tolist(), costs, last)
        known = dict(zip(places.tolist(), penalty.tolist(), strict=True))
        sizes = np.diff([0, *cuts])
        assert cuts[-1] == places[-1] and (sizes > 0).all() and (sizes <= costs.width).all()
        paid = sum(known.get(c, costs.inside) for c in cuts) + sum(0 if n & (n - 1) == 0 else costs.width - n for n in sizes.tolist())
        assert paid <= cost and (last or paid == cost)  # a cut of the last stretch may happen to end a sentence


def check_pieces(rows, want, width):
    """Pieces (key, start, ids, doc_tokens, sequence, offset, padded_to) hold each document once, gapless. Padding is returned."""
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for key, start, ids, tokens, sequence, offset, padded in rows:
        of_doc[key].append((start, ids, tokens))
        of_sequence[sequence].append((offset, len(ids), padded))
    got = collections.Counter()
    for key, parts in of_doc.items():
        parts.sort(key=lambda p: p[0])
        at, whole = 0, []
        for start, ids, tokens in parts:
            assert start == at and tokens == parts[0][2]
            whole += ids
            at += len(ids)
        assert at == parts[0][2]
        got[key, tuple(whole)] += 1
    assert got == want
    padding = 0
    for parts in of_sequence.values():
        parts.sort()
        at = 0
        for offset, length, _ in parts:
            assert offset == at and length > 0
            at += length
        assert at <= width and {p[2] for p in parts} == {at if at & (at - 1) == 0 else width}
        padding += parts[0][2] - at
    return padding


@pytest.mark.parametrize("horizon", [400, 5000, 10 ** 6])
def test_packer_settles_what_is_far_from_the_end(horizon):
    rng = random.Random(horizon)
    ends = np.zeros(50, bool)
    ends[:3] = True
    docs = [np.array([rng.randrange(50) for _ in range(rng.choice([1, 5, 60, 900]))], "<u4") for _ in range(60)]
    costs = Costs(64, 2, 8)
    packer = packing._Packer(ends, costs, horizon, 128, 1000)
    pieces = [p for k, ids in enumerate(docs) for p in packer.add(k, ids)] + list(packer.settle(last=True))
    assert [p[0] for p in pieces] == sorted(p[0] for p in pieces) and pieces[0][4] == 1000
    want = collections.Counter((k, tuple(ids.tolist())) for k, ids in enumerate(docs))
    padding = check_pieces([(k, s, i.tolist(), n, q, o, w) for k, s, i, n, q, o, w in pieces], want, 64)
    assert padding < 0.25 * sum(map(len, docs))  # a sentence is a quarter of a sequence here


def test_op13(spark, pair):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    ids = {k: np.array([*peer_ids(pair[1], t), 2], "<u4") for k, t in zip(*[c.to_pylist() for c in table.columns], strict=True)}
    rows = QUERIES["op13_packing"](spark, "/root/testdata/sf0.001").collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    pieces = [(r.doc_id, r.start, ids[r.doc_id][r.start:r.start + r.length].tolist(), r.doc_tokens, r.sequence_id, r.offset, r.padded_to)
              for r in rows]
    padding = check_pieces(pieces, collections.Counter((k, tuple(i.tolist())) for k, i in ids.items()), 4096)
    assert padding < 0.01 * sum(map(len, ids.values()))


def test_frames(spark, pair, odd, none):
    vocab = packing.vocabulary(spark, PATH)
    odd = odd.withColumnRenamed("mark", "ids").withColumnRenamed("line", "start")
    assert packing.pack(none, vocab, 2).count() == 0
    found = packing.pack(odd.repartition(3), vocab, 2)
    total = found.agg(F.sum("length")).first()[0]
    want = collections.Counter((r.doc_id, (*peer_ids(pair[1], r.text), 2)) for r in odd.collect())
    assert total == sum(len(i) * n for (_, i), n in want.items())
    whole = collections.Counter()
    parts = sorted(found.collect(), key=lambda r: (r.sequence_id, r.offset))  # rows of one id come one after the other
    held, key = [], None
    for r in parts:
        assert r.start == len(held) and (r.start == 0 or r.doc_id == key)
        key = r.doc_id
        held += np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(r.ids) // 4
        if len(held) == r.doc_tokens:
            whole[key, tuple(held)] += 1
            held = []
    assert whole == want
    with pytest.raises(ValueError):
        packing.pack(odd, vocab, 2, open_tokens=100)
