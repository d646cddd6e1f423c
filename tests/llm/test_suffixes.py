import collections
import hashlib

import numpy as np
import pytest

from visitledger.llm import suffixes


def brute(texts, length):
    """(spans, kept digest) of every text by counting all strings of the length."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        starts = [i for i in range(len(d) - length + 1) if count[d[i:i + length]] > 1]
        spans = []
        for s in starts:
            if spans and s <= spans[-1][1]:
                spans[-1][1] = s + length
            else:
                spans.append([s, s + length])
        kept, upto = b"", 0
        for a, b in spans:
            kept, upto = kept + d[upto:a], b
        out.append(([tuple(s) for s in spans], hashlib.sha256(kept + d[upto:]).hexdigest()))
    return out


def test_cover_has_every_distance():
    differences = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert differences == set(range(suffixes.PERIOD))


def test_fingerprints_name_strings():
    data = np.frombuffer(b"abcabcabd" * 50_000, np.uint8)
    at = np.arange(0, len(data) - 7)
    marks = suffixes.fingerprints(data, at, 7)
    raw = data.tobytes()
    by_string = {}
    for p in range(0, len(at), 13):
        assert by_string.setdefault(raw[p:p + 7], marks[p]) == marks[p]
    assert len(set(by_string.values())) == len(by_string)


def test_slices_are_pieces():
    texts = [(1, b"a" * 10_000, None), (2, b"b" * 500, None), (3, b"", None)]
    found = list(suffixes.slices(iter(texts), 200, 3_000))
    assert len(found) == 4 and max(len(f[0]) for f in found) < 2 * 3_000
    own = [(int(u), int(o)) for _, uids, _, offsets, _, _ in found for u, o in zip(uids, offsets, strict=True)]
    assert own == [(1, 0), (1, 3_000), (1, 6_000), (1, 9_000), (2, 0), (3, 0)]


@pytest.mark.parametrize(("piece", "share"), [(2_000_000, 0.05), (1_000, 0.2)])
def test_repeats(spark, odd, documents, piece, share):
    for docs in (odd.filter("length(text) < 100000 OR text IS NULL"), documents.limit(60)):
        rows = docs.select("doc_id", "text").collect()
        want = collections.Counter()
        for r, (spans, digest) in zip(rows, brute([r.text for r in rows], 200), strict=True):
            want[(r.doc_id, len((r.text or "").encode()), tuple(spans), digest)] += 1
        fixed = spark.createDataFrame(rows, "doc_id long, text string")
        got = collections.Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), r.kept_sha256)
                                  for r in suffixes.repeats(fixed, length=200, piece=piece, round_share=share).collect())
        assert got == want


def test_rest(spark, odd, none):
    assert suffixes.repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeats(odd, length=100)
    cut = spark.createDataFrame([("héllo", [(1, 3)]), (None, None)], "text string, spans array<struct<start:long,end:long>>")
    assert [bytes(r.kept) for r in suffixes.without(cut, "spans").collect()] == [b"hllo", b""]


def test_equal_strings_of_a_slice_are_one_entry():
    text = b"=" * 50_000
    at = np.arange(len(text) - 399)
    marks = suffixes.fingerprints(np.frombuffer(text, np.uint8), at, 400)
    for check in (None, suffixes.checks(np.frombuffer(text, np.uint8), at, 400)):
        rows = [r for b in suffixes._dealt(marks, check, np.zeros(len(at), np.int64), at, 6) for r in b.to_pylist()]
        sent = [r for r in rows if r["bucket"] >= 0]
        assert len(sent) == 1 and np.frombuffer(sent[0]["uids"], np.int64).tolist() == [-1]
        settled = np.concatenate([np.frombuffer(r["at"], np.uint32) for r in rows if r["bucket"] < 0])
        assert sorted(settled.tolist()) == at.tolist()


@pytest.mark.parametrize("piece", [3_000, 2_000_000])
def test_long_runs_and_frequent_passages(spark, piece):
    passage = "".join(chr(97 + i * i % 23) for i in range(260))
    texts = ["=" * 9_000, "ab" * 3_000, "head " + "=" * 500, *[f"{i} {passage} {i * 7919}" for i in range(40)], "x" * 199 + "y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: ([(s.start, s.end) for s in r.spans], r.kept_sha256) for r in suffixes.repeats(docs, length=200, piece=piece).collect()}
    assert got == dict(enumerate(brute(texts, 200)))


def test_a_text_of_several_pieces(spark):
    """A text of five megabytes, more than two pieces as shipped: what it shares with another stands over a border."""
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, 5_000_000, dtype=np.uint8)).decode()
    shared = long[1_999_700:2_000_500]
    docs = spark.createDataFrame([(1, long), (2, "x" * 300 + shared), (3, long[4_999_000:])], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffixes.repeats(docs).collect()}
    assert got == {1: [(1_999_700, 2_000_500), (4_999_000, 5_000_000)], 2: [(300, 1100)], 3: [(0, 1000)]}
