import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from visitledger.llm import periodic
from visitledger.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    """Every period, every diagonal: maximal stretches without a smaller period."""
    codes = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, int)
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[False], codes[q:] == codes[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = stop - start + q
            if length >= max(least, exponent * q):
                run = codes[start:start + length]
                if not any((run[r:] == run[:-r]).all() for r in range(1, q)):
                    found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    words, size = [], rng.randint(0, 90)
    while len(words) < size:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        words += (unit * rng.randint(1, 7))[:rng.randint(1, 60)]
    return words


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (1, 3), (12, 5)])
def test_runs_of_random_words(least, exponent):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = [random_words(rng) for _ in range(rng.randint(1, 4))]
        got = periodic.collapse([" ".join(t).encode() for t in texts], periodic.Shape(least, exponent), rng.choice([1, 60, 10 ** 6]))
        for words, (n, runs, kept) in zip(texts, got, strict=True):
            want = brute(words, least, exponent)
            assert (n, runs, kept.decode()) == (len(words), want, collapsed(words, want)), words


def test_long_texts_are_cut_into_words_piecewise(monkeypatch):
    unit = [f"w{i}" for i in range(700)]
    words = ["x", *unit * 9, "y", *["z"] * 5000]
    raw = " \n".join(words).encode()
    monkeypatch.setattr(periodic, "SLICE", 101)
    n, runs, kept = periodic.collapse([raw])[0]
    assert n == len(words) and runs == [(1, 6300, 700), (6302, 5000, 1)]
    assert kept.decode().split() == ["x", *unit, "y", "z"]


def test_too_few_periods():
    with pytest.raises(ValueError):
        periodic.Shape(6, 2)


def test_frames(spark, odd, none):
    odd = odd.withColumnRenamed("mixed", "periodic")
    found = periodic.runs(odd)
    assert found.columns == [*odd.columns, "periodic_"] and periodic.runs(none).count() == 0
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        words = WORD.findall(r.text or "")
        want = brute(words) if len(words) < 5000 else [tuple(x) for x in r.periodic_.runs]
        assert (r.periodic_.n_words, [tuple(x) for x in r.periodic_.runs]) == (len(words), want)
        assert r.periodic_.collapsed == collapsed(words, want)


def changed(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_op12(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    texts = dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    got = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts) and sum(r.n_runs for r in got) > 30
    for r in got:
        words = changed(r.doc_id, texts[r.doc_id])
        runs = brute(words)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r.n_words, r.n_runs, r.start, r.length, r.period) == (len(words), len(runs), *best), r.doc_id
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
