import collections
import random
import re

import numpy as np
import pytest

from visitledger.llm import blocks, jaccard
from visitledger.llm.components import components
from visitledger.llm.jaccard import Likeness

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, width):
    out = []
    for key, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        if len(words) < width:
            out.append((key, frozenset([tuple(words)]) if words else frozenset()))
        else:
            out.append((key, frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))))
    return out


def brute(rows, like):
    """(id, size, least id reachable) of every row."""
    sets = sets_of(rows, like.width)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posting = collections.defaultdict(list)
    for i, (_, grams) in enumerate(sets):
        overlap = collections.Counter(j for g in grams for j in posting[g])
        for j, n in overlap.items():
            if like.whole * n >= like.part * (len(grams) + len(sets[j][1]) - n):
                root[find(i)] = find(j)
        for g in grams:
            posting[g].append(i)
    least = {}
    for i, (key, grams) in enumerate(sets):
        if grams and key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return collections.Counter((key, len(grams), least.get(find(i)) if grams else key)
                               for i, (key, grams) in enumerate(sets)), [find(i) for i in range(len(sets))]


def families(seed=7):
    """Chains of edits around the threshold in texts of many sizes."""
    rng = random.Random(seed)
    rows = []
    for size in (3, 5, 8, 11, 20, 45, 90, 300):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        for _ in range(12):
            words = list(words)
            for _ in range(max(1, size // 60)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            if rng.random() < 0.3:
                words.append("tail")
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("like", [Likeness(), Likeness(width=3, part=90)])
def test_join(spark, odd, documents, like, monkeypatch):
    for docs in (spark.createDataFrame(families(), "doc_id long, text string"), odd, documents):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        found = jaccard.join(docs, likeness=like).collect()
        assert collections.Counter((r.doc_id, r.n_shingles, r.class_id) for r in found) == brute(rows, like)[0]


def test_representatives(odd, none):
    kept = jaccard.representatives(odd)
    assert kept.columns == odd.columns
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    roots = brute(rows, Likeness())[1]
    filled = [i for i, r in enumerate(rows) if (r[1] or "").strip(" \t\n")]
    got = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert sum(bool((t or "").strip(" \t\n")) for _, t in got) == len({roots[i] for i in filled})
    assert sum(not (t or "").strip(" \t\n") for _, t in got) == len(rows) - len(filled)
    assert jaccard.representatives(none).count() == 0


def test_tiles_meet_pairwise(spark):
    rows = spark.range(50).selectExpr("id AS v", "50L AS members")
    found = blocks.tiled(rows, "v", "members", 8).collect()
    met = collections.defaultdict(set)
    for r in found:
        met[(r.tile_a, r.tile_b)].add(r.v)
    pairs = {(a, b) for group in met.values() for a in group for b in group}
    assert len(pairs) == 2500 and max(map(len, met.values())) < 40
    assert blocks.tiled(rows, "v", "members", 50).filter("tile_a = 0 AND tile_b = 0").count() == 50


def test_forest_spans():
    near = lambda x, others: np.abs(others - x) == 2
    a, b = blocks.forest(10, near)
    assert len(a) == 8 and all(abs(x - y) == 2 for x, y in zip(a, b, strict=True))


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 5), (300, 100)]
    found = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 300: 100, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
