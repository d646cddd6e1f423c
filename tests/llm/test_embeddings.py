import numpy as np

from visitledger.llm import blocks, embeddings


def brute(rows, threshold=0.98):
    good = [i for i, (_, v, lab) in enumerate(rows)
            if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = [0] * len(rows)
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float64) / np.abs(rows[k][1]).max() for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((rows[i][0], n[i], least.get(find(i)), rows[i][0] is not None and least[find(i)] == rows[i][0])
                   for i in range(len(rows))), key=repr)


def fixture():
    rng = np.random.default_rng(4)
    rows = []
    for family in range(6):
        center = rng.standard_normal(32)
        for _ in range(15):
            rows.append((len(rows), (center + rng.standard_normal(32) * 0.11).tolist(), family % 3))
    rows += [(rows[3][0], rows[3][1], 0), (None, rows[3][1], 0), (500, rows[3][1], None), (501, None, 0), (502, [], 0),
             (503, [0.0] * 32, 0), (504, [float("nan")] * 32, 0), (505, [None] + [1.0] * 31, 0), (506, [1.0, 2.0], 0),
             (507, [2.0, 4.0], 0), (508, [1e300, 2e300], 0), (509, [1.0], 0), (510, (np.array(rows[3][1]) * 3).tolist(), 0)]
    return rows


def test_exact_on_families(spark, monkeypatch):
    rows = fixture()
    want = brute(rows)
    assert sum(r[1] for r in want) > 100
    for kind, clash in (("double", "mark"), ("double", "filters")):
        docs = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, {clash} string")
        found = embeddings.near_duplicates(docs)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert embeddings.near_duplicates(docs.limit(0)).count() == 0


def test_tiles_count_each_pair_once(spark, monkeypatch):
    real = blocks.tiled
    monkeypatch.setattr(embeddings, "tiled", lambda rows, member, size: real(rows, member, size, 4))
    rows = fixture()
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted((tuple(r) for r in embeddings.near_duplicates(docs).collect()), key=repr) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    code = embeddings.Code(64, 80)
    missed = sum(not len(np.intersect1d(a, b)) for a, b in zip(code.filters(x), code.filters(y), strict=True))
    assert missed <= 5


def test_hot_filter_of_distinct_vectors(spark):
    """A third of the rows are different vectors that all link: their filters hold more than a tile's members."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=24)
    rows = [(i, (base + rng.normal(size=24) * 0.04).tolist(), "a") for i in range(2300)]
    rows += [(10_000 + i, rng.normal(size=24).tolist(), "a") for i in range(4600)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(docs).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    links = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    found = sum(got[r[0]][0] for r in rows)
    assert links.sum() > 1_000_000 and 0.99 * links.sum() <= found <= links.sum()
    assert all(got[r[0]][0] <= n for r, n in zip(rows, links.tolist(), strict=True))
    assert {got[i][1] for i in range(2300)} == {0}
