import re

import pytest
from pyspark.sql import functions as F

from visitledger.llm import mixing
from visitledger.llm.queries import MIX


def test_marginals_are_met(documents):
    mix = mixing.Mix()
    cells = documents.groupBy("source", "lang", mixing.topic_of(F.col("text")).alias("topic")).agg(
        F.sum(mixing.tokens(F.col("text"))).alias("n")).cache()
    targets = mixing.marginals(cells, mix)
    fitted = mixing.rake(cells, targets, mixing.Mix(passes=25)).cache()
    for dim, target in zip(mixing.DIMENSIONS, targets, strict=True):
        want = {r.member: r.target for r in target.collect()}
        got = {r[dim]: r.w for r in fitted.groupBy(dim).agg(F.sum("weight").alias("w")).collect()}
        assert sum(want.values()) == pytest.approx(1)
        worst = max(abs(got[k] - v) for k, v in want.items())
        assert worst < (1e-6 if dim == "topic" else 0.02)


def brute_rake(cells, targets, passes):
    total = sum(cells.values())
    weight = {c: n / total for c, n in cells.items()}
    for _ in range(passes):
        for d, target in enumerate(targets):
            now = {}
            for c, w in weight.items():
                now[c[d]] = now.get(c[d], 0) + w
            weight = {c: w * target.get(c[d], 0) / now[c[d]] if now[c[d]] > 0 else 0.0 for c, w in weight.items()}
    return weight


def test_same_as_brute_force(spark):
    cells = {("a", "en", "t"): 100, ("a", "de", "t"): 10, ("b", "en", "u"): 30, ("b", "de", "t"): 5, (None, "en", "u"): 7}
    targets = [{"a": 0.3, "b": 0.5, None: 0.2}, {"en": 0.6, "de": 0.4}, {"t": 0.5, "u": 0.5}]
    frames = [spark.createDataFrame(list(t.items()), "member string, target double") for t in targets]
    rows = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, n long")
    mix = mixing.Mix(passes=7)
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(rows, frames, mix).collect()}
    want = brute_rake(cells, targets, 7)
    assert got == pytest.approx(want)


def expected_shares(rows, weight):
    sums = [{}, {}, {}]
    total = sum(r.n_tokens * weight(r) for r in rows)
    for r in rows:
        for share, member in zip(sums, (r.source, r.lang, r.topic), strict=True):
            share[member] = share.get(member, 0) + r.n_tokens * weight(r) / total
    return sums


@pytest.mark.parametrize("path", ["/root/testdata/sf0.01", "hot"])
def test_drawn_shares_are_the_targets(spark, path):
    """What the draw is expected to hold, by its probabilities, against the targets, member by member."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    if path == "hot":  # a third of all rows on one source
        docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    mix = mixing.Mix()
    mixed = mixing.drawn(docs, mix).cache()
    rows = mixed.select("source", "lang", "mixed.*").collect()
    cells = docs.groupBy("source", "lang", mixing.topic_of(F.col("text")).alias("topic")).agg(
        F.sum(mixing.tokens(F.col("text"))).alias("n"))
    targets = mixing.marginals(cells, mix)
    want = [{r.member: r.target for r in t.collect()} for t in targets]
    got, before = expected_shares(rows, lambda r: r.probability), expected_shares(rows, lambda r: 1)
    moved = 0
    for target, share, plain in zip(want, got, before, strict=True):
        assert share == pytest.approx(target, abs=2e-4)
        moved = max(moved, max(abs(target[k] - plain[k]) for k in target))
    assert moved > 0.02  # the targets are not what was there before
    assert max(r.probability for r in rows) == pytest.approx(1) and min(r.probability for r in rows) > 0
    assert sum(r.n_tokens * r.probability for r in rows) > 0.4 * sum(r.n_tokens for r in rows)
    listed = {(r.dimension, r.member): r for r in mixing.residuals(mixed, targets).collect()}
    for dim, target, share in zip(mixing.DIMENSIONS, want, got, strict=True):
        for member, value in target.items():
            row = listed[dim, member]
            assert row.target == pytest.approx(value) and row.expected == pytest.approx(share[member])
            assert abs(row.drawn - row.expected) < 0.05


def test_budget_and_draw(documents):
    rows = mixing.drawn(documents, mixing.Mix(budget=0.2)).select("doc_id", "text", "mixed.*").collect()
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(total * 0.2, rel=1e-6)
    assert all(0 <= r.probability <= 1 for r in rows)
    for r in rows[:50]:
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    again = mixing.drawn(documents, mixing.Mix(budget=0.2)).select("doc_id", "mixed.sampled").collect()
    assert {r.doc_id: r.sampled for r in rows} == {r.doc_id: r.sampled for r in again}
    share = sum(r.sampled for r in rows) / sum(r.probability for r in rows)
    assert 0.5 < share < 1.5


def test_odd_rows(odd, none):
    rows = mixing.drawn(odd)
    assert rows.columns == [*odd.columns, "mixed_"]
    found = rows.select("doc_id", "text", "source", "mixed_.*").collect()
    assert len(found) == odd.count() and all(r.sampled is not None and r.probability is not None for r in found)
    assert all(r.n_tokens == 0 for r in found if not (r.text or "").strip(" \t\n"))
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns
    assert mixing.sample(none).count() == 0


@pytest.mark.parametrize("path", ["/root/testdata/sf0.01", "hot"])
def test_the_whole_budget_is_drawn_at_the_targets(spark, path):
    """The query's mix: flat targets that cannot be met by drawing documents once are met with the whole budget."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    if path == "hot":
        docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    assert MIX.flatten == (0.7, 0.7, 0.7) and MIX.budget == 0.9
    mixed = mixing.drawn(docs, MIX).cache()
    rows = mixed.select("doc_id", "source", "lang", "mixed.*").collect()
    cells = docs.groupBy("source", "lang", mixing.topic_of(F.col("text")).alias("topic")).agg(
        F.sum(mixing.tokens(F.col("text"))).alias("n"))
    targets = mixing.marginals(cells, MIX)
    want = [{r.member: r.target for r in t.collect()} for t in targets]
    for target, share in zip(want, expected_shares(rows, lambda r: r.expected), strict=True):
        assert share == pytest.approx(target, abs=1e-3)
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.expected for r in rows) == pytest.approx(0.9 * total, rel=1e-6)
    assert sum(r.n_tokens * r.copies for r in rows) == pytest.approx(0.9 * total, rel=0.1)
    assert max(r.copies for r in rows) > 1
    assert all(r.copies in (int(r.expected), int(r.expected) + 1) and r.sampled == (r.copies > 0) for r in rows)
    for row in mixing.residuals(mixed, targets).collect():
        assert row.expected == pytest.approx(row.target, abs=1e-3) and abs(row.drawn - row.expected) < 0.05
    kept = {r.doc_id: r["count"] for r in mixing.sample(docs, MIX).groupBy("doc_id").count().collect()}
    assert kept == {r.doc_id: r.copies for r in rows if r.copies}
