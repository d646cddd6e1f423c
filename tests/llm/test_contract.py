"""The registered queries on the given tables: against their SQL, or against brute force."""

import collections
import hashlib
import re

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from compare import compare, connect

from .test_bpe import pair  # noqa: F401
from .test_embeddings import brute as brute_vectors
from .test_jaccard import brute as brute_classes
from .test_licenses import brute as brute_notices
from .test_secrets import base
from .test_suffixes import brute as brute_repeats
from visitledger.llm import embeddings, licenses
from visitledger.llm.jaccard import Likeness
from visitledger.llm.queries import QUERIES, SQL

SF, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


def test_all_registered():
    names = [re.match(r"op(\d+)_", n)[1] for n in QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert not [p for p in compare(QUERIES[name](spark, SF), SQL[name], connect(SF)) if not p.startswith("warning")]


def test_op2(spark, texts, pair):  # noqa: F811
    import numpy as np

    for r in QUERIES["op2_byte_bpe"](spark, SF).collect():
        text = texts[r.doc_id] or ""
        ids = np.array(pair[1].encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op3(spark):
    table = pq.read_table(f"{SF1}/documents.parquet")
    texts = dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    found = QUERIES["op3_secret_scan"](spark, SF1).collect()
    assert sum(r.n_assign for r in found) > 5 and sum(r.n_hex for r in found) > 5 and any("guess" in r.spans for r in found)
    for r in found:
        spans = base(texts[r.doc_id] or "")
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        count = collections.Counter(k for k, _, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert [s for s in r.spans.split(",") if s and not s.startswith("guess")] == joined


def test_op4(spark, texts):
    want = dict(zip(texts, brute_repeats(texts.values(), 400), strict=True))
    for r in QUERIES["op4_suffix_dedup"](spark, SF).collect():
        spans, digest = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len((texts[r.doc_id] or "").encode()), sum(b - a for a, b in spans), len(spans), digest)


def test_op6(spark, texts):
    got = collections.Counter(tuple(r) for r in QUERIES["op6_jaccard_join"](spark, SF).collect())
    assert got == brute_classes(list(texts.items()), Likeness(width=3, part=90))[0]


def test_op7_planted(spark):
    """Links between copies and near copies of given vectors; none of the given vectors has one."""
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    rows += [(100_000 + i, v, k) for i, v, k in rows[:40]]
    rows += [(200_000 + i, [x * (1.001 if n % 2 else 0.999) for n, x in enumerate(v)], k) for i, v, k in rows[10:30]]
    planted = spark.createDataFrame([(i, list(v), k) for i, v, k in rows], given.schema)
    got = sorted((tuple(r) for r in embeddings.near_duplicates(planted).collect()), key=repr)
    assert got == brute_vectors([(i, list(v), k) for i, v, k in rows]) and sum(r[1] for r in got) >= 120


def test_op7(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    got = sorted((tuple(r) for r in QUERIES["op7_embedding_near_dedup"](spark, SF).collect()), key=repr)
    assert got == brute_vectors([(i, list(v), k) for i, v, k in rows])


def test_op10(spark):
    table = pq.read_table(f"{SF1}/documents.parquet")
    texts = dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    found = QUERIES["op10_license_scan"](spark, SF1).collect()
    assert sum(r.n_base for r in found) > 10
    for r in found:
        n, places = brute_notices(texts[r.doc_id])
        mine = [(w, licenses.BASE_PHRASES[p]) for p, w in places if p in licenses.BASE_PHRASES]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            n, len(mine), min((w for w, _ in mine), default=None), max((w for w, _ in mine), default=None),
            ",".join(sorted({x for _, x in mine})))
        assert {*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} and 0 <= r.score <= 1
