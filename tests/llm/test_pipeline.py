"""The pipeline against the same stages written plainly."""

import collections
import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from visitledger.llm import lines, mixing, quality
from visitledger.llm.frames import written
from visitledger.llm.jaccard import Likeness

from .conftest import SF
from .test_bpe import pair  # noqa: F401
from .test_jaccard import brute as brute_classes
from .test_lines import brute as brute_lines
from .test_quality import brute as brute_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def rejected(text):
    n, chars, symbols, n_lines, dup, repeat = brute_quality(text)
    return (n < 50 or 100 * repeat > 50 * n or 100 * symbols > 20 * chars or (dup >= 3 and 100 * dup > 60 * n_lines)
            or chars < 2 * n or chars > 15 * n)


def topic(text):
    if " | " in text:
        return "table"
    if re.search(r"@|https?://|\+\d", text):
        return "contact"
    return "paragraphs" if "\n" in text else "prose"


def drawn(rows, mix):
    """Rows (id, text, source, lang) that the mixing keeps."""
    cells = collections.Counter()
    for _, text, source, lang in rows:
        cells[(source, lang, topic(text or ""))] += len(WORD.findall(text or ""))
    total = sum(cells.values())
    weight = {c: n / total for c, n in cells.items()}
    targets = []
    for d, power in enumerate(mix.flatten):
        sums = collections.Counter()
        for c, n in cells.items():
            sums[c[d]] += n
        flat = {k: n ** power for k, n in sums.items() if n}
        targets.append({k: v / sum(flat.values()) for k, v in flat.items()})
    for _ in range(mix.passes):
        for d, target in enumerate(targets):
            now = collections.Counter()
            for c, w in weight.items():
                now[c[d]] += w
            weight = {c: w * target.get(c[d], 0) / now[c[d]] if now[c[d]] else 0 for c, w in weight.items()}
    rate = {c: weight[c] / n if n else 0 for c, n in cells.items()}
    scale = min(mix.budget * total, 1 / max(rate.values()))
    kept = []
    for row in rows:
        key, text, source, lang = row
        joined = "\x1f".join([mix.seed, str(key), text if text is not None else "\x00"])
        u = int(hashlib.md5(joined.encode()).hexdigest()[:8], 16) / 2 ** 32
        if u < min(1.0, rate[(source, lang, topic(text or ""))] * scale):
            kept.append(row)
    return kept


def test_stages_and_run(spark, documents, pair):  # noqa: F811
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "source_mixing", "byte_bpe"]
    rows = [r for r in documents.select("doc_id", "text", "source", "lang").collect() if not rejected(r.text)]
    other = {r.doc_id: (r.source, r.lang) for r in rows}
    cut = brute_lines([(r.doc_id, r.text, r.source) for r in rows], lines.Rule())
    cleaned = [(key, text) for key, text, gone in cut if not gone or text.strip(SPACE)]
    assert len({k for k, _ in cleaned}) == len(cleaned)
    counts, roots = brute_classes(cleaned, Likeness())
    least = {}
    for (key, _), root in zip(cleaned, roots, strict=True):
        least[root] = min(least.get(root, key), key)
    chosen = [(key, text, *other[key]) for (key, text), root in zip(cleaned, roots, strict=True) if least[root] == key]
    final = {key: text for key, text, _, _ in drawn(chosen, mixing.Mix())}

    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} == set(final) and len(found) == len(final)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == pair[1].encode_ordinary(final[r.doc_id]) and r.n_tokens == len(ids) and r.decodes


def test_odd_documents_pass_every_stage(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = written(stage(spark, docs, SF), f"test-{name}")
            assert name == "byte_bpe" or docs.columns == before
        assert docs.filter("NOT decodes").count() == 0


def test_quality_stage_is_the_policy(documents, spark):
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, documents, SF).select("doc_id").collect()}
    ledger = quality.ledger(documents).collect()
    mask = quality.CURRENT.mask(quality.RULES)
    assert kept == {r.doc_id for r in ledger if not r.failures & mask}
