import collections
import re

from visitledger.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered))


def test_measures(odd, documents):
    for docs in (odd, documents):
        texts = collections.Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
        got = collections.Counter((r.doc_id, *[r[m] for m in quality.MEASURES]) for r in quality.ledger(docs).collect())
        assert got == texts


def test_verdicts_and_columns(odd, none):
    kept = quality.accepted(odd)
    assert kept.columns == odd.columns
    ledger = {(r.doc_id, r.n_words): r.failures for r in quality.ledger(odd).collect()}
    assert ledger[(0, 0)] & 1 and ledger[(1, 0)] & 1
    mask = quality.CURRENT.mask(quality.RULES)
    assert kept.count() == sum(not r.failures & mask for r in quality.ledger(odd).collect())
    assert quality.accepted(none).count() == 0 and quality.ledger(none).count() == 0


def test_ablations(documents):
    ledger = quality.ledger(documents).cache()
    rows = ledger.collect()
    index = {r.name: i for i, r in enumerate(quality.RULES)}
    found = quality.ablations(ledger).collect()
    assert len(found) == sum(len(p.rules) for p in quality.POLICIES)
    for got in found:
        policy = next(p for p in quality.POLICIES if (p.name, p.version) == (got.policy, got.version))
        mask, bit = policy.mask(quality.RULES), 1 << index[got.rule]
        assert got.documents == len(rows)
        assert got.kept == sum(not r.failures & mask for r in rows)
        assert got.kept_without == sum(not r.failures & mask & ~bit for r in rows)
        assert got.only_rule == got.kept_without - got.kept
        assert got.failed_rule == sum(bool(r.failures & bit) for r in rows)
    fired = quality.fired(ledger.withColumnRenamed("n_lines", "g"), "g").collect()
    assert sum(r.documents for r in fired) == len(rows)


def test_no_python_on_the_path(documents):
    plan = quality.accepted(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
