import collections
import re

from visitledger.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, rule):
    sites, texts = collections.defaultdict(set), collections.defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(SPACE):
                sites[line.strip(SPACE)].add(site)
                texts[line.strip(SPACE)].add(text)
    words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x))
    least = lambda x: rule.sites if words(x) >= rule.words else rule.short_sites
    bad = {x for x, s in sites.items() if min(len(s), len(texts[x])) >= least(x)}
    # the least id keeps the line: null ids first; these fixtures have no two texts under a tied id that share a line
    keeper = {}
    for key, text, _ in rows:
        for line in (text or "").split("\n"):
            if line.strip(SPACE) in bad:
                at = (key is not None, key or 0)
                keeper[line.strip(SPACE)] = min(keeper.get(line.strip(SPACE), at), at)
    out = collections.Counter()
    for key, text, _ in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if x.strip(SPACE) not in bad or keeper[x.strip(SPACE)] == (key is not None, key or 0)]
        out[(key, None if text is None else "\n".join(kept), len(parts) - len(kept))] += 1
    return out


def test_remove(odd, documents):
    rules = [lines.Rule(sites=n, short_sites=n) for n in (2, 3, 10)] + [lines.Rule(), lines.Rule(words=1, sites=4)]
    for docs, rule in ((odd, rules[0]), (odd, rules[1]), (documents, rules[1]), (documents, rules[2]), (documents, rules[3]),
                       (documents, rules[4])):
        rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        found = lines.remove(docs, rule=rule, removed="gone")
        assert found.columns == [*docs.columns, "gone"]
        assert collections.Counter((r.doc_id, r.text, r.gone) for r in found.collect()) == brute(rows, rule)


def test_empty_table_and_other_columns(odd, none):
    assert lines.remove(none).count() == 0
    found = lines.remove(odd)
    assert found.columns == odd.columns and found.filter("mark IS NULL").count() == odd.filter("mark IS NULL").count()


def test_near_threshold_is_exact(spark):
    rows = [(i, f"line {k}\nown {k} {i}", f"site{i}") for k in range(9, 15) for i in range(k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.sites: r.exact for r in lines.spread(docs).collect() if r.sites > 1}
    assert {k for k, exact in found.items() if exact} >= {9, 10, 11} and all(found[k] for k in (9, 10, 11))
    assert lines.boilerplate(docs).count() == 5


def test_planted_lines(spark):
    """Lines of five words go from three sites on, shorter ones from ten; copies of one text are one text."""
    rows, n = [], 0
    for sites in range(1, 13):
        for line in (f"all rights are reserved here {sites}", f"short line {sites}"):
            for site in range(sites):
                rows.append((n, f"{line}\nwords of this document {n} alone", f"s{site}"))
                n += 1
    rows += [(n + k, "a copied document of one long line\nand of a second line too", f"s{k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = lines.remove(docs, removed="gone").collect()
    gone = collections.Counter()
    text_of = {r[0]: r[1].split("\n")[0] for r in rows}
    for r in found:
        gone[text_of[r.doc_id]] += r.gone
    want = {f"all rights are reserved here {k}": k - 1 for k in range(3, 13)} | {f"short line {k}": k - 1 for k in (10, 11, 12)}
    assert {k: v for k, v in gone.items() if v} == want


def test_many_sites(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('everywhere\n', CAST(id AS STRING)) AS text", "CAST(id AS STRING) AS source")
    found = [r for r in lines.spread(docs).collect() if r.sites > 1]
    assert len(found) == 1 and not found[0].exact and abs(found[0].sites - 3000) < 3000 * 0.15
