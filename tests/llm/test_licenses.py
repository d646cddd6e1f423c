import re

import pytest

from visitledger.llm import licenses

ALL = tuple({**licenses.BASE_PHRASES, **licenses.PHRASES})
GOOD = frozenset(licenses.PERMITTED)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = [(p, i) for p in ALL for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return len(words), sorted(places)


@pytest.mark.parametrize(("line", "expected"), [
    (b" MIT", ("mit", ["mit"], True)),
    (b" MIT OR GPL-2.0-only", ("(mit or gpl-2.0-only)", ["mit", "gpl-2.0-only"], True)),
    (b" MIT AND GPL-2.0", ("(mit and gpl-2.0)", ["mit", "gpl-2.0"], False)),
    (b" a OR MIT AND b", ("(a or (mit and b))", ["a", "mit", "b"], False)),
    (b" (a OR MIT) AND ISC */", ("((a or mit) and isc)", ["a", "mit", "isc"], True)),
    (b" Apache-2.0 WITH LLVM-exception", ("apache-2.0 with llvm-exception", ["apache-2.0"], True)),
    (b" MIT OR", ("mit", ["mit"], True)),
    (b" (MIT", None), (b"", None), (b" OR MIT", None), (b" MIT GPL", ("mit", ["mit"], True)),
])
def test_expressions(line, expected):
    assert licenses.parse_expression(line, GOOD) == expected


def test_frames(odd, none, documents):
    for docs in (odd, documents):
        for r in licenses.scan(docs).select("text", "licences").collect():
            n, places = brute(r.text)
            assert r.licences.n_words == n
            assert sorted((p.phrase, p.word) for p in r.licences.places) == places
    tagged = [e for r in licenses.scan(odd).select("licences.expressions").collect() for e in r.expressions]
    assert [(e.expression, e.permitted) for e in tagged] == [("(mit or (gpl-2.0 and x))", True)]
    assert licenses.scan(odd).columns == [*odd.columns, "licences"] and licenses.scan(none).count() == 0


def test_overlapping_phrases():
    n, places, _ = licenses.scan_text("lesser general public license general public license", ALL, GOOD)
    assert n == 7 and sorted(places) == [("general public license", 1), ("general public license", 4),
                                         ("lesser general public license", 0)]
