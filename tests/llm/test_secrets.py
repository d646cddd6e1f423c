import re

import pytest

from visitledger.llm import secrets

ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"""(?:{ANY_CASE}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


CASES = [
    "", "password=short", "password: token: abcdefgh", "PassWord = \"abcDEF123\"", "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 20,
    "é api_key='x-y_z/1234'", "0123456789abcdef01234567", "g0123456789abcdef0123456", "to\u212aen=abcdefgh", "tokentoken==abcdefg",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    assert [s[:3] for s in secrets.find_spans(text) if s[0] != "guess"] == base(text)


def brute_bits(value, words):
    """The same costs over every segmentation, by recursion on what the library's spans say about whole pieces."""
    import functools
    import math

    per_char = math.log2(max(2, secrets._alphabet(value)))
    ranks = {w: i for i, w in reversed(list(enumerate(words, 1)))}

    @functools.cache
    def best(at):
        if at == len(value):
            return 0.0
        options = [per_char + best(at + 1)]
        for end in range(at + 3, len(value) + 1):
            if value[at:end] in ranks:
                options.append(math.log2(1 + ranks[value[at:end]]) + 1 + best(end))
        return min(options)

    return best(0)


def test_word_segmentation_is_cheapest():
    words = ("horse", "battery", "staple", "correct", "rect", "cor")
    for value in ("correcthorse", "xcorrectq", "batterystaplez"):
        assert secrets.guess_bits(value, words) == pytest.approx(brute_bits(value, words))


def test_guess_order():
    bits = [secrets.guess_bits(v) for v in ("password", "password1987", "qwertyuiop", "aaaaaaaaaaaa", "2024-01-31", "h7Kq9zPw2xVb5LtY")]
    assert all(b < secrets.MIN_BITS for b in bits[:-1]) and bits[-1] >= secrets.MIN_BITS
    assert secrets.guess_bits("") == 0.0


def test_guess_spans():
    text = "login: h7Kq9zPw2xVb5LtY and password: password1"
    assert [s[:3] for s in secrets.find_spans(text) if s[0] == "guess"] == [("guess", 7, 23)]


def test_frames(spark, odd, none):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")  # the smallest table that holds secrets
    rows = secrets.scan(documents).select("text", "secrets").collect()
    assert any(r.secrets for r in rows)
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.secrets if s.kind != "guess"] == base(r.text or "")
    assert secrets.scan(odd).columns == [*odd.columns, "secrets"] and secrets.scan(odd).count() == odd.count()
    assert secrets.scan(none).count() == 0
    with pytest.raises(ValueError):
        secrets.scan(odd, out="mark")
    assert secrets.guess_bits("ab1" * 30_000) > 0


def guessed(text, **options):
    return [text[s[1]:s[2]] for s in secrets.find_spans(text, **options) if s[0] == "guess"]


def test_clean_prose_with_the_corpus_words(spark):
    prose = ["An important message says that the lines are concatenated first.",
             "Two concatenated lines, one important message, and then the password zqvxkwjyhf is gone.",
             "the secret is important", "the token is concatenated", "password: zqvxkwjyhf", "password = zqvxkwjyhf"]
    docs = spark.createDataFrame(list(enumerate([*prose, None, ""])), "doc_id long, text string")
    words = secrets.corpus_words(docs)
    assert {"important", "concatenated", "message"} <= set(words) and "zqvxkwjyhf" not in words
    few = secrets.corpus_words(docs, size=2)
    assert 1 <= len(few) <= 2 and set(few) <= set(words)
    found = {r.doc_id: [r.text[s.start:s.end] for s in r.secrets if s.kind == "guess"]
             for r in secrets.scan(docs).collect() if r.secrets}
    assert found == {4: ["zqvxkwjyhf"], 5: ["zqvxkwjyhf"]}


def test_quoted_values_are_priced_whole():
    assert guessed('password: "correct horse battery staple"') == ["correct horse battery staple"]
    assert guessed("passphrase = 'correct horse battery staple', x") == ["correct horse battery staple"]
    assert guessed('{"secret": "a \\"b\\" h7Kq9zPw2x"}') == ['a \\"b\\" h7Kq9zPw2x']
    # no closing quote: up to white space, and the next context is not swallowed
    assert guessed('password="h7Kq9zPw2xVb5LtY and token="Zt5LbVx2wPz9qK7h') == ["h7Kq9zPw2xVb5LtY", "Zt5LbVx2wPz9qK7h"]
    assert guessed('password: "password"') == []


def test_repeats_inside_a_value():
    assert secrets.guess_bits("k7z" * 6 + "q") < secrets.MIN_BITS
    assert secrets.guess_bits("q" + "k7z" * 6) < secrets.MIN_BITS
