"""Secret scans: fixed patterns, and for values in a credential context the number of guesses they would take.

The guess count is the cheapest way to cut a value into known words, dates, repeats, sequences, keyboard walks and
spans that have to be tried character by character (dynamic programming over the value's positions). A value that needs
``MIN_BITS`` bits of guessing or more is a secret; a dictionary word behind ``password:`` is not. The dictionary is the
corpus' own: the ``DICTIONARY`` most frequent words that stand in two different texts or more outside of credential
values, behind the list of frequent password parts. Words that are rarer are priced letter by letter. Documents are judged one by one
in Arrow batches; only word counts are shuffled, combined on the map side.

A value in quotes goes up to its closing quote on the line, so that a passphrase is priced as a whole; without quotes or without
a closing one it ends at white space.

Defined results: a null or empty text has no spans; repeated rows each get theirs; an empty table gives an empty
result. Texts and values of any length are read whole; the work is linear in a value's length.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import named, written

# The base patterns, the least length of what they find, and the order of kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Words that make what follows a credential.
CONTEXTS = ("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "api_key", "apikey", "api-key",
            "credential", "auth", "private_key", "login")
_HEAD = ("(?:" + "|".join(map(re.escape, CONTEXTS)) + r""")s?["']?[\x20\t]*(?:=>|:=|[:=]|\bis\b)[\x20\t]*""")
_CONTEXT = re.compile(_HEAD + r"""(?:"((?:[^"\\\n]|\\[^\n])+)"|'((?:[^'\\\n]|\\[^\n])+)'|["']?([^\s"'<>,;]+))""",
                      re.ASCII | re.IGNORECASE)
#: A quote behind this opens the next value and does not close the one before.
_OPENS = re.compile(_HEAD + r"\Z", re.ASCII | re.IGNORECASE)
_BARE = re.compile(r"""[^\s"'<>,;]+""", re.ASCII)
MIN_BITS = 40.0
#: Words that the corpus' dictionary has at most, and the letters of each.
DICTIONARY, LETTERS = 50_000, (3, 24)

#: Frequent parts of passwords, most frequent first; a word's place is its rank. Deployments give their own list.
COMMON_WORDS = (
    "password", "qwerty", "dragon", "monkey", "letmein", "login", "princess", "welcome", "admin", "master", "hello",
    "freedom", "whatever", "trustno", "shadow", "sunshine", "iloveyou", "football", "baseball", "superman", "batman",
    "secret", "summer", "winter", "spring", "autumn", "monday", "friday", "january", "august", "test", "guest", "user",
    "root", "change", "changeme", "default", "example", "token", "key", "pass", "word", "love", "the", "and", "you",
    "computer", "internet", "server", "service", "system", "company", "money", "star", "king", "queen", "angel",
)
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("013457@$!", "oleastasi")
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


def _neighbours() -> dict[str, set[str]]:
    place = {c: (r, i) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row)}
    return {c: {d for d, (s, j) in place.items() if d != c and abs(r - s) <= 1 and abs(i - j) <= 1}
            for c, (r, i) in place.items()}


_NEXT_KEYS = _neighbours()


class Ranked(NamedTuple):
    """Words by rank, and the length of the longest."""

    ranks: dict[str, int]
    longest: int


@functools.lru_cache(maxsize=4)
def _ranked(words: tuple[str, ...]) -> Ranked:
    ranks: dict[str, int] = {}
    for i, word in enumerate(words, 1):
        ranks.setdefault(word.lower(), i)
    return Ranked(ranks, max(map(len, ranks), default=0))


def _alphabet(value: str) -> int:
    size = 0
    for known, count in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10)):
        size += count * any(c.isascii() and known(c) for c in value)
    size += 33 * any(c.isascii() and not c.isalnum() for c in value)
    return size + 100 * any(not c.isascii() for c in value)


def guess_bits(value: str, words: tuple[str, ...] | Ranked = COMMON_WORDS) -> float:
    """Base-two logarithm of the guesses for the cheapest segmentation of ``value``."""
    n = len(value)
    if not n:
        return 0.0
    ranks, longest = words if isinstance(words, Ranked) else _ranked(words)
    low = value.lower()
    plain = low.translate(_LEET)
    per_char = math.log2(max(2, _alphabet(value)))
    spans: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # by start: (end, bits)
    for start in range(n):
        for end in range(start + 3, min(n, start + longest) + 1):
            for spelled, extra in ((low[start:end], 0.0), (plain[start:end], 2.0)):
                if spelled in ranks:
                    case = 0.0 if value[start:end].islower() else 1.0
                    spans[start].append((end, math.log2(1 + ranks[spelled]) + case + extra))
                    break
    for found in _DATE.finditer(value):
        bits = math.log2(120) if found.end() - found.start() == 4 else math.log2(365 * 120) + 1
        spans[found.start()].append((found.end(), bits))
    runs = (
        (lambda a, b: a == b, per_char, 2),
        (lambda a, b: abs(ord(b) - ord(a)) == 1 and a.isalnum() and b.isalnum(), 5.0, 3),
        (lambda a, b: b in _NEXT_KEYS.get(a, ()), math.log2(47) + 1, 3),
    )
    for follows, first, least in runs:
        start = 0
        while start < n:
            end = start + 1
            while end < n and follows(low[end - 1], low[end]):
                end += 1
            if end - start >= least:
                steps = 0.0 if first == per_char or first == 5.0 else 1.5 * (end - start - 1)
                spans[start].append((end, first + math.log2(end - start) + steps))
            start = max(end - 1, start + 1) if end - start > 1 and end < n else end
    for size in range(2, min(64, n // 2) + 1):  # copies of up to 64 characters, wherever they stand
        start = 0
        for end in range(size, n + 1):
            if end == n or value[end] != value[end - size]:
                if end - start >= 2 * size:
                    spans[start].append((end, size * per_char + math.log2((end - start) / size)))
                start = end - size + 1
    best = [0.0] + [math.inf] * n
    for at in range(n):
        here = best[at]
        if here + per_char < best[at + 1]:
            best[at + 1] = here + per_char
        for end, bits in spans[at]:
            if here + bits + 1 < best[end]:  # one bit for the choice to cut here
                best[end] = here + bits + 1
    return best[n]


def _values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values in a credential context."""
    at = 0
    while m := _CONTEXT.search(text, at):
        start, end = m.span(m.lastindex)
        if m.lastindex < 3 and _OPENS.search(text, start, end):
            bare = _BARE.match(text, start, end)
            start, end = bare.span() if bare else (start, start)
        if start < end:
            yield start, end
        at = max(end, m.start() + 1)


def find_spans(text: str | None, words: tuple[str, ...] | Ranked = COMMON_WORDS, min_bits: float = MIN_BITS):
    """(kind, start, end, bits) by start and kind; bits is None for the fixed patterns."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [("assign", m.start(), m.end(), None) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), None) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), None) for m in _HEX.finditer(text)]
    if any(k in low for k in CONTEXTS):
        for start, end in _values(text):
            bits = guess_bits(text[start:end], words)
            if bits >= min_bits:
                found.append(("guess", start, end, round(bits, 6)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def corpus_words(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> tuple[str, ...]:
    """The ``size`` most frequent words of ``docs``, most frequent first; no more reach the driver.

    Words are classed by frequency, each class in 64 parts by hash, and the classes are counted first: those that fit are taken
    whole, so no task and no collection holds more than ``size`` words, whatever the number of partitions.

    A word is a run of letters between other characters than letters and digits. It has to stand in two different texts,
    and what follows a credential context, up to white space, is not counted.
    """
    whole = F.lower(named(text).cast("string"))
    head = "(?i)" + _HEAD + r"""["']?[^\s"'<>,;]+"""
    named_once = F.lit(False)
    for context in CONTEXTS:
        named_once = named_once | whole.contains(context)
    clean = F.when(named_once, F.regexp_replace(whole, head, " ")).otherwise(whole)
    rows = docs.select(F.explode(F.split(clean, r"[^\p{L}\p{N}]+")).alias("word"), F.xxhash64(named(text)).alias("mark"))
    counts = rows.filter(F.length("word").between(*LETTERS) & F.col("word").rlike(r"^\p{L}+$")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min("mark").alias("least"), F.max("mark").alias("most"))
    order = F.floor(F.log2("n") * 8).cast("long") * 64 + F.pmod(F.xxhash64("word"), F.lit(64))
    listed = written(counts.filter("least <> most").select("word", "n", order.alias("class")), "words")
    left, lowest = size, None
    for row in sorted(listed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if row["n"] > left:
            break
        left, lowest = left - row["n"], row["class"]
    if lowest is None:
        return ()
    found = listed.filter(F.col("class") >= lowest).select("word", "n").collect()
    return tuple(r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"])))


def scan(docs: DataFrame, text: str = "text", out: str = "secrets", words: tuple[str, ...] | None = None,
         min_bits: float = MIN_BITS) -> DataFrame:
    """``docs`` and an array ``out`` (which must not be a column yet) of kind, start, end (code points), bits.

    ``words`` is a ranked dictionary; by default the frequent password parts and then the corpus' own words.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"documents already have a column {out}")
    words = COMMON_WORDS + corpus_words(docs, text) if words is None else words
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    def batch(values: pa.Array) -> pa.Array:
        ranked = _ranked(words)
        return pa.array([[dict(zip(("kind", "start", "end", "bits"), s, strict=True))
                          for s in find_spans(v.as_py(), ranked, min_bits)] for v in values], kinds)

    run = F.arrow_udf(batch, "array<struct<kind:string,start:long,end:long,bits:double>>")
    return docs.withColumn(out, run(named(text).cast("string")))
