"""Licence scans: an Aho-Corasick automaton finds identifier tags and notice phrases, a shunting-yard parser reads the
and/or/with expressions behind the tags.

Phrases are matched on words (ASCII letters lower-cased; everything else of ASCII but digits separates), so line breaks
and punctuation inside a notice do not hide it. Documents are judged one by one in Arrow batches; nothing is shuffled.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows each get their result; an empty
table gives an empty one. An expression that breaks off is read up to its last complete operand; one without any is not
an expression. Texts of any length are scanned whole, in linear time.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import named

# Phrases whose places are the base result, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices that give a label.
PHRASES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "creative commons": "cc",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "public domain": "public-domain",
    "cc0": "cc0", "eclipse public license": "epl", "isc license": "isc", "the unlicense": "unlicense",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Identifiers that an expression may rest on to be called permitted.
PERMITTED = ("mit", "mit-0", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense", "cc0-1.0", "cc-by-4.0")

_SEPARATORS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_TOKEN = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(line: bytes, permitted: frozenset[str]) -> tuple[str, list[str], bool] | None:
    """(normal text, identifiers, permitted) of the longest expression that ``line`` starts with.

    Shunting-yard: operands go to one stack, operators wait on another until a weaker one, a closing bracket or the end
    comes. ``with`` binds tightest and adds an exception to the licence on its left, then ``and``, then ``or``.
    """
    tokens: list[str] = []
    at, depth, want = 0, 0, True
    complete = 0
    while found := _TOKEN.match(line, at):
        token = (found[1] or found[2]).decode().lower()
        if token == "(":
            if not want:
                break
            depth += 1
        elif token == ")":
            if want or not depth:
                break
            depth -= 1
        elif token in _BINDS:
            if want:
                break
            want = True
        else:
            if not want:
                break
            want = False
        tokens.append(token)
        at = found.end()
        if not want and not depth:
            complete = len(tokens)
    if not complete:
        return None
    values: list[tuple[str, list[str], bool]] = []
    waiting: list[str] = []

    def reduce() -> None:
        operator, right, left = waiting.pop(), values.pop(), values.pop()
        text = f"{left[0]} {operator} {right[0]}" if operator == "with" else f"({left[0]} {operator} {right[0]})"
        if operator == "with":
            values.append((text, left[1], left[2]))
        else:
            good = left[2] and right[2] if operator == "and" else left[2] or right[2]
            values.append((text, left[1] + right[1], good))

    for token in tokens[:complete]:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                reduce()
            waiting.pop()
        elif token in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                reduce()
            waiting.append(token)
        else:
            values.append((token, [token], token in permitted))
    while waiting:
        reduce()
    return values[0]


@functools.lru_cache(maxsize=4)
def _automaton(phrases: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in phrases:
        key = f" {phrase} ".encode().decode("latin-1")
        machine.add_word(key, (phrase, len(key)))
    machine.make_automaton()
    return machine


@functools.lru_cache(maxsize=2)
def _tag_automaton(tags: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for tag in tags:
        machine.add_word(tag, tag)
    machine.make_automaton()
    return machine


def scan_text(text: str | None, phrases: tuple[str, ...], permitted: frozenset[str]):
    """(number of words, [(phrase, first word)], [(expression, identifiers, permitted)])."""
    raw = (text or "").encode()
    lowered = raw.lower()
    words = lowered.translate(_SEPARATORS).split()
    spaced = b" " + b" ".join(words) + b" "
    places, counted, upto = [], 0, 0
    for end, (phrase, length) in _automaton(phrases).iter(spaced.decode("latin-1")):
        start = end - length + 1
        if start >= upto:
            counted += spaced.count(b" ", upto, start)
            places.append((phrase, counted))
            upto = start
        else:
            places.append((phrase, counted - spaced.count(b" ", start, upto)))
    found = []
    if words:
        for end, _ in _tag_automaton(TAGS).iter(lowered.decode("latin-1")):
            stop = raw.find(b"\n", end + 1)
            if read := parse_expression(raw[end + 1:stop if stop >= 0 else len(raw)], permitted):
                found.append(read)
    return len(words), places, found


SCAN = ("n_words:long,places:array<struct<phrase:string,word:long>>,"
        "expressions:array<struct<expression:string,identifiers:array<string>,permitted:boolean>>")


def scan(docs: DataFrame, text: str = "text", out: str = "licences", phrases: dict[str, str] | None = None,
         permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """``docs`` and a struct ``out`` (which must not be a column yet): n_words, places of phrases, expressions."""
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"documents already have a column {out}")
    wanted = tuple(phrases if phrases is not None else {**BASE_PHRASES, **PHRASES})
    good = frozenset(permitted)
    kinds = pa.struct([
        ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))),
        ("expressions", pa.list_(pa.struct([
            ("expression", pa.string()), ("identifiers", pa.list_(pa.string())), ("permitted", pa.bool_())])))])

    def batch(values: pa.Array) -> pa.Array:
        rows = []
        for value in values:
            n, places, found = scan_text(value.as_py(), wanted, good)
            rows.append({
                "n_words": n, "places": [{"phrase": p, "word": w} for p, w in places],
                "expressions": [{"expression": e, "identifiers": i, "permitted": ok} for e, i, ok in found]})
        return pa.array(rows, kinds)

    return docs.withColumn(out, F.arrow_udf(batch, f"struct<{SCAN}>")(named(text).cast("string")))
