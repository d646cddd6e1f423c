"""Periodic runs of words within a text: seeds on diagonals, extended once each.

A run is a stretch of words with smallest period q, at least ``max(least, exponent * q)`` words long, that cannot be made
longer with that period. With an exponent of e, the words of a run agree with those q places on over at least (e - 1) * q
places. For the lags of one octave, 2^s to 2^(s+1) - 1, the least such overlap is (e - 1) * 2^s words: k-grams of that
length are indexed, by numbers for the k-grams of each octave made from pairs of those before (exact, no hashes), and
only k-grams that return in the same text go on. Two neighbouring places of one k-gram whose distance lies in the octave
are a seed: since k is no less than the distance, that is the smallest period there. A seed is extended on its diagonal
in both directions; the furthest covered place of each lag keeps other seeds of the run from being extended again. Pairs
of places that are not neighbours are never formed, so the work is in proportion to the words and the logarithm of the
longest period.

Texts of an Arrow batch are worked on together, in blocks of words; separators that match nothing stand between them.
Very long texts are cut into words slice by slice and kept as numbers.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; rows may repeat; an empty
table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import free_name, named

#: Words that are worked on together, and bytes of a text that are cut into words at once.
BLOCK, SLICE = 400_000, 4_000_000
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Shape:
    """Runs of at least ``least`` words and ``exponent`` periods."""

    least: int = 6
    exponent: int = 4

    def __post_init__(self) -> None:
        if self.exponent < 3:
            raise ValueError("with fewer than three periods a k-gram of the overlap may be shorter than the period")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _words(raw: bytes, numbers: _Numbers) -> np.ndarray:
    """The words of a text as numbers. ``bytes.split`` cuts at exactly the white space between words."""
    parts, at = [], 0
    while at < len(raw):
        stop = _BREAK.search(raw, at + SLICE) if len(raw) - at > SLICE else None
        piece = raw[at:stop.start()] if stop else raw[at:]
        words = piece.split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        at = stop.start() if stop else len(raw)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _paired(first: np.ndarray, second: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by the pair of numbers, then place, and where a new pair begins."""
    key = first * (np.int64(second.max(initial=0)) + 1) + second
    order = np.argsort(key, kind="stable")
    key = key[order]
    return places[order], np.concatenate([[True], key[1:] != key[:-1]])


def _reach(codes: np.ndarray, at: int, lag: int, way: int) -> int:
    """From ``at`` on, in direction ``way``, the first place whose word differs from the one ``lag`` on."""
    width = 64
    while True:
        if way > 0:
            stop = min(at + width, len(codes) - lag)
            differs = codes[at:stop] != codes[at + lag:stop + lag]
            hit = int(differs.argmax()) if len(differs) else 0
            if not len(differs) or differs[hit]:
                return at + hit
            at = stop
        else:
            stop = max(at - width, -1)
            differs = (codes[stop + 1:at + 1] != codes[stop + 1 + lag:at + 1 + lag])[::-1]
            hit = int(differs.argmax()) if len(differs) else 0
            if not len(differs) or differs[hit]:
                return at - hit
            at = stop
        width *= 2


def find_runs(codes: np.ndarray, text_of: np.ndarray, shape: Shape = Shape()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in an array whose texts are followed by numbers that occur once."""
    runs: list[tuple[int, int, int]] = []
    n, gram = len(codes), shape.exponent - 1
    if n < gram:
        return runs
    # numbers of the shortest k-grams, built up word by word
    number = codes
    places = np.arange(n - 1)
    for width in range(2, gram + 1):
        places = np.arange(n - width + 1)
        last = width == gram
        sorted_places, new = _paired(number[:n - width + 1], codes[width - 1:], places)
        if last:
            new |= np.concatenate([[True], text_of[sorted_places[1:]] != text_of[sorted_places[:-1]]])
        group = np.cumsum(new) - 1
        if not last:
            number = np.empty(n - width + 1, np.int64)
            number[sorted_places] = group
    octave = 1
    while True:
        returns = ~new | np.concatenate([~new[1:], [False]])  # k-grams that stand more than once in their text
        places_back, group = sorted_places[returns], (np.cumsum(new) - 1)[returns]
        if not len(places_back):
            return runs
        lag = np.diff(places_back)
        seed = (np.diff(group) == 0) & (lag >= octave) & (lag < 2 * octave)
        runs += _extended(codes, places_back[:-1][seed], lag[seed], gram, shape)
        number = np.full(n, -1, np.int64)
        number[places_back] = group
        places = np.sort(places_back)
        places = places[places + gram < n]
        places = places[number[places + gram] >= 0]
        if not len(places):
            return runs
        sorted_places, new = _paired(number[places], number[places + gram], places)
        gram, octave = 2 * gram, 2 * octave


def _extended(codes: np.ndarray, starts: np.ndarray, lags: np.ndarray, gram: int, shape: Shape) -> list[tuple[int, int, int]]:
    found: list[tuple[int, int, int]] = []
    if not len(starts):
        return found
    order = np.lexsort((starts, lags))
    starts, lags = starts[order], lags[order]
    cuts = np.flatnonzero(np.diff(lags, prepend=-1))
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(lags)], strict=True):
        lag, here, k = int(lags[low]), starts[low:high], 0
        while k < len(here):
            first = _reach(codes, int(here[k]) - 1, lag, -1) + 1
            covered = _reach(codes, int(here[k]) + gram, lag, 1)
            length = covered - first + lag
            if length >= max(shape.least, shape.exponent * lag):
                found.append((first, length, lag))
            k = int(np.searchsorted(here, covered))
    return found


def _block(texts: list[np.ndarray], spelled: list[bytes], shape: Shape) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs, collapsed text) of each text of a block."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    codes = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for k, text in enumerate(texts):
        codes[starts[k]:starts[k] + sizes[k]] = text
        codes[starts[k] + sizes[k]] = len(spelled) + k
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    of: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(codes, text_of, shape):
        k = int(text_of[start])
        of[k].append((start - int(starts[k]), length, period))
    out = []
    for text, runs in zip(texts, of, strict=True):
        runs.sort(key=lambda r: (r[0], r[2]))
        if runs:
            depth = np.zeros(len(text) + 1, np.int64)
            for start, length, period in runs:
                depth[start + period] += 1
                depth[start + length] -= 1
            text = text[np.cumsum(depth[:-1]) == 0]
        out.append((0, runs, b" ".join([spelled[c] for c in text.tolist()])))
    return [(int(n), runs, kept) for n, (_, runs, kept) in zip(sizes, out, strict=True)]


def collapse(raws: list[bytes], shape: Shape = Shape(), block: int = BLOCK) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs by start and period, text without the repeats) of each text."""
    out, held, numbers, size = [], [], _Numbers(), 0
    for raw in raws:
        held.append(_words(raw, numbers))
        size += len(held[-1]) + 1
        if size >= block:
            out += _block(held, list(numbers), shape)
            held, numbers, size = [], _Numbers(), 0
    return out + (_block(held, list(numbers), shape) if held else [])


def runs(docs: DataFrame, text: str = "text", out: str = "periodic", shape: Shape = Shape()) -> DataFrame:
    """``docs`` and a struct: n_words, runs (start, length, period, by start and period) and ``collapsed``, the words
    joined by one space without those that any run holds after its first period.

    The struct is named ``out``, lengthened by ``_`` until no column has that name.
    """
    kind = "n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string"
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def batch(values: pa.Array) -> pa.Array:
        found = collapse([v.as_buffer().to_pybytes() if v.is_valid else b"" for v in values], shape)
        flat = [r for _, rs, _ in found for r in rs]
        offsets = np.concatenate([[0], np.cumsum([len(rs) for _, rs, _ in found])]).astype(np.int32)
        columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(run_type)))
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _, _ in found], pa.int64()), listed,
             pa.array([kept.decode() for _, _, kept in found], pa.string())], ["n_words", "runs", "collapsed"])

    return docs.withColumn(free_name(docs.columns, out), F.arrow_udf(batch, f"struct<{kind}>")(named(text).cast("string")))
