"""Documents packed in order into token sequences, cut where padding and truncation cost least.

Documents are dealt by ranges of their id and sorted, encoded by ``tokenizers`` in that order, and laid end to end. A
dynamic program over the places where a document or a sentence ends chooses the cuts. A sequence of n tokens is padded
to ``width``, which costs width - n, unless n is a power of two; a cut costs nothing at the end of a document,
``Costs.sentence`` at the end of a sentence and ``Costs.inside`` elsewhere. The least cost of a padded sequence that ends
at a place comes from a monotone queue over the places at most ``width`` before it, that of a power of two from a look at
the thirteen places that far back. Cuts inside sentences are only made where a sentence is longer than a sequence, and at the end of
a range, where what remains may be laid out as powers of two.

The program runs over ``HORIZON`` tokens at a time; cuts far enough from the end of those are settled, the rest is laid
out again with the documents that follow. So a task holds a bounded number of tokens beside its longest document, and
each range leaves one unfilled end only. Sequence ids count from the range's number times 2^33.

Defined results: a null or empty text has the end id alone; null ids come first; rows may repeat, equal ones each have
pieces of their own; an empty table gives an empty result; other columns are left aside, whatever their names.
"""

from __future__ import annotations

import functools
import json
import os
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import named

#: Distinct words and pieces that a worker keeps encoded; beyond that it keeps those of the texts at hand.
CACHE_WORDS = 500_000
#: Characters of a text that are encoded at once, tokens that are laid out at once, and the tokens at their end that stay open.
SLICE, HORIZON, OPEN = 4_000_000, 1_000_000, 65_536
#: Words whose pieces are known without the file's own normalizer: ASCII, and Latin letters that stay as they are
#: under NFC and have one lower-case letter.
PLAIN = "^[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]+$"


@dataclass(frozen=True)
class Costs:
    """Tokens of padding that a cut is worth."""

    width: int = 4096
    sentence: int = 8
    inside: int = 64


def _gathered(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _strings(column: pa.Array) -> list[str]:
    """As ``to_pylist``, which makes an object of Arrow's for each value first."""
    return column.to_numpy(zero_copy_only=False).tolist()


class _Ids:
    """Ids of numbered strings in one growing array; the number 0 is the empty string. Strings are looked up by Arrow, many at
    once, so that there is no Python object for a word."""

    def __init__(self) -> None:
        self.names = pa.array([""], pa.large_string())
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        self.begins, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def add(self, names: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Strings that are new, and their ids one after the other."""
        count, end = len(self.names), self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while count + len(names) > len(self.sizes):
            self.begins, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.sizes))
        self.flat[self.used:end] = ids
        self.sizes[count:count + len(names)] = sizes
        self.begins[count:count + len(names)] = self.used + np.cumsum(sizes) - sizes
        self.names = pa.concat_arrays([self.names, names])
        self.used = end

    def numbers(self, names: pa.Array) -> np.ndarray:
        """The number of each string, -1 for those that are not there."""
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().copy()

    def known(self, names: pa.Array, fill: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
        """The number of each of some different strings. ``fill`` adds new ones and says in which order."""
        numbers = self.numbers(names)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            if len(self.names) + len(missing) > CACHE_WORDS:
                numbers = self._kept(numbers)
            first = len(self.names)
            numbers[missing[fill(names.take(pa.array(missing)))]] = np.arange(first, first + len(missing))
        return numbers

    def _kept(self, numbers: np.ndarray) -> np.ndarray:
        """Forgets all strings but those of these numbers, and returns their new numbers."""
        there = np.flatnonzero(numbers > 0)
        old = numbers[there]
        names, sizes, ids = self.names.take(pa.array(old)), self.sizes[old], self.of(old)
        self.__init__()
        self.add(names, sizes, ids)
        numbers[there] = np.arange(1, len(there) + 1)
        return numbers

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return _gathered(self.flat, self.begins[numbers], self.sizes[numbers])


class Encoder:
    """Ids of texts by a vocabulary file whose words end in a mark of their own and never reach over white space.

    Words between spaces, tabs and newlines are numbered and encoded once each; a text's ids are gathered by the numbers of its
    words. Words of ``PLAIN`` characters are lowered and cut by the file's own pattern, all new ones in one call, and new
    pieces go to the model together; any other word, and one that may hold a special token, goes through the file's whole
    pipeline. Both give what the library gives for the text.
    """

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.whole = Tokenizer.from_str(data.decode())
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]}
        self.merger = Tokenizer.from_str(json.dumps(spec))
        tokens = spec["model"]["vocab"]
        mark = spec["model"]["end_of_word_suffix"]
        size = max(max(tokens.values()), *(t["id"] for t in spec["added_tokens"]), 0) + 1
        self.word_ends = np.zeros(size, bool)
        self.sentence_ends = np.zeros(size, bool)
        for token, i in tokens.items():
            if token.endswith(mark):
                self.word_ends[i] = True
                self.sentence_ends[i] = token[:-len(mark)].rstrip("\"')]").endswith((".", "!", "?"))
        self.words, self.pieces = _Ids(), _Ids()

    def cut(self, words: pa.Array) -> pa.Array:
        """Pieces of lowered plain words, each followed by a space; by Arrow's regular expressions, which take the first
        alternative that fits as the library's do, and know the same letters and digits among plain characters."""
        return pc.replace_substring_regex(words, self.pattern, r"\0 ")

    def _fill_pieces(self, new: pa.Array) -> np.ndarray:
        names, coded, sizes = _strings(new), [], []
        for start in range(0, len(names), 2000):
            part = names[start:start + 2000]
            coded.append(np.array(self.merger.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4"))
            sizes.append(np.diff(np.flatnonzero(self.word_ends[coded[-1]]), prepend=-1))
            if len(sizes[-1]) != len(part):
                raise ValueError("a piece has to end in the vocabulary's mark once")
        self.pieces.add(new, np.concatenate(sizes), np.concatenate(coded))
        return np.arange(len(new))

    def _fill(self, new: pa.Array) -> np.ndarray:
        """Encodes words that were not there before, plain ones first."""
        plain = pc.and_not(pc.match_substring_regex(new, PLAIN), pc.match_substring(new, "<|"))
        words, others = new.filter(plain), new.filter(pc.invert(plain))
        if len(words):
            split = pc.split_pattern(self.cut(pc.utf8_lower(words)), " ")
            pieces = split.flatten().dictionary_encode()
            numbers = self.pieces.known(pieces.dictionary, self._fill_pieces)[pieces.indices.to_numpy()]
            upto = np.concatenate([[0], np.cumsum(self.pieces.sizes[numbers])])
            ends = upto[np.cumsum(pc.list_value_length(split).to_numpy())]
            self.words.add(words, np.diff(ends, prepend=0), self.pieces.of(numbers))
        coded, sizes = [np.empty(0, "<u4")], []
        for start in range(0, len(others), 1000):
            part = [c.ids for c in self.whole.encode_batch_fast(_strings(others[start:start + 1000]), add_special_tokens=False)]
            coded.append(np.array([i for ids in part for i in ids], "<u4"))
            sizes += [len(ids) for ids in part]
        self.words.add(others, np.array(sizes, np.int64), np.concatenate(coded))
        return np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of a bounded size; the words that none of them had before are encoded together."""
        column = pa.array(texts, pa.large_string())
        for mark in "\n\t":
            column = pc.replace_substring(column, mark, " ")
        split = pc.split_pattern(column, " ")
        words = split.flatten().dictionary_encode()
        numbers = self.words.known(words.dictionary, self._fill)[words.indices.to_numpy()]
        upto = np.concatenate([[0], np.cumsum(self.words.sizes[numbers])])
        ends = upto[np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.split(self.words.of(numbers), ends[:-1])

    def encode(self, text: str | None) -> np.ndarray:
        text, parts, at = text or "", [], 0
        while at < len(text):
            end = len(text)
            if end - at > SLICE:  # at the next white space
                end = min((x for x in (text.find(c, at + SLICE) for c in " \n\t") if x >= 0), default=end)
            parts += self._group([text[at:end]])
            at = end
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order. Short texts are encoded in groups."""
        held, size = [], 0
        for text in texts:
            if len(text or "") < SLICE // 4:
                held.append(text or "")
                size += len(held[-1])
            if held and (size >= SLICE or len(text or "") >= SLICE // 4):
                yield from self._group(held)
                held, size = [], 0
            if len(text or "") >= SLICE // 4:
                yield self.encode(text)
        if held:
            yield from self._group(held)


@functools.lru_cache(maxsize=2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(data)


def powers(length: int, width: int) -> list[int]:
    """A length as full sequences and then falling powers of two."""
    rest = length % width
    return [width] * (length // width) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def layout(places: np.ndarray, penalty: np.ndarray, costs: Costs, last: bool) -> tuple[list[int], int]:
    """(cuts, cost): the cheapest cuts of the tokens from 0 to ``places[-1]``, the last place included.

    ``places`` rise from above 0; ``penalty`` is what a cut there costs. With ``last`` the end may be laid out as powers
    of two.
    """
    width = costs.width
    at = np.concatenate([[0], places]).astype(np.int64)
    index = np.full(int(at[-1]) + 1, -1, np.int64)
    index[at] = np.arange(len(at))
    # places a power of two before each, as one list in the order of the places they lead to
    backs = [at - (1 << k) for k in range(width.bit_length())]
    met = [np.where(back >= 0, index[np.maximum(back, 0)], -1) for back in backs]
    leads = [np.flatnonzero(m >= 0) for m in met]
    order = np.argsort(np.concatenate(leads), kind="stable")
    exact = np.concatenate([m[j] for m, j in zip(met, leads, strict=True)])[order].tolist()
    upto = np.cumsum(np.bincount(np.concatenate(leads), minlength=len(at))).tolist()
    position, price = at.tolist(), [0, *np.asarray(penalty).tolist()]
    best, came, inside = [0] * len(at), [0] * len(at), [False] * len(at)
    level = [0] * len(at)  # best + position, which rises along the queue
    queue = deque([0])
    done = 0
    for j in range(1, len(position)):
        end = position[j]
        while queue and position[queue[0]] < end - width:
            queue.popleft()
        if queue:
            i = queue[0]
            least = level[i] + width - end
        else:  # no place within a sequence of this one
            i = j - 1
            least = best[i] + costs.inside * (len(powers(end - position[i], width)) - 1)
            inside[j] = True
        if upto[j] > done:
            for k in exact[done:upto[j]]:
                if best[k] < least or best[k] == least and inside[j]:
                    i, least, inside[j] = k, best[k], False
            done = upto[j]
        if last and j == len(position) - 1:
            for k in range(j - 1, -1, -1):
                if position[k] < end - width:
                    break
                split = best[k] + costs.inside * (len(powers(end - position[k], width)) - 1)
                if split < least:
                    i, least, inside[j] = k, split, True
        best[j] = least = least + price[j]
        came[j] = i
        level[j] = least = least + end
        while queue and level[queue[-1]] >= least:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(position) - 1
    while j:
        i = came[j]
        if inside[j]:
            cuts += [position[i] + c for c in np.cumsum(powers(position[j] - position[i], width))[::-1].tolist()]
        else:
            cuts.append(position[j])
        j = i
    return cuts[::-1], best[-1]


class _Packer:
    """Documents in order, laid out as soon as ``horizon`` tokens are there."""

    def __init__(self, sentence_ends: np.ndarray, costs: Costs, horizon: int, open_tokens: int, first: int):
        self.ends, self.costs, self.horizon, self.open = sentence_ends, costs, horizon, open_tokens
        self.sequence = first
        self.docs: deque[tuple[object, np.ndarray, int]] = deque()  # key, ids, ids that are out already
        self.tokens = 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, ids, 0))
        self.tokens += len(ids)
        if self.tokens >= self.horizon:
            yield from self.settle(last=False)

    def settle(self, last: bool) -> Iterator[tuple]:
        """(key, start, ids, tokens of the document, sequence, offset, padded width) of every piece that is settled."""
        if not self.tokens:
            return
        places, penalty, at = [], [], 0
        for _, ids, out in self.docs:
            stops = np.flatnonzero(self.ends[ids[out:-1]]) + 1
            size = len(ids) - out
            stops = stops[stops < size]
            places += [stops + at, [at + size]]
            penalty += [np.full(len(stops), self.costs.sentence), [0]]
            at += size
        cuts, _ = layout(np.concatenate(places), np.concatenate(penalty), self.costs, last)
        if not last:
            cuts = [c for c in cuts if c <= at - self.open]
        begin = 0
        for end in cuts:
            length, offset = end - begin, 0
            padded = length if length & (length - 1) == 0 else self.costs.width
            while offset < length:
                key, ids, out = self.docs[0]
                take = min(len(ids) - out, length - offset)
                yield key, out, ids[out:out + take], len(ids), self.sequence, offset, padded
                offset += take
                if out + take == len(ids):
                    self.docs.popleft()
                else:
                    self.docs[0] = (key, ids, out + take)
            begin = end
            self.sequence += 1
        self.tokens = at - begin


FIELDS = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_to long")


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, a fixed size of under two megabytes, sent once to every executor."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def pack(docs: DataFrame, vocab: Broadcast, end_id: int, key: str = "doc_id", text: str = "text", costs: Costs = Costs(),
         horizon: int = HORIZON, open_tokens: int = OPEN) -> DataFrame:
    """One row for each piece of a document that lies in one sequence: the key, ``start`` and ``length`` in the document,
    ``ids`` (little-endian unsigned 32-bit), the document's tokens with the end id, the sequence, the offset there and the
    width to which the sequence is padded."""
    if open_tokens < 2 * costs.width or horizon < 2 * open_tokens:
        raise ValueError("the open end has to hold two sequences, and the horizon two such ends")
    rows = docs.select(named(key).alias("key"), named(text).cast("string").alias("text"))
    # the row's own number keeps rows of one id apart, so a hot id spreads over ranges
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    kind = T.StructType([T.StructField(key, rows.schema["key"].dataType), *T.StructType.fromDDL(FIELDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kind)
        encoder = _encoder(vocab.value)
        packer = _Packer(encoder.sentence_ends, costs, horizon, open_tokens, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], "<u4")

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            keys, starts, ids, tokens, sequences, offsets, padded = zip(*pieces, strict=True)
            columns = [keys, starts, [len(i) for i in ids], [i.tobytes() for i in ids], tokens, sequences, offsets, padded]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                coded = encoder.encode_all(value.as_py() for value in batch.column("text"))
                for name, ids in zip(batch.column("key"), coded, strict=True):
                    yield from packer.add(name.as_py(), np.concatenate([ids, end]))
            yield from packer.settle(last=True)

        held, size = [], 0
        for piece in pieces():
            held.append(piece)
            size += len(piece[2])
            if size >= 1_000_000:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return ordered.select("key", "text").mapInArrow(run, kind)
