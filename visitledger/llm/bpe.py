"""Byte-level BPE over Arrow batches, by the ranks of a published vocabulary file.

The ``tokenizers`` library merges; the vocabulary is written in its byte-to-character alphabet. A rank file names only
the merged tokens, so every way to cut a token into two known tokens is a merge of that token's rank, the longer left
part first: ties then go to the leftmost pair, as in the reference encoder of such files. A piece that is a token as a
whole is taken without merging. Text is cut into the pattern's matches first; each distinct piece of a batch is merged
once, in a cache of bounded size that only saves time.

Defined results: a null or empty text has no tokens (empty ids) and decodes to no bytes; null ids decode to no bytes;
rows may repeat; an empty table gives an empty result. Ids are little-endian unsigned 32-bit integers in one binary
value: a text of any length is one value, worked on piece by piece.
"""

from __future__ import annotations

import base64
import functools
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import named

#: Characters of distinct pieces that a worker keeps merged; beyond that it starts afresh.
CACHE_CHARS = 2_000_000


def byte_alphabet() -> dict[int, str]:
    """The usual byte-to-character table: printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class Coder:
    """Encoder and decoder of one vocabulary; one per worker process."""

    def __init__(self, data: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(data)
        alphabet = byte_alphabet()
        spell = lambda token: "".join(map(alphabet.__getitem__, token))
        cuts = sorted(
            (rank, -i, token[:i], token[i:])
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks)
        model = models.BPE(vocab={spell(t): r for t, r in ranks.items()}, ignore_merges=True,
                           merges=[(spell(left), spell(right)) for _, _, left, right in cuts])
        self.merger = Tokenizer(model)
        self.merger.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(pattern).findall
        back = {c: b for b, c in alphabet.items()}
        self.bytes_of = {i: bytes(map(back.__getitem__, s)) for s, i in self.merger.get_vocab().items()}
        self.length_of = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, token in self.bytes_of.items():
            self.length_of[i] = len(token)
        self.cache: dict[str, bytes] = {}
        self.cached_chars = 0

    def _merge(self, pieces: list[str]) -> None:
        if self.cached_chars > CACHE_CHARS:
            self.cache, self.cached_chars = {}, 0
        new = [piece for piece in set(pieces) if piece not in self.cache]
        for start in range(0, len(new), 1000):
            part = new[start:start + 1000]
            for piece, coded in zip(part, self.merger.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.cache[piece] = struct.pack(f"<{len(coded.ids)}I", *coded.ids)
        self.cached_chars += sum(map(len, new))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = self.pieces(text)
        self._merge(pieces)
        return b"".join(map(self.cache.__getitem__, pieces))

    def spans(self, text: str | None, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and end (exclusive) of every token. Tokens that share a split character both span it."""
        ends = self.length_of[np.frombuffer(ids, "<u4")].cumsum()
        raw = np.frombuffer((text or "").encode(), np.uint8)
        char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
        starts = np.concatenate([ends[:0], [0], ends[:-1]])[:len(ends)]
        return char_of[starts], char_of[ends - 1] + 1

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def _coder(data: bytes, pattern: str) -> Coder:
    return Coder(data, pattern)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, a fixed size of about one megabyte, sent once to every executor."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocab: Broadcast, pattern: str, text: str = "text", out: str = "tokens",
           offsets: bool = False, decode: bool = False) -> DataFrame:
    """``docs`` and a struct ``out``: n_tokens, ids (binary), on request starts and ends in characters and ``decoded``.

    ``decoded`` holds the bytes that the ids stand for, as ``decoded()`` gives them; here the same worker does both, where
    a second function would start a second worker for every task. ``out`` must not be a column of ``docs``; other names may clash with its fields.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"documents already have a column {out}")

    def batch(values: pa.Array) -> pa.Array:
        coder = _coder(vocab.value, pattern)
        texts = (v.as_py() for v in values)
        ids, n, starts, ends, back = [], [], [], [], []
        for value in texts:
            coded = coder.encode(value)
            ids.append(coded)
            n.append(len(coded) // 4)
            if offsets:
                first, last = coder.spans(value, coded)
                starts.append(first)
                ends.append(last)
            if decode:
                back.append(coder.decode(coded))
        fields = {"n_tokens": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary())}
        if offsets:
            fields |= {"starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64()))}
        if decode:
            fields["decoded"] = pa.array(back, pa.binary())
        return pa.StructArray.from_arrays(list(fields.values()), list(fields))

    kind = "n_tokens:long,ids:binary" + (",starts:array<long>,ends:array<long>" if offsets else "")
    kind += ",decoded:binary" if decode else ""
    run = F.arrow_udf(batch, f"struct<{kind}>")
    return docs.withColumn(out, run(named(text).cast("string")))


def decoded(ids: Column, vocab: Broadcast, pattern: str) -> Column:
    """The bytes that the ids stand for. A character split over tokens is whole again once all its tokens are there."""

    def batch(values: pa.Array) -> pa.Array:
        coder = _coder(vocab.value, pattern)
        return pa.array([coder.decode(v.as_py()) for v in values], pa.binary())

    return F.arrow_udf(batch, "binary")(ids)


def decode_text(ids: Column, vocab: Broadcast, pattern: str) -> Column:
    """The ids as text. Bytes of a character that is cut off or broken become U+FFFD."""

    def batch(values: pa.Array) -> pa.Array:
        coder = _coder(vocab.value, pattern)
        return pa.array([coder.decode(v.as_py()).decode("utf-8", "replace") for v in values], pa.string())

    return F.arrow_udf(batch, "string")(ids)
