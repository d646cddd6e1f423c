"""Repeated long byte strings, found by a difference cover and suffix buckets that are sorted one at a time.

Wanted are all positions whose suffix ties with another suffix for ``length`` bytes. A difference cover of period v holds
a few residues of which every distance modulo v is a difference. So if two suffixes tie for ``length`` bytes, some sample
position less than v bytes behind the one and the same distance behind the other tie for length - v + 1 bytes:

1. The cover sample (a ninth of all positions) is dealt to buckets by fingerprint and each bucket is sorted: samples
   with equal neighbours are tied; no rank is kept. All others are alone, and with them the suffixes that need them.
2. Only suffixes with a tied sample behind them are left. They are dealt to suffix buckets by the fingerprint of their
   first ``length`` bytes and each bucket is sorted by itself; a tie is confirmed by a 32-bit hash of four words of the string. Buckets
   are worked off in rounds of bounded volume, each of them a written table, so neither memory nor disk holds all suffixes.
3. Ties become byte spans per text.

Order among unequal suffixes is not needed, so buckets are ranges of fingerprints instead of first letters: distinct
strings are spread evenly over them. Equal strings have to meet in one bucket, so a slice of ``PIECE`` bytes first settles the
ties within itself and sends one entry for each distinct value: a long run of one byte is one entry for each slice it is
in, and a passage of a third of the texts one for each slice and offset, not one for each text. Equal texts are one text
with a count: all their strings repeat. Texts are worked on in pieces of ``PIECE`` bytes, so fingerprints of a long one
need no more memory than those of others.

Defined results: a null text is empty; an empty or short text has no spans; repeated rows each get their result, and
repeat each other from ``length`` bytes on; an empty table gives an empty result. Fingerprints have 64 bits and are
confirmed by 32 bits from elsewhere in the string; those of the screening samples have 48.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import named, written

# A difference set, every distance modulo 91 is a difference of two of its ten residues.
PERIOD, COVER = 91, (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
PIECE = 2_000_000
#: Bytes of text for each bucket, and suffixes sorted in a round for each byte of text.
BUCKET_BYTES, ROUND_SHARE = 8_000_000, 0.05

_TABLE = np.random.default_rng(400).integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if length not in _POWERS:
        def run(base: int) -> np.ndarray:
            return np.concatenate([[np.uint64(1)], np.cumprod(np.full(_STEP + length, np.uint64(base)))])

        _POWERS[length] = run(_BASE), run(pow(_BASE, -1, 2 ** 64))
    return _POWERS[length]


def fingerprints(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit fingerprints of ``data[p:p + length]`` for the ascending positions ``at``."""
    up, down = _powers(length)
    out = np.empty(len(at), np.uint64)
    cuts = np.searchsorted(at, np.arange(0, len(data) + _STEP, _STEP))
    for k, (first, last) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if first == last:
            continue
        part = data[k * _STEP:(k + 1) * _STEP + length]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_TABLE[part] * up[:len(part)])])
        p = at[first:last] - k * _STEP
        x = (sums[p + length] - sums[p]) * down[p]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[first:last] = x ^ (x >> np.uint64(32))
    return out


def checks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """32 bits from four words that lie evenly in the string."""
    total = np.zeros(len(at), np.uint64)
    width = min(8, length)
    for k in range(4):
        word = np.zeros(len(at), np.uint64)
        place = at + (length - width) * k // 3
        for j in range(width):
            word = (word << np.uint64(8)) | data[place + j]
        total = (total ^ word) * np.uint64(0xC2B2AE3D27D4EB4F)
        total ^= total >> np.uint64(31)
    return (total >> np.uint64(32)).astype(np.uint32)


def slices(texts: Iterable[tuple[int, bytes, np.ndarray | None]], reach: int, piece: int = PIECE):
    """Texts, or pieces of long ones, gathered to about ``piece`` bytes: (bytes, uids, begins, offsets, lengths, marks).

    A piece ends ``reach`` - 1 bytes behind its last own position.
    """
    held: list = []
    volume = 0

    def flush():
        data = np.frombuffer(b"".join(h[2] for h in held), np.uint8)
        sizes = np.array([len(h[2]) for h in held], np.int64)
        return (data, np.array([h[0] for h in held], np.int64), np.cumsum(sizes) - sizes,
                np.array([h[1] for h in held], np.int64), sizes, [h[3] for h in held])

    for uid, text, extra in texts:
        for offset in range(0, max(1, len(text) - reach + 1), piece):
            held.append((uid, offset, text[offset:offset + piece + reach - 1], extra))
            volume += len(held[-1][2])
            if volume >= piece:
                yield flush()
                held, volume = [], 0
    if held:
        yield flush()


_DEALT = "bucket int, uids binary, at binary, marks binary, checks binary"
#: Positions in one row of ties that a slice found by itself.
_LOCAL = 1 << 16


def _equal_runs(*ranked: np.ndarray) -> np.ndarray:
    """Begins of the runs of equal values in sorted columns."""
    change = np.ones(len(ranked[0]), bool)
    change[1:] = False
    for values in ranked:
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _dealt(marks: np.ndarray, check: np.ndarray | None, uids: np.ndarray, at: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """What a slice sends: one entry for each distinct value, one row for each bucket that the entries fall into.

    Positions of a value that the slice has several times tie with each other, so they are settled here: they go out as
    rows with a negative bucket, which spread over the tasks, and their value's entry has the uid -1. A bucket so holds
    at most one entry for each value and slice. Samples (no ``check``) only screen, so the upper 48 bits of their marks
    are enough.
    """
    keys = (marks,) if check is None else (marks, check)
    order = np.argsort(marks) if check is None else np.lexsort((check, marks))
    begin = _equal_runs(*[k[order] for k in keys])
    size = np.diff(np.append(begin, len(order)))
    settled = np.sort(order[np.repeat(size > 1, size)])
    for k in range(0, len(settled), _LOCAL):
        mine = settled[k:k + _LOCAL]
        spread = int(uids[mine[0]]) * 31 + int(at[mine[0]]) // _LOCAL
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - spread * 0x9E3779B1 % 2 ** 30], pa.int32()), pa.array([uids[mine].tobytes()]),
             pa.array([at[mine].astype("<u4").tobytes()]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())],
            ["bucket", "uids", "at", "marks", "checks"])
    order = order[begin]
    marks, at, check = marks[order], at[order], None if check is None else check[order]
    uids = np.where(size > 1, np.int64(-1), uids[order])
    bucket = (marks >> np.uint64(64 - bits)).astype(np.int32)
    first = _equal_runs(bucket)

    def blobs(values: np.ndarray, skip: int = 0) -> pa.Array:
        raw = np.ascontiguousarray(values)
        raw = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), -1)[:, skip:])
        ends = np.append(first, len(raw)).astype(np.int32) * raw.shape[1]
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(raw)])

    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), blobs(uids), blobs(at.astype("<u4")), blobs(marks.astype("<u8"), 0 if check is not None else 2),
         pa.nulls(len(first), pa.binary()) if check is None else blobs(check)],
        ["bucket", "uids", "at", "marks", "checks"])


def _by_uid(uids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """(uid, at) rows of the positions."""
    again = np.lexsort((at, uids))
    uids, at = uids[again], np.ascontiguousarray(at[again])
    first = _equal_runs(uids)
    ends = np.append(first, len(at)).astype(np.int32) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(uids[first]),
         pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(at)])], ["uid", "at"])


def _tied(rows: DataFrame) -> DataFrame:
    """(uid, at): the positions whose entry has an equal one in its bucket or its slice. A task sorts one bucket after
    another."""

    def sort_bucket(held: list[dict]) -> pa.RecordBatch | None:
        if held[0]["checks"] is None:
            upper = np.concatenate([np.frombuffer(r["marks"], np.uint8) for r in held]).reshape(-1, 6)
            marks = np.concatenate([np.zeros((len(upper), 2), np.uint8), upper], axis=1).view("<u8").ravel()
        else:
            marks = np.concatenate([np.frombuffer(r["marks"], "<u8") for r in held])
        order = np.argsort(marks, kind="stable")
        ranked = marks[order]
        same = ranked[1:] == ranked[:-1]
        tie = np.zeros(len(ranked), bool)
        tie[1:] |= same
        tie[:-1] |= same
        order = order[tie]
        if held[0]["checks"] is not None and len(order):
            check = np.concatenate([np.frombuffer(r["checks"], np.uint32) for r in held])[order]
            mark = marks[order]
            again = np.lexsort((check, mark))
            mark, check, order = mark[again], check[again], order[again]
            same = (mark[1:] == mark[:-1]) & (check[1:] == check[:-1])
            tie = np.zeros(len(order), bool)
            tie[1:] |= same
            tie[:-1] |= same
            order = order[tie]
        uids = np.concatenate([np.frombuffer(r["uids"], np.int64) for r in held])[order]
        at = np.concatenate([np.frombuffer(r["at"], np.uint32) for r in held])[order]
        open_ = uids >= 0  # the others are settled in their slices
        return _by_uid(uids[open_], at[open_]) if open_.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield _by_uid(np.frombuffer(row["uids"], np.int64), np.frombuffer(row["at"], np.uint32))
                    continue
                if held and held[0]["bucket"] != row["bucket"]:
                    if (found := sort_bucket(held)) is not None:
                        yield found
                    held = []
                held.append(row)
        if held and (found := sort_bucket(held)) is not None:
            yield found

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "uid long, at binary")


def _samples(texts: DataFrame, length: int, bits: int, piece: int) -> DataFrame:
    reach = length - PERIOD + 1
    in_cover = np.isin(np.arange(PERIOD), COVER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((u, t, None) for b in batches
                for u, t in zip(b.column("uid").to_pylist(), b.column("text").to_pylist(), strict=True))
        for data, uids, begins, offsets, sizes, _ in slices(rows, reach, piece):
            owner = np.repeat(np.arange(len(uids)), sizes)
            place = np.arange(len(data)) - begins[owner]
            at = np.flatnonzero(in_cover[(place + offsets[owner]) % PERIOD] & (place <= sizes[owner] - reach))
            if len(at):
                whose = owner[at]
                yield from _dealt(fingerprints(data, at, reach), None, uids[whose], place[at] + offsets[whose], bits)

    return texts.select("uid", F.col("text").cast("binary").alias("text")).mapInArrow(run, _DEALT)


def _positions(blobs: list[bytes] | None) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(blobs or []), np.uint32).astype(np.int64))


def _starts(size: int, sampled: np.ndarray, length: int) -> np.ndarray:
    """Mask of the positions that have a tied sample less than a period behind them."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, np.maximum(sampled - PERIOD + 1, 0), 1)
    np.add.at(change, np.minimum(sampled + 1, size), -1)
    mask = np.cumsum(change[:-1], dtype=np.int32) > 0
    mask[max(0, size - length + 1):] = False
    return mask


def _suffixes(suspects: DataFrame, length: int, bits: int, turn: int, turns: int, piece: int) -> DataFrame:
    """The suffixes of one round of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for u, t, at in zip(b.column("uid").to_pylist(), b.column("text").to_pylist(), b.column("at").to_pylist(),
                                    strict=True):
                    yield u, t, _starts(len(t), _positions(at), length)

        for data, uids, begins, offsets, sizes, masks in slices(rows(), length, piece):
            wanted = np.concatenate([m[o:o + s] for m, o, s in zip(masks, offsets, sizes, strict=True)])
            owner = np.repeat(np.arange(len(uids)), sizes)
            place = np.arange(len(data)) - begins[owner]
            at = np.flatnonzero(wanted & (place <= sizes[owner] - length))
            if not len(at):
                continue
            marks = fingerprints(data, at, length)
            mine = (marks & np.uint64(0xFFFF)) * np.uint64(turns) >> np.uint64(16) == np.uint64(turn)
            at, marks = at[mine], marks[mine]
            if len(at):
                whose = owner[at]
                yield from _dealt(marks, checks(data, at, length), uids[whose], place[at] + offsets[whose], bits)

    return suspects.select("uid", "text", "at").mapInArrow(run, _DEALT)


def spans_of(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings of ``length`` bytes at the ascending ``starts``."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + length


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, piece: int = PIECE,
            round_share: float = ROUND_SHARE) -> DataFrame:
    """Of every row: key, mark (SHA-256 of the text), n_bytes, spans (array of start, end in bytes: what repeats),
    kept_sha256 (of the bytes outside the spans). ``piece``: bytes that are worked on at once; ``round_share``: suffixes
    of a round for each byte of text. Neither changes the result."""
    if length < 2 * PERIOD:
        raise ValueError(f"strings of at least {2 * PERIOD} bytes are looked for")
    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    rows = docs.select(named(key).alias("id"), whole.alias("text"))
    marked = rows.select("id", "text", F.sha2("text", 256).alias("mark"))
    distinct = marked.filter(F.octet_length("text") >= length).groupBy("mark").agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    texts = written(distinct.withColumn("uid", F.monotonically_increasing_id()), "texts")
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(6, int(volume / BUCKET_BYTES).bit_length())

    tied = written(_tied(_samples(texts, length, bits, piece)), "tied")
    by_text = tied.groupBy(F.col("uid").alias("u")).agg(F.collect_list("at").alias("at"))
    # a text with copies repeats as a whole, whether or not others tie with a part of it
    suspects = written(texts.join(by_text, F.col("uid") == F.col("u"), "left").filter("u IS NOT NULL OR copies > 1").select(
        "uid", "mark", "copies", F.col("text").cast("binary").alias("text"), "at"), "suspects")

    def count(values: pa.Array, blobs: pa.Array) -> pa.Array:
        return pa.array([int(_starts(len(v.as_py()), _positions(b.as_py()), length).sum())
                         for v, b in zip(values, blobs, strict=True)], pa.int64())

    many = suspects.select(F.arrow_udf(count, "long")("text", "at").alias("n")).agg(F.sum("n")).first()[0] or 0
    turns = max(1, -(-many // max(1, int(volume * round_share))))
    hits = [written(_tied(_suffixes(suspects, length, bits, turn, turns, piece)), f"hits{turn}") for turn in range(turns)]
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    starts = found.groupBy(F.col("uid").alias("u")).agg(F.collect_list("at").alias("starts"))

    def cut(values: pa.Array, blobs: pa.Array, copies: pa.Array) -> pa.Array:
        spans, kept = [], []
        for value, blob, n in zip(values, blobs, copies, strict=True):
            data = value.as_py()
            if n.as_py() > 1:
                first, last = np.array([0]), np.array([len(data)])
            else:
                first, last = spans_of(_positions(blob.as_py()), length)
            digest, upto = hashlib.sha256(), 0
            for start, end in zip(first.tolist(), last.tolist(), strict=True):
                digest.update(data[upto:start])
                upto = end
            digest.update(data[upto:])
            spans.append([{"start": s, "end": e} for s, e in zip(first.tolist(), last.tolist(), strict=True)])
            kept.append(digest.hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(spans, kind), pa.array(kept, pa.string())], ["spans", "kept_sha256"])

    run = F.arrow_udf(cut, "struct<spans:array<struct<start:long,end:long>>,kept_sha256:string>")
    results = written(suspects.join(starts, F.col("uid") == F.col("u"), "left").select(
        F.col("mark").alias("m"), run("text", "starts", "copies").alias("r")), "spans")
    light = marked.select("id", "mark", F.octet_length("text").cast("long").alias("n_bytes"))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return light.join(results, F.col("mark") == F.col("m"), "left").select(
        F.col("id").alias(key), "mark", "n_bytes", F.coalesce("r.spans", none).alias("spans"),
        F.coalesce("r.kept_sha256", "mark").alias("kept_sha256"))


def without(docs: DataFrame, spans: str, text: str = "text", out: str = "kept") -> DataFrame:
    """``docs`` and the binary ``out``: the bytes of the text outside its spans."""

    def batch(values: pa.Array, cuts: pa.Array) -> pa.Array:
        kept = []
        for value, cut in zip(values, cuts, strict=True):
            data, upto, parts = (value.as_py() or "").encode(), 0, []
            for span in cut.as_py() or []:
                parts.append(data[upto:span["start"]])
                upto = span["end"]
            kept.append(b"".join([*parts, data[upto:]]))
        return pa.array(kept, pa.binary())

    return docs.withColumn(out, F.arrow_udf(batch, "binary")(named(text).cast("string"), named(spans)))
