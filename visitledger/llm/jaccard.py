"""N-gram Jaccard join as a blocked sparse matrix product.

A document is a row of the incidence matrix of documents by shingles. Two rows of sizes x and y reach the threshold t
only if they differ in at most (1 - t)(x + y)/(1 + t) columns. So the columns, dealt by hash, are cut into more blocks
than that bound for the size class: some blocks of a linking pair are equal as a whole, so many that not all of them are
empty ones, and rows meet in an equi-join on the fingerprints of their blocks. Rows that meet are thinned by a bitmap of
their columns, as wide as the row is long, whose differing bits are a lower bound of the differing columns; what can
still link forms candidate groups. In those the sparse product is formed: overlap counts are accumulated column by column from posting lists, and pairs below the bound
of their sizes are discarded.

Nothing is capped. Documents with the same set are one row. Large groups are cut into tiles of bounded volume that
meet pairwise, and rows that are connected already are not multiplied again, since classes, not pairs, are wanted.

Defined results: a text without words, empty or null has an empty set and links with nothing, its class is its own id;
equal rows and equal ids share a class, whose id is the smallest id in it (null only if all are null); an empty table
gives an empty result. Shingles and sets are compared by 64 and 128 bit hashes. A long text is one array of its shingles.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import by_group, forest, tiled
from .components import components
from .frames import SPACE, free_name, named, written

#: Least and most bytes of a row's bitmap; between them it has a bit for each column of the row.
BITMAP = (64, 1024)
CACHED_WORDS = 200_000
#: One in so many blocks is looked at first.
FIRST = 16
#: Shingles of a group that are multiplied in one task; larger groups are cut into tiles of this volume.
TILE_SHINGLES = 1_500_000


@dataclass(frozen=True)
class Likeness:
    """Two sets link when ``whole`` * intersection >= ``part`` * union; shingles have ``width`` words."""

    width: int = 5
    part: int = 80
    whole: int = 100

    def differing(self, total: int) -> int:
        """The most columns in which two sets of ``total`` members together may differ."""
        return (self.whole - self.part) * total // (self.whole + self.part)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64 bits (the finishing steps of a well-known generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of a word, remembered; emptied when full, which only costs time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()
_TURN = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``width`` are one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(_WORDS.__getitem__, words)), np.uint64)
    take = min(width, len(words))
    total = np.full(len(words) - take + 1, np.uint64(len(words) if take < width else width))
    for k in range(take):
        total = _mix(total * _TURN[0] + hashes[k:len(hashes) - take + k + 1] + _TURN[1])
    return np.unique(total)


def _cuts(grams: np.ndarray, blocks: int) -> np.ndarray:
    """Positions where each of ``blocks`` equal ranges of the hash space begins and, last, the end."""
    edges = (np.arange(1, blocks, dtype=np.float64) * (2.0 ** 64 / blocks)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])


class _Classes:
    """Classes of sizes, each as wide as the threshold: linking sizes are in the same class or in two that follow."""

    def __init__(self, likeness: Likeness):
        self.likeness = likeness
        self.bounds: list[tuple[int, int]] = []
        self.spares: list[int] = []

    def at(self, number: int) -> tuple[int, int]:
        while len(self.bounds) <= number:
            first = self.bounds[-1][1] + 1 if self.bounds else 1
            self.bounds.append((first, max(first, self.likeness.whole * first // self.likeness.part)))
        return self.bounds[number]

    def of(self, n: int) -> int:
        while not self.bounds or self.bounds[-1][1] < n:
            self.at(len(self.bounds))
        return bisect.bisect_left(self.bounds, n, key=lambda b: b[1])

    def spare(self, number: int) -> int:
        """Blocks beyond the bound and one more: about as many as a row of this class or the one before leaves empty.

        Any number gives right results, see ``block_prints``; it is held to an eighth of the bound, since more blocks
        are shorter ones and leave still more of them empty.
        """
        while len(self.spares) <= number:
            k = len(self.spares)
            least, most = self.at(max(k - 1, 0))[0], self.likeness.differing(2 * self.at(k)[1])
            spare = 1
            for _ in range(8):
                blocks = most + 1 + spare
                empty = blocks * math.exp(-least / blocks)
                spare = min(math.ceil(empty + 4 * math.sqrt(empty)) + 1, most // 8 + 1)
            self.spares.append(spare)
        return self.spares[number]


def block_prints(grams: np.ndarray, classes: _Classes) -> np.ndarray:
    """Fingerprints of the row's column blocks for its size class and the next one.

    A linking pair has at least one more equal block than ``spare``. So a row with no more empty blocks than that leaves
    them out: one of the equal blocks is not empty. Only rows with more of them are known by their empty blocks, too.
    """
    own = classes.of(len(grams))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(grams), dtype=np.uint64)])
    prints = []
    for number in (own, own + 1):
        most = classes.likeness.differing(2 * classes.at(number)[1])
        if not most:
            continue  # only equal sets can link, and those are one row
        spare = classes.spare(number)
        blocks = most + 1 + spare
        cuts = _cuts(grams, blocks)
        inside = sums[cuts[1:]] - sums[cuts[:-1]]
        marks = _mix(inside + _mix(np.arange(blocks, dtype=np.uint64) + np.uint64(number << 32)))
        full = cuts[1:] > cuts[:-1]
        prints.append(marks if (~full).sum() > spare else marks[full])
    return np.concatenate(prints) if prints else np.empty(0, np.uint64)


def bitmap(grams: np.ndarray) -> bytes:
    """Parity of the number of columns behind each bit. The width is a power of two."""
    width = min(max(1 << (len(grams) - 1).bit_length(), BITMAP[0] * 8), BITMAP[1] * 8)
    bits = np.bincount((_mix(grams + _TURN[0]) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def same_width(bitmaps: list[bytes]) -> np.ndarray:
    """Rows of 64-bit words, all as wide as the narrowest: a wider bitmap is folded, the parities of its halves added."""
    width = min(map(len, bitmaps)) // 8
    if max(map(len, bitmaps)) == width * 8:
        return np.frombuffer(b"".join(bitmaps), np.uint64).reshape(-1, width)
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width), axis=0) for b in bitmaps])


def profiles(docs: DataFrame, key: str, text: str, likeness: Likeness) -> DataFrame:
    """(id, text_hash, size, mark, bits) of every document; mark is null for an empty set."""

    def batch(values: pa.Array) -> pa.Array:
        size, mark, bits = [], [], []
        for value in values:
            grams = shingles(value.as_py(), likeness.width)
            size.append(len(grams))
            mark.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            bits.append(bitmap(grams) if len(grams) else None)
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.array(mark, pa.binary()), pa.array(bits, pa.binary())], ["size", "mark", "bits"])

    run = F.arrow_udf(batch, "struct<size:long,mark:binary,bits:binary>")
    return docs.select(named(key).alias("id"), _text_hash(text).alias("text_hash"),
                       run(named(text).cast("string")).alias("p")).select("id", "text_hash", "p.*")


def _text_hash(text: str) -> Column:
    whole = named(text).cast("string")
    return F.xxhash64(whole, F.octet_length(whole), whole.isNull())


def _row_key(key: Column, text_hash: Column) -> Column:
    return F.xxhash64(key, key.isNull(), text_hash)


def _texts(docs: DataFrame, key: str, text: str, chosen: DataFrame) -> DataFrame:
    """(vertex, text) for the rows that stand for the sets in ``chosen`` (vertex, row_key); equal rows are one."""
    rows = docs.select(_row_key(named(key), _text_hash(text)).alias("k"), named(text).cast("string").alias("text"))
    return rows.join(chosen, F.col("k") == F.col("row_key")).groupBy("k", "vertex").agg(
        F.first("text").alias("text")).select("vertex", "text")


def _shared_blocks(texts: DataFrame, likeness: Likeness) -> DataFrame:
    """(block, vertex, members) of every block fingerprint that several rows have."""

    def batch(values: pa.Array) -> pa.Array:
        classes = _Classes(likeness)
        found = []
        for value in values:
            grams = shingles(value.as_py(), likeness.width)
            found.append(np.unique(block_prints(grams, classes)).view(np.int64) if len(grams) else None)
        return pa.array(found, pa.list_(pa.int64()))

    rows = texts.select("vertex", F.explode(F.arrow_udf(batch, "array<long>")("text")).alias("block")).select("block", "vertex")
    return rows.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("block"))).filter("members > 1")


def _candidates(shared: DataFrame, vertices: DataFrame, likeness: Likeness) -> DataFrame:
    """Links (a, b) of a spanning forest of what the bitmaps cannot rule out, within each block that rows share."""
    full = shared.join(vertices.select("vertex", "size", "bits"), "vertex")
    spread = tiled(full, "vertex", "members").select("block", "tile_a", "tile_b", "vertex", "size", "bits")

    def load(table: pa.Table) -> dict:
        return {"v": table.column("vertex").to_numpy(), "n": table.column("size").to_numpy(),
                "bits": table.column("bits").to_pylist()}

    ratio = (likeness.whole - likeness.part, likeness.whole + likeness.part)

    def work(c: dict, start: int, end: int) -> list:
        v, n, bits = c["v"][start:end], c["n"][start:end], same_width(c["bits"][start:end])

        def near(x: int, others: np.ndarray) -> np.ndarray:
            apart = np.bitwise_count(bits[others] ^ bits[x]).sum(axis=1, dtype=np.int64)
            return apart * ratio[1] <= ratio[0] * (n[others] + n[x])

        a, b = forest(end - start, near)
        return [v[a].tolist(), v[b].tolist()] if a else [[], []]

    return by_group(spread, ["block", "tile_a", "tile_b"], work, load, "a long, b long", ["a", "b"])


def _products(members: DataFrame, likeness: Likeness) -> DataFrame:
    """Links (a, b) of a spanning forest of the exact join inside each candidate group (columns root, vertex, grams)."""
    volume = members.groupBy("root").agg(F.sum(F.octet_length("grams") / 8).alias("volume"))
    spread = tiled(members.join(volume, "root"), "vertex", "volume", TILE_SHINGLES)

    def load(table: pa.Table) -> dict:
        return {"v": table.column("vertex").to_numpy(), "grams": table.column("grams")}

    def work(c: dict, start: int, end: int) -> list:
        v = c["v"][start:end]
        rows = [np.frombuffer(g.as_py(), np.uint64) for g in c["grams"].slice(start, end - start)]
        sizes = np.array(list(map(len, rows)), np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        columns, column_of = np.unique(np.concatenate(rows), return_inverse=True)
        order = np.argsort(column_of, kind="stable")
        posting, first = owner[order], np.searchsorted(column_of[order], np.arange(len(columns) + 1))
        own = np.concatenate([[0], np.cumsum(sizes)])

        def near(x: int, others: np.ndarray) -> np.ndarray:
            mine = column_of[own[x]:own[x + 1]]
            begin, count = first[mine], first[mine + 1] - first[mine]
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            overlap = np.bincount(posting[at], minlength=len(rows))[others]
            return likeness.whole * overlap >= likeness.part * (sizes[others] + sizes[x] - overlap)

        a, b = forest(len(rows), near)
        return [v[a].tolist(), v[b].tolist()] if a else [[], []]

    return by_group(spread.select("root", "tile_a", "tile_b", "vertex", "grams"), ["root", "tile_a", "tile_b"], work,
                    load, "a long, b long", ["a", "b"])


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", likeness: Likeness = Likeness()) -> DataFrame:
    """(key, n_shingles, class_id, mark, class_key, text_hash) of every row of ``docs``.

    Equal marks are equal sets; class_key numbers the classes within this result (null for empty sets) and tells those
    apart that share their least id because ids repeat.
    """
    rows = written(profiles(docs, key, text, likeness), "profiles")
    stands = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))  # a row with an id where there is one
    sets = rows.filter("mark IS NOT NULL").groupBy("mark").agg(
        stands.alias("row"), F.max("size").alias("size"), F.max("bits").alias("bits"))
    vertices = written(sets.select("mark", F.col("row.id").alias("least"), "size", "bits", F.monotonically_increasing_id().alias(
        "vertex"), _row_key(F.col("row.id"), F.col("row.text_hash")).alias("row_key")), "sets")
    shared = written(_shared_blocks(_texts(docs, key, text, vertices.select("vertex", "row_key")), likeness), "shared")

    # Most blocks are shared inside one group. A sixteenth of them finds most groups; of the others only those that
    # hold rows of several groups are left to look at, so the bitmaps do not travel once for every block.
    some = F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0
    early = written(_candidates(shared.filter(some), vertices, likeness), "early")
    grouped = components(early).withColumnRenamed("vertex", "v")
    rest = written(shared.filter(~some).join(grouped, F.col("vertex") == F.col("v"), "left").select(
        "block", "vertex", "members", F.coalesce("root", "vertex").alias("root")), "rest")
    mixed = written(rest.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter(
        "low <> high").select(F.col("block").alias("open")), "open")
    late = written(_candidates(rest.join(mixed, F.col("block") == F.col("open"), "left_semi"), vertices, likeness), "late")
    maybe = components(early.unionByName(late))

    wanted = written(maybe.join(vertices, "vertex").select("root", "vertex", "row_key"), "wanted")

    def gather(values: pa.Array) -> pa.Array:
        return pa.array([shingles(v.as_py(), likeness.width).tobytes() for v in values], pa.binary())

    texts = _texts(docs, key, text, wanted.select("vertex", "row_key"))
    again = texts.select("vertex", F.arrow_udf(gather, "binary")("text").alias("grams"))
    members = written(again.join(wanted.select("vertex", "root"), "vertex"), "members")
    sure = components(_products(members, likeness))

    least = vertices.select("vertex", "least", "mark").join(sure, "vertex", "left")
    found = written(least.select("mark", "least", F.coalesce("root", "vertex").alias("root")), "classes")
    class_ids = found.groupBy("root").agg(F.min("least").alias("class_id"))
    named_classes = written(found.join(class_ids, "root").select(F.col("mark").alias("m"), "class_id", F.col("root").alias("class_key")), "named")
    return rows.select("id", "size", "mark", "text_hash").join(named_classes, F.col("mark") == F.col("m"), "left").select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"), "mark",
        "class_key", "text_hash")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", likeness: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` of which one stays for each class: that with the least id, then the least hash of its text.

    Rows without words stay, each of them; of rows that are equal in id and text one stays.
    """
    found = written(join(docs.select(named(key), named(text)), key, text, likeness), "joined")
    least = F.struct(named(key).alias("id"), F.col("text_hash"))
    chosen = found.filter("class_key IS NOT NULL").filter(named(key).eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(
        F.min(least).alias("k")).select(F.col("k.id").alias("keep_id"), F.col("k.text_hash").alias("keep_hash"))
    hashed = free_name(docs.columns, "text_hash")
    rows = docs.withColumn(hashed, _text_hash(text))
    empty = F.coalesce(F.length(F.btrim(named(text).cast("string"), F.lit(SPACE))), F.lit(0)) == 0
    kept = rows.filter(~empty).join(written(chosen, "chosen"), (named(hashed) == F.col("keep_hash"))
                                    & named(key).eqNullSafe(F.col("keep_id")), "left_semi").dropDuplicates([key, hashed])
    return kept.unionByName(rows.filter(empty)).select(*[named(c) for c in docs.columns])
