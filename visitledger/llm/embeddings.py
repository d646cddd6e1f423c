"""Embedding near-duplicates by spherical-cap filters.

The unit vectors of one label are dealt to filter directions. A direction is the sum of one codeword from each half of a
random rotation (a structured random product code), so all directions within the cap around a vector are listed from two
sorted lists of products, without looking at the others. Vectors that share a filter meet, and their cosine in double
precision decides. A pair is counted in the smallest filter it shares, so nothing is listed twice and no pair leaves a task:
a task gives sums of links and a spanning forest.

The number of directions follows the largest label, so a filter holds about as many vectors at any size. Every vector lies
in at least ``LEAST`` filters. Equal vectors are one row with a count; filters of more than ``blocks.TILE`` vectors are
cut into tiles that meet pairwise. All vectors are indexed. The search is approximate: no pair below the threshold is
linked; at 0.98 and 64 dimensions a pair shares no filter about once in a thousand times (README).

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label,
link with nothing and are their own class; so do vectors of different length; repeated rows and ids share a class, whose
id is the smallest in it; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import by_group, forest, tiled
from .components import components
from .frames import named, written

#: Filters that a vector lies in on average and at least, and the seed of the code.
MEAN, LEAST, SEED = 20, 12, 20_240_607


class Code:
    """The directions for vectors of one length: ``words`` codewords for each half."""

    def __init__(self, dim: int, words: int):
        draw = np.random.default_rng([SEED, dim, words])
        self.turn = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
        self.half = max(1, dim // 2)
        self.words = words
        self.books = []
        for size in (self.half, dim - self.half):
            book = draw.standard_normal((words, size)) if size else np.zeros((words, 0))
            self.books.append(book / np.maximum(np.linalg.norm(book, axis=1, keepdims=True), 1e-300))
        self.reach = self._calibrated(draw.standard_normal((64, dim)))

    def _calibrated(self, trial: np.ndarray) -> float:
        """The product at which random vectors, not the data's, lie in ``MEAN`` caps on average."""
        turned = trial / np.linalg.norm(trial, axis=1, keepdims=True) @ self.turn
        first = turned[:, :self.half] @ self.books[0].T
        falling = np.sort(-(turned[:, self.half:] @ self.books[1].T), axis=1)
        low, high = -2.0, 2.0
        for _ in range(40):
            reach = (low + high) / 2
            count = sum(int(np.searchsorted(f, a - reach * math.sqrt(2), side="right").sum())
                        for a, f in zip(first, falling, strict=True))
            low, high = (reach, high) if count > MEAN * len(trial) else (low, reach)
        return high

    def filters(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each row the sorted numbers of all directions whose product with it reaches the cap."""
        turned = unit @ self.turn
        firsts, seconds = turned[:, :self.half] @ self.books[0].T, turned[:, self.half:] @ self.books[1].T
        found = []
        least = min(LEAST, self.words ** 2)
        for first, second in zip(firsts, seconds, strict=True):
            order = np.argsort(-second, kind="stable")
            falling = -second[order]
            reach = self.reach
            while True:
                count = np.searchsorted(falling, first - reach * math.sqrt(2), side="right")
                if count.sum() >= least:
                    break
                reach -= 0.02 * abs(self.reach) + 1e-4  # a vector that few caps reach widens them for itself
            rows = np.repeat(np.arange(self.words), count)
            rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.append(np.sort(rows * self.words + order[rank]))
        return found


@functools.lru_cache(maxsize=4)
def _code(dim: int, words: int) -> Code:
    return Code(dim, words)


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that no square is too large or too small."""
    rows = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _kind(rows: DataFrame, vector: str) -> str:
    """How components travel: floats as they are, all else as doubles."""
    element = getattr(rows.schema[vector].dataType, "elementType", None)
    return "<f4" if isinstance(element, T.FloatType) else "<f8"


def _marked(rows: DataFrame, key: str, vector: str, label: str, kind: str) -> DataFrame:
    """(id, mark, label, dim, vector): mark is the same for equal vectors of a label, null for what links with nothing."""

    def batch(vectors: pa.Array, labels: pa.Array) -> pa.Array:
        mark, dim, raw = [], [], []
        for value, name in zip(vectors, labels, strict=True):
            items = value.as_py() if name.is_valid else None
            good = bool(items) and None not in items
            array = np.array(items, np.float64) + 0.0 if good else None
            good = good and bool(np.isfinite(array).all()) and bool(array.any())
            mark.append(hashlib.blake2b(repr(name.as_py()).encode() + b"\0" + array.tobytes(), digest_size=16).digest()
                        if good else None)
            dim.append(len(items) if good else None)
            raw.append(array.astype(kind).tobytes() if good else None)
        return pa.StructArray.from_arrays(
            [pa.array(mark, pa.binary()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], ["mark", "dim", "vector"])

    run = F.arrow_udf(batch, "struct<mark:binary,dim:int,vector:binary>")
    return rows.select(named(key).alias("id"), named(label).alias("label"), run(named(vector), named(label)).alias("m")
                       ).select("id", "label", "m.*")


def _links(vertices: DataFrame, words: int, threshold: float, kind: str) -> DataFrame:
    """(a, b, links): a link of a spanning forest, or with null b a number of vectors linked to a."""

    def listed(vectors: pa.Array, dims: pa.Array) -> pa.Array:
        sizes = dims.to_numpy(zero_copy_only=False)
        out: list = [None] * len(sizes)
        raw = vectors.to_pylist()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            for part in np.array_split(at, max(1, len(at) * words // 4_000_000)):
                block = _units([raw[i] for i in part], kind)
                for i, found in zip(part, _code(int(dim), words).filters(block), strict=True):
                    out[i] = found
        return pa.array(out, pa.list_(pa.int64()))

    filters = written(vertices.withColumn("filters", F.arrow_udf(listed, "array<long>")("vector", "dim")), "filters")
    # filters with one vector go before vectors travel
    rows = filters.select(F.xxhash64("label", "dim").alias("part"), "dim", F.explode("filters").alias("filter"), "vertex")
    # counted where the rows are and joined back, so that a hot filter is no task's group
    at = ["part", "dim", "filter"]
    sizes = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(rows.join(sizes, at).select(*rows.columns, "members"), "shared")
    spread = tiled(shared, "vertex", "members").join(
        filters.select("vertex", "copies", "vector", "filters", F.col("label").cast("string").alias("label")), "vertex"
    ).select("part", "dim", "filter", "tile_a", "tile_b", "tile_own", "vertex", "copies", "vector", "filters", "label")

    def load(table: pa.Table) -> dict:
        return {"table": table, **{c: table.column(c).to_numpy() for c in (
            "vertex", "copies", "filter", "tile_own", "tile_a", "tile_b")}}

    def work(c: dict, start: int, end: int) -> list:
        rows = c["table"].slice(start, end - start)
        tile_a, tile_b = int(c["tile_a"][start]), int(c["tile_b"][start])
        unit = _units(rows.column("vector").to_pylist(), kind)
        alike = unit @ unit.T >= threshold
        names = np.array(rows.column("label").to_pylist(), object)
        if (names != names[0]).any():
            alike &= names[:, None] == names[None, :]
        np.fill_diagonal(alike, False)
        busy = np.flatnonzero(alike.any(axis=1))
        if not len(busy):
            return [[], [], []]
        alike = alike[np.ix_(busy, busy)]
        vertex, copies, own = (c[k][start:end][busy] for k in ("vertex", "copies", "tile_own"))
        sources, targets = forest(len(busy), lambda x, others: alike[x, others])
        # a pair counts here if it shares no smaller filter, and inside a tile only beside that tile's first partner
        lists = rows.column("filters").take(pa.array(busy)).to_pylist()
        now = int(c["filter"][start])
        smaller = np.array([f for one in lists for f in one if f < now], np.int64)
        member = np.repeat(np.arange(len(busy)), [sum(f < now for f in one) for one in lists])
        order = np.argsort(smaller, kind="stable")
        cuts = np.flatnonzero(np.diff(smaller[order])) + 1
        counted = alike.copy()
        for met in np.split(member[order], cuts):
            if len(met) > 1:
                counted[np.ix_(met, met)] = False
        if tile_a != tile_b:
            first = np.where(own == 0, 1, 0) == np.where(own == tile_a, tile_b, tile_a)
            counted &= (own[:, None] != own[None, :]) | first[:, None]
        links = counted @ copies.astype(np.float64)
        some = np.flatnonzero(links)
        return [vertex[sources].tolist() + vertex[some].tolist(), vertex[targets].tolist() + [None] * len(some),
                [0] * len(sources) + links[some].astype(np.int64).tolist()]

    return by_group(spread, ["part", "dim", "filter", "tile_a", "tile_b"], work, load, "a long, b long, links long",
                    ["a", "b", "links"])


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    kind = _kind(rows, vector)
    marked = written(_marked(rows, key, vector, label, kind), "vectors")
    valid = marked.filter("mark IS NOT NULL")
    vertices = written(valid.groupBy("mark").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("dim").alias("dim"), F.first("vector").alias("vector")).withColumn("vertex", F.monotonically_increasing_id()),
        "vertices")
    largest = vertices.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    found = written(_links(vertices, max(8, math.ceil(math.sqrt(largest))), threshold, kind), "found")
    sums = found.filter("b IS NULL").groupBy(F.col("a").alias("v")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    joined = vertices.select("vertex", "mark", "least", "copies").join(
        sums, F.col("vertex") == F.col("v"), "left").drop("v").join(roots, "vertex", "left")
    classes = written(joined.select("mark", "least", F.coalesce("root", "vertex").alias("root"),
                                    (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "classes")
    ids = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    final = written(classes.join(ids, "root").select(F.col("mark").alias("m"), "links", "class_id"), "final")
    return marked.select("id", "mark").join(final, F.col("mark") == F.col("m"), "left").select(
        F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("class_id", "id"), F.lit(False)).alias("kept"))
