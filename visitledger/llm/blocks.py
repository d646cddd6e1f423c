"""Groups of rows worked on inside tasks: sorted groups over Arrow batches, tiles of hot groups, forests of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import free_name, named

#: Members of a group that meet in one task; larger groups are cut into tiles of this size that meet pairwise.
TILE = 2048


def tiled(rows: DataFrame, member: str, size: str, tile: int = TILE) -> DataFrame:
    """``rows`` with columns tile_own, tile_a, tile_b: a group of ``size`` members becomes pairs of tiles.

    Groups of up to ``tile`` members are the single pair (0, 0). Members of larger ones are dealt to tiles by hash and
    go to every pair of tiles that theirs is part of, so that each two members of the group meet in some task and no task
    holds more than about two tiles.
    """
    other = free_name(rows.columns, "tile_other")
    n = F.ceil(F.col(size) / F.lit(tile)).cast("int")
    spread = (rows.withColumn("tile_own", F.pmod(F.xxhash64(named(member), F.lit(17)), n).cast("int"))
              .withColumn(other, F.explode(F.sequence(F.lit(0), n - 1))))
    # a tile meets itself together with every other one, so of several tiles no pair of equal ones is needed
    return spread.filter((n == 1) | (F.col("tile_own") != named(other))).withColumns({
        "tile_a": F.least("tile_own", named(other)), "tile_b": F.greatest("tile_own", named(other))}).drop(other)


def by_group(df: DataFrame, keys: list[str], work: Callable[[dict, int, int], list], load: Callable[[pa.Table], dict],
             schema: str, names: list[str]) -> DataFrame:
    """``work(columns, start, end)`` on every run of equal ``keys``; it returns lists of output columns.

    Rows are dealt and sorted by the keys; a task sees its groups one after another and keeps at most one group and one
    Arrow batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def finished(table: pa.Table, last: bool):
            marks = np.zeros(table.num_rows, bool)
            marks[0] = True
            for key in keys:
                values = table.column(key).to_numpy()
                marks[1:] |= values[1:] != values[:-1]
            bounds = np.append(np.flatnonzero(marks), table.num_rows)
            upto = len(bounds) - 1 if last else len(bounds) - 2
            out: list[list] = [[] for _ in names]
            if upto > 0:
                columns = load(table.slice(0, bounds[upto]))
                for start, end in zip(bounds[:upto], bounds[1:upto + 1], strict=True):
                    for column, values in zip(out, work(columns, int(start), int(end)), strict=True):
                        column.extend(values)
            return out, table.slice(bounds[upto]) if not last else None

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None and rest.num_rows:
                table = pa.concat_tables([rest, table])
            out, rest = finished(table.combine_chunks(), False)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
        if rest is not None and rest.num_rows:
            out, _ = finished(rest.combine_chunks(), True)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)

    dealt = df.repartition(*[named(k) for k in keys]).sortWithinPartitions(*[named(k) for k in keys])
    return dealt.mapInArrow(run, schema)


def forest(n: int, linked_to: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of ``n`` members, where ``linked_to(x, others)`` marks which of ``others`` x links to.

    A member found once is never compared as a target again: a group in which all are alike costs one comparison each.
    """
    left = np.arange(n)
    sources: list[int] = []
    targets: list[int] = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = linked_to(x, left)
            if hit.any():
                found = left[hit].tolist()
                sources += [x] * len(found)
                targets += found
                queue += found
                left = left[~hit]
    return sources, targets
