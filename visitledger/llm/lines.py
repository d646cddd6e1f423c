"""Line dedup by distinct-site spread.

A line that stands on several sites in as many different texts is boilerplate; how many it takes depends on what the
line is. One of five words or more is no accident: three sites are enough. Shorter lines (headings, names, dates) come
about by themselves and need ten. Different texts count as well as sites, since copies of a whole document spread over
sites without any of its lines being boilerplate. Every line's hash gets a HyperLogLog sketch of its sites and one of its
texts; sketches are built where the rows are and merged by aggregation, so a line on a third of all rows is a few bytes
from each task. The estimates decide for lines clearly above or below the threshold; lines within the sketch's error of
it get exact distinct counts. Boilerplate lines are then cut out of the documents on all their sites; the document with
the least id keeps its own, so that no passage is lost altogether.

Defined results: a null text stays null, an empty one empty; blank lines are neither counted nor removed; a document of
boilerplate only becomes the empty text and stays; a null site is one site of its own; repeated rows stay repeated
and are cut alike; an empty table gives an empty one. Lines are compared without white space at their ends, by 64-bit
hashes. Line ends inside a text are kept as they are. A long text is an array of its lines in one row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import SPACE, SPACE_CLASS, free_name, named, written

#: Binary logarithm of the sketch's registers, and how many standard errors around the threshold are counted exactly.
LOG_REGISTERS, ERRORS = 10, 4.0
WORD = "[^" + SPACE_CLASS[1:] + "+"


@dataclass(frozen=True)
class Rule:
    """A line of ``words`` words or more is boilerplate from ``sites`` sites and texts on, another from ``short_sites``."""

    words: int = 5
    sites: int = 3
    short_sites: int = 10

    def wide(self, line: Column) -> Column:
        """Whether a line has that many words."""
        if self.words < 2:
            return F.lit(True)
        return line.rlike(f"({WORD}{SPACE_CLASS}+){{{self.words - 1}}}{WORD[:-1]}")

    @property
    def threshold(self) -> Column:
        return F.when(F.col("wide"), self.sites).otherwise(self.short_sites)


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(SPACE)))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text, F.octet_length(text))


def _lines(docs: DataFrame, text: str, site: str, rule: Rule) -> DataFrame:
    """(line, wide, site, body) of every line with a word: hashes of line, site and whole text."""
    whole = named(text).cast("string")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    entries = F.array_distinct(F.transform(lines, lambda x: F.struct(line_hash(x).alias("line"), rule.wide(x).alias("wide"))))
    site_hash = F.xxhash64(named(site), named(site).isNull())
    rows = docs.select(entries.alias("entries"), site_hash.alias("site"), text_hash(whole).alias("body"))
    return rows.select(F.inline("entries"), "site", "body")


def spread(docs: DataFrame, text: str = "text", site: str = "source", rule: Rule = Rule()) -> DataFrame:
    """(line, wide, sites, texts, exact) of every line near or above its threshold; counts are exact where ``exact`` is true."""
    error = ERRORS * 1.04 / math.sqrt(2 ** LOG_REGISTERS)
    rows = _lines(docs, text, site, rule)
    sketches = rows.groupBy("line", "wide").agg(*[
        F.hll_sketch_estimate(F.hll_sketch_agg(c, LOG_REGISTERS)).alias(n) for c, n in (("site", "sites"), ("body", "texts"))])
    least = F.least("sites", "texts")
    seen = written(sketches.filter(least >= rule.threshold * (1 - error) - 1), "spread")
    sure = least > rule.threshold * (1 + error) + 1
    near = seen.filter(~sure).select(F.col("line").alias("l"), F.col("wide").alias("w"))
    counted = rows.join(near, (F.col("line") == F.col("l")) & (F.col("wide") == F.col("w")), "left_semi").distinct().groupBy(
        "line", "wide").agg(F.count_distinct("site").alias("sites"), F.count_distinct("body").alias("texts"))
    return seen.filter(sure).withColumn("exact", F.lit(False)).unionByName(counted.withColumn("exact", F.lit(True)))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", rule: Rule = Rule()) -> DataFrame:
    """(line) hashes of the boilerplate lines."""
    return spread(docs, text, site, rule).filter(F.least("sites", "texts") >= rule.threshold).select("line")


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", rule: Rule = Rule(),
           removed: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``; on request a column ``removed`` with their number.

    A boilerplate line stays where (id, hash of the text) is least, in all rows that are equal there.
    """
    bad = written(boilerplate(docs, text, site, rule), "boilerplate").select(F.col("line").alias("bad"))
    mark = free_name(docs.columns, "mark")
    cuts = free_name([*docs.columns, mark], "cuts")
    lines = F.filter(F.split(named(text).cast("string"), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    marked = docs.withColumn(mark, text_hash(named(text).cast("string")))
    row = F.struct(named(key).alias("id"), named(mark).alias("mark"))
    of_row = marked.select(row.alias("row"), F.explode(F.array_distinct(F.transform(lines, line_hash))).alias("line"))
    hit = written(of_row.join(bad, F.col("line") == F.col("bad")).select("row", "line"), "hits")
    keeper = written(hit.groupBy("line").agg(F.min("row").alias("keeper")).withColumnRenamed("line", "l"), "keepers")
    gone = hit.join(keeper, F.col("line") == F.col("l")).filter(~F.col("row").eqNullSafe(F.col("keeper")))
    by_row = written(gone.groupBy("row").agg(F.collect_set("line").alias(cuts)).select(
        F.col("row.id").alias("cut_id"), F.col("row.mark").alias("cut_mark"), cuts), "cuts")
    left, right = marked.alias("d"), by_row.alias("c")
    col = lambda name: F.col("d.`" + name.replace("`", "``") + "`")
    joined = left.join(right, (col(mark) == F.col("c.cut_mark")) & col(key).eqNullSafe(F.col("c.cut_id")), "left")
    parts, gone_lines = F.split(col(text).cast("string"), "\n"), F.col(f"c.`{cuts}`")
    kept = F.filter(parts, lambda x: (F.btrim(x, F.lit(SPACE)) == "") | ~F.array_contains(gone_lines, line_hash(x)))
    cleaned = F.when(gone_lines.isNull(), col(text).cast("string")).otherwise(F.array_join(kept, "\n"))
    columns = [cleaned.alias(c) if c == text else col(c).alias(c) for c in docs.columns]
    if removed is not None:
        number = F.when(gone_lines.isNull(), 0).otherwise(F.size(parts) - F.size(kept)).cast("long")
        columns.append(number.alias(removed))
    return joined.select(*columns)
