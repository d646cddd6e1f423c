"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed to cells of source, language and topic. Raking scales the cells until the sums by source, by language
and by topic have the target shares: each pass multiplies by target over sum, one dimension after the other, for a
stated number of passes. A document is drawn as often as its cell expects: the fitted weight per token, scaled to the
budget. With ``repeats`` that may be more than once, so the whole budget is drawn: the whole part as copies for certain, the
rest as a probability of one more. Without, the scale is the largest at which no document is expected more than once, if that is
less than the budget. Nothing is cut off either way, so the expected shares of what is drawn are the target shares. The draw is
a hash of id and text, so a repeated task draws the same and equal rows are drawn equally often.

Only cells are raked, but their number grows with the sources, so passes are DataFrame aggregations (combined on the map
side, joined to sums of one dimension); each pass is written, which keeps plans short.

Defined results: null or empty texts have no tokens and are kept with the probability of their cell; a null source,
language or topic is a value of its own; members without a target weigh nothing if targets are given; a cell without tokens has
weight 0 and probability 0; an empty table gives an empty one. Ids may repeat.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import SPACE, SPACE_CLASS, free_name, named, written

DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """Target shares are ``share ** flatten`` of the given ones, by source, language and topic; ``budget`` is the share
    of all tokens to draw, at most if without ``repeats``: the flatter the targets, the less can be drawn once.
    ``passes`` rounds of raking."""

    flatten: tuple[float, float, float] = (0.85, 0.85, 0.95)
    budget: float = 1.0
    passes: int = 10
    seed: str = "mix-1"
    repeats: bool = False


def tokens(text: Column) -> Column:
    """Words, as a stand-in for tokens that needs no vocabulary."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("long")


def topic_of(text: Column) -> Column:
    """The form of the text as a stand-in for a topic: tables, contacts and links, paragraphs, or prose."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return (F.when(whole.contains(" | "), "table").when(whole.rlike(r"@|https?://|\+\d"), "contact")
            .when(whole.contains("\n"), "paragraphs").otherwise("prose"))


def unit_draw(seed: str, *columns: Column) -> Column:
    """A number from 0 up to 1 that depends on the columns only (32 bits of an MD5 digest)."""
    joined = F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def marginals(cells: DataFrame, mix: Mix) -> list[DataFrame]:
    """Target shares (member, target) of every dimension: shares of all tokens, flattened."""
    found = []
    for dim, power in zip(DIMENSIONS, mix.flatten, strict=True):
        sums = cells.groupBy(dim).agg(F.sum("n").alias("n")).filter("n > 0").select(
            F.col(dim).alias("member"), F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))
        total = sums.agg(F.sum("weight")).first()[0] or 1.0
        found.append(written(sums.select("member", (F.col("weight") / total).alias("target")), f"target-{dim}"))
    return found


def rake(cells: DataFrame, targets: list[DataFrame], mix: Mix) -> DataFrame:
    """``cells`` (source, lang, topic, n) and ``weight``: fitted share of tokens, summing to about one."""
    total = cells.agg(F.sum("n")).first()[0] or 1
    fitted = cells.withColumn("weight", F.col("n") / F.lit(float(total)))
    for number in range(mix.passes):
        for dim, target in zip(DIMENSIONS, targets, strict=True):
            sums = fitted.groupBy(F.col(dim).alias("d")).agg(F.sum("weight").alias("now"))
            factor = sums.join(target, F.col("d").eqNullSafe(F.col("member")), "left").select(
                "d", F.when(F.col("now") > 0, F.coalesce("target", F.lit(0.0)) / F.col("now")).otherwise(0.0).alias("factor"))
            fitted = fitted.join(factor, F.col(dim).eqNullSafe(F.col("d")), "left").select(
                *DIMENSIONS, "n", (F.col("weight") * F.coalesce("factor", F.lit(0.0))).alias("weight"))
            # every step reads the one before twice: unwritten, three of them are eight reads and one large plan
            fitted = written(fitted, f"raked{number}-{dim}")
    return fitted


def probabilities(fitted: DataFrame, mix: Mix) -> DataFrame:
    """``fitted``, ``expected`` copies of a document of the cell, in proportion to the fitted weight of a token, and its
    ``probability`` of being drawn at all."""
    rate = fitted.withColumn("rate", F.when(F.col("n") > 0, F.col("weight") / F.col("n")).otherwise(0.0))
    found = rate.agg(F.sum("n").alias("total"), F.max("rate").alias("most")).first()
    scale = mix.budget * float(found["total"] or 0)
    if not mix.repeats:
        scale = min(scale, 1 / found["most"] if found["most"] else 0.0)
    # without repeats the fullest cell may come out at 1 + 2^-52
    expected = F.col("rate") * F.lit(scale) if mix.repeats else F.least(F.lit(1.0), F.col("rate") * F.lit(scale))
    return rate.withColumn("expected", expected).withColumn("probability", F.least(F.lit(1.0), "expected")).drop("rate")


def residuals(mixed: DataFrame, targets: list[DataFrame], out: str = "mixed", source: str = "source",
              lang: str = "lang") -> DataFrame:
    """(dimension, member, target, expected, drawn) shares of tokens of what ``drawn`` returned: the expected ones by the
    expected copies, the drawn ones by the draw."""
    rows = mixed.select(named(source).alias("source"), named(lang).alias("lang"), F.col(f"`{out}`.topic").alias("topic"),
                        F.col(f"`{out}`.n_tokens").alias("n"), F.col(f"`{out}`.expected").alias("e"),
                        F.col(f"`{out}`.copies").alias("copies"))
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum(F.col("n") * F.col("e")).alias("expected"),
                                          F.sum(F.col("n") * F.col("copies")).alias("drawn"))
    cells = written(cells, "expected")
    all_of = cells.agg(F.sum("expected").alias("expected"), F.sum("drawn").alias("drawn")).first()
    parts = []
    for dim, target in zip(DIMENSIONS, targets, strict=True):
        sums = cells.groupBy(F.col(dim).alias("d")).agg(*[
            (F.sum(c) / F.lit(float(all_of[c] or 1))).alias(c) for c in ("expected", "drawn")])
        joined = target.join(sums, F.col("member").eqNullSafe(F.col("d")), "left")
        parts.append(joined.select(F.lit(dim).alias("dimension"), F.col("member").cast("string"), "target",
                                   *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("expected", "drawn")]))
    return reduce(DataFrame.unionByName, parts)


def _cells(docs: DataFrame, text: str, source: str, lang: str, topic: Column) -> DataFrame:
    rows = docs.select(named(source).alias("source"), named(lang).alias("lang"), topic.alias("topic"),
                       tokens(named(text)).alias("n_tokens"))
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n"))


def drawn(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source",
          lang: str = "lang", topic: Column | None = None, targets: list[DataFrame] | None = None,
          out: str = "mixed") -> DataFrame:
    """``docs`` and a struct ``out``: topic, n_tokens, weight (of one token, 1 as it is), probability of being drawn,
    sampled, expected copies, copies.

    ``targets``: (member, target share) for source, language and topic; by default the flattened shares of ``docs``.
    """
    out = free_name(docs.columns, out)
    topic = topic_of(named(text)) if topic is None else topic
    cells = written(_cells(docs, text, source, lang, topic), "cells")
    fitted = rake(cells, marginals(cells, mix) if targets is None else targets, mix)
    total = float(cells.agg(F.sum("n")).first()[0] or 1)
    final = written(probabilities(fitted, mix), "probabilities").select(
        F.struct("source", "lang", "topic").alias("cell"), (F.when(F.col("n") > 0, F.col("weight") * total / F.col("n"))
                                                            .otherwise(0.0)).alias("weight"), "probability", "expected")
    flat = final.select(F.col("cell.source").alias("s"), F.col("cell.lang").alias("l"), F.col("cell.topic").alias("t"),
                        "weight", "probability", "expected")
    shown = free_name([*docs.columns, out], "topic_of_text")
    rows = docs.withColumn(shown, topic).alias("d")
    col = lambda name: F.col("d.`" + name.replace("`", "``") + "`")
    joined = rows.join(flat.alias("c"), col(source).eqNullSafe(F.col("c.s")) & col(lang).eqNullSafe(F.col("c.l"))
                       & col(shown).eqNullSafe(F.col("c.t")), "left")
    draw, expected = unit_draw(mix.seed, col(key), col(text)), F.col("c.expected")
    copies = F.floor(expected) + F.when(draw < expected - F.floor(expected), 1).otherwise(0)
    return joined.select(*[col(c) for c in docs.columns], F.struct(
        col(shown).alias("topic"), tokens(col(text)).alias("n_tokens"), F.col("c.weight").alias("weight"),
        F.col("c.probability").alias("probability"), (draw < F.col("c.probability")).alias("sampled"), expected.alias("expected"),
        copies.cast("long").alias("copies")).alias(out))


def sample(docs: DataFrame, mix: Mix = Mix(), **columns) -> DataFrame:
    """The rows of ``docs`` that are drawn, each as often as it is, with their own columns."""
    out = free_name(docs.columns, "mixed")
    rows = drawn(docs, mix, out=out, **columns).filter(F.col(f"`{out}`.sampled"))
    if mix.repeats:
        times = F.explode(F.array_repeat(F.lit(0), F.col(f"`{out}`.copies").cast("int")))
        rows = rows.withColumn(free_name(rows.columns, "time"), times)
    return rows.select(*[named(c) for c in docs.columns])
