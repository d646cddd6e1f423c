"""From raw documents to token ids: quality rules, line dedup, one document of each near-copy group, mixing, encoding.

Every stage takes the documents that its predecessor kept, written as Parquet and read again. Rows may be null or empty
in any column, repeat, or carry further columns; each operator's module says what becomes of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitledger.llm import bpe, jaccard, lines, mixing, quality
from visitledger.llm.frames import SPACE, free_name, named, read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate, ``n_chars`` counted anew; what was boilerplate only is gone."""
    number = free_name(docs.columns, "n_removed")
    cut = lines.remove(docs, removed=number)
    if "n_chars" in docs.columns:
        counted = F.when(named(number) > 0, F.length("text").cast("long")).otherwise(named("n_chars"))
        cut = cut.withColumn("n_chars", counted)
    emptied = (named(number) > 0) & (F.btrim(F.col("text"), F.lit(SPACE)) == "")
    return cut.filter(~emptied).select(*[named(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more."""
    return jaccard.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the probabilities that fit the target marginals."""
    return mixing.sample(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids (little-endian unsigned 32-bit) and whether decoding gives the text back."""
    import public_tokenizers

    vocab = bpe.vocabulary(spark, public_tokenizers.path(VOCABULARY))
    rows = docs.select("doc_id", "source", "lang", "text")
    coded = bpe.encode(rows, vocab, public_tokenizers.PATTERN, out="tokens", decode=True)
    whole = F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "lang", "tokens.n_tokens", "tokens.ids",
                        (F.col("tokens.decoded") == whole).alias("decodes"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]
#: Byte-pair merging is not expressible in SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
