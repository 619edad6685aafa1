"""From raw documents to packed training sequences, one operator after the other.

Each stage takes the whole table that the stage before it kept, acts on its decisions, and gives back
the columns of ``documents``; the last one gives the packed pieces with their token ids.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.llm import packing, pii, repeats, rules, simhash
from pricebench.session import write_through

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """Put a new text in place, and its length where the table has one."""
    changed = docs.withColumn("text", text)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the weakly supervised rules find bad go; null and empty texts have no words and go too."""
    return rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest doc_id stays.

    Prints of three-word shingles link at three or fewer differing bits, as in ``op8_simhash``.
    """
    return simhash.keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that an earlier text has go; a text that is left empty goes with them."""
    cut = repeats.without_repeats(docs).select("row.*", F.col("cut.kept_text").alias("_kept"))
    return _with_text(cut.filter(F.length("_kept") > 0), F.col("_kept"), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return _with_text(pii.redacted(docs), F.col("text"), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their ids, packed into sequences."""
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.packed_documents(docs, *files)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("PII", personal_data),
    ("best-fit packing", packed),
]

# Tokens, suffixes and trees are beyond SQL; the tests hold run() against a chain in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
