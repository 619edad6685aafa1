"""The queries of the corpus operators, and SQL for those that SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.llm import (
    byte_pairs,
    classifier,
    html_text,
    minhash,
    packing,
    pieces,
    pii,
    repeats,
    rules,
    sharding,
    simhash,
    spelling,
    whitening,
)
from pricebench.llm.tables import table
from pricebench.session import write_through

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def token_files() -> tuple[str, str]:
    """The tokenizer that packing counts in, and its vocabulary as ranks."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("quality", 9).alias("quality"),
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_print("print").alias("fingerprint"), "component_id")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids are taken before packing, so that only narrow rows are ranked and joined."""
    cut = packing.tokenised_pieces(documents(spark, sf_dir), *token_files())
    digests = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(write_through(digests, "piece-digests"))


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.fingerprints_with_edits(documents(spark, sf_dir))
    return found.withColumns({c: minhash.hex_print(c) for c in ("fingerprint", "edited_fingerprint")})


@query
def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of operator 10: near copies from signature bands, verified by Jaccard similarity."""
    return minhash.near_duplicates(documents(spark, sf_dir))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classifier.scored(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", F.size("ids").alias("n_ids"), "ids", "round_trip"
    )


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return repeats.without_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("cut.n_bytes").alias("n_bytes"),
        (F.col("cut.n_bytes") - F.octet_length("cut.kept")).cast("long").alias("n_removed"),
        F.size("cut.removed").cast("long").alias("n_spans"),
        F.sha2("cut.kept", 256).alias("kept_sha256"),
    )


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found_spans(documents(spark, sf_dir))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.named("base").cast("binary"), 256).alias("base_sha256"),
        pii.named("spans").alias("spans"),
    )


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model = byte_pairs.library_model(ranks, public_tokenizers.PATTERN)
    found = byte_pairs.encoded(documents(spark, sf_dir), model, offsets=False)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_pairs.decoded(found, F.col("ids"), model), 256).alias("decoded_sha256"),
        "n_split",
    )


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(documents(spark, sf_dir)))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))
