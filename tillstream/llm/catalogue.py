"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import or_empty, table
from tillstream.llm.exact import exact_groups, normalised
from tillstream.llm.lines import duplicate_lines
from tillstream.llm.middle import fill_in_middle, restored
from tillstream.llm.mix import mix_sources
from tillstream.llm.neighbours import near_vectors
from tillstream.llm.pack import pack
from tillstream.llm.prefixes import bpe_decode, bpe_encode
from tillstream.llm.resample import importance_resample
from tillstream.llm.shards import shuffled_shards
from tillstream.llm.simhash import simhash_groups
from tillstream.llm.tokens import token_counts
from tillstream.llm.toxic import Model, fit, toxicity
from tillstream.llm.urls import judge_urls, labelled_urls

SHARDS = 40
TOKEN_LIMIT = 512
TOKENIZER_OF_PACKS = "word_bpe_49k.json"
TOKENIZER_OF_COUNTS = "byte_bpe_50k.json"
TOKENIZER_OF_CODES = "byte_bpe_multi_50k.tiktoken"

# The tree of sources: domain (sources by their number), language, source.
DOMAINS = {"": 1, "web": 5, "books": 3, "code": 2}
LANGUAGES = {"": 1, "en": 6, "de": 2, "fr": 2, "es": 2}
SOURCES = {"": 2, "src0": 3}
MIX_SHARE = (3, 5)
MIX_EPOCHS = 2


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def domain() -> Column:
    number = F.regexp_extract("source", r"^src(\d{1,9})$", 1).cast("int") % 3
    return (
        F.when(number == 0, "web").when(number == 1, "books").when(number == 2, "code")
    )


def source_tree() -> list[tuple[str, Column]]:
    return [("domain", domain()), ("lang", F.col("lang")), ("source", F.col("source"))]


def mixed(docs: DataFrame, added: tuple[str, str] = ("tokens", "epoch")) -> DataFrame:
    weights = [DOMAINS, LANGUAGES, SOURCES]
    return mix_sources(docs, source_tree(), weights, MIX_SHARE, MIX_EPOCHS, added=added)


def training_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels outside the held-out fifth."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return table(spark, folder, "labels").filter(fold != 0)


def toxicity_model(spark: SparkSession, folder: str, docs: DataFrame) -> Model:
    return fit(docs, training_labels(spark, folder))


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = shuffled_shards(table(spark, folder, "documents"), SHARDS)
    text = or_empty(F.col("text"))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents")).select(
        "doc_id", "lang", "source", "tokens", "epoch"
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(
        table(spark, folder, "documents"), tokenizer(TOKENIZER_OF_PACKS), with_ids=False
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(
        table(spark, folder, "documents"), tokenizer(TOKENIZER_OF_COUNTS), TOKEN_LIMIT
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = toxicity(docs, toxicity_model(spark, folder, docs))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_lines(table(spark, folder, "documents")).select(
        "doc_id", "pos", "line_id", "component_id", "kept"
    )


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    hashed = docs.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256))
    return exact_groups(hashed, carry=["text_sha256"])


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_urls(spark)).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return fill_in_middle(table(spark, folder, "documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op13_bpe_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer(TOKENIZER_OF_CODES)
    coded = bpe_decode(bpe_encode(table(spark, folder, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_mixing,
        op3_simhash,
        op4_packing,
        op5_token_counts,
        op6_toxicity,
        op7_embedding_dedup,
        op8_line_dedup,
        op9_exact_dedup,
        op10_url_filter,
        op11_resampling,
        op12_fill_in_middle,
        op13_bpe_codes,
    )
}
