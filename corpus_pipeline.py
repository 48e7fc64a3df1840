"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.catalogue import TOKENIZER_OF_PACKS, mixed, tokenizer, toxicity_model
from tillstream.llm.common import kept_safe, or_empty, small_side, table, unused
from tillstream.llm.lines import without_duplicate_lines
from tillstream.llm.pack import pack
from tillstream.llm.simhash import simhash_groups
from tillstream.llm.toxic import toxicity
from tillstream.workspace import fresh_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, their columns unchanged."""
    score, predicted = unused(docs, "score"), unused(docs, "predicted")
    scored = toxicity(docs, toxicity_model(spark, sf_dir, docs), added=(score, predicted))
    return scored.filter(F.col(predicted) == 0).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of similar lines only the first one stays. ``n_chars`` is
    counted anew where the text changed."""
    cleaned = without_duplicate_lines(docs, shortest=1)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, its columns unchanged; of rows equal in id
    and text one stays."""
    mark = unused(docs, "_mark")
    groups = kept_safe(simhash_groups(docs).select("doc_id", "mark", "kept"))
    gone = groups.filter("not kept").select(F.col("doc_id").alias("_id"), "mark").distinct()
    again = groups.filter("kept").groupBy(F.col("doc_id").alias("_id"), "mark").count()
    again = kept_safe(again.filter("count > 1").drop("count"))
    gone = kept_safe(gone)
    named = docs.withColumn(mark, F.xxhash64(or_empty(F.col("text"))))

    def same(other: DataFrame):
        return named["doc_id"].eqNullSafe(other["_id"]) & (named[mark] == other["mark"])

    n_again = again.count()
    left = named.join(small_side(gone, gone.count()), same(gone), "left_anti")
    if n_again:
        few = small_side(again, n_again)
        once = left.join(few, same(again), "left_semi").dropDuplicates(["doc_id", mark])
        left = left.join(few, same(again), "left_anti").union(once)
    return left.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is due in several epochs is there as often."""
    added = unused(docs, "tokens"), unused(docs, "epoch")
    return mixed(docs, added).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return pack(docs, tokenizer(TOKENIZER_OF_PACKS), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("mixing", mix),
    ("packing", pack_sequences),
]

# Language models, fingerprints and token ids are beyond SQL; tests/llm holds the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        place = fresh_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
