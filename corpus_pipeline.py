"""From raw documents to packed training sequences, each stage one operator.

Every stage gets all its predecessor kept, as columns of ``documents``; the last returns the packing plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.llm import exact_dedup, language_id, packing, repeats, simhash, suffix_dedup
from shelfstream.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5
#: Bytes of the shortest passage that is cut: 99 of 100 repeated passages of 50 words are longer, op1's 400 bytes miss 3 to 4 of 10.
PASSAGE_BYTES = 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: ``und`` and predictions less likely than not are rejected."""
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict(docs.select(*COLUMNS), model)
    accepted = (F.col("prediction.lang_pred") != language_id.UNKNOWN) & (F.col("prediction.score") >= LEAST_SCORE)
    return found.filter(accepted).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each text, once if its row repeats; equal texts differ in white space only."""
    kept = exact_dedup.exact_dedup(docs, carry=COLUMNS).filter("kept")
    once = kept.filter("group_size > 1").dropDuplicates(["doc_id", "text_sha256"])
    return kept.filter("group_size = 1").unionByName(once).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group whose SimHash fingerprints link at two or fewer bits."""
    kept = simhash.keep_one(docs.select(*COLUMNS))
    repeats.free_shuffles(spark)  # of the search, before whole texts are shuffled again
    return kept


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every string of ``PASSAGE_BYTES`` that occurs more than once, its first occurrence as well.

    Characters cut in two are dropped, and emptied documents stay.
    """
    docs = docs.select(*COLUMNS)
    repeats.free_shuffles(spark)  # of the stage before
    _, cut = suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES)
    changed = materialize(cut.filter("n_removed > 0").select(F.col("doc_id").alias("id"), "text_sha256", F.col("kept").alias("rest")), "cut-texts")
    repeats.free_shuffles(spark)  # the names' exchange, before whole texts are shuffled
    # Ids may repeat or be null, so a row is found by its id and text.
    changed = changed.dropDuplicates(["id", "text_sha256"])
    own = docs.withColumn("own_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_sha256") == F.col("text_sha256"))
    return (
        own.join(changed.hint("merge"), same, "left")
        .select("doc_id", F.coalesce("rest", "text").alias("text"), "lang", "source")
        .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(packing.byte_lengths(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", remove_repeated_passages),
    ("packing", pack_sequences),
]

# SQL cannot express the fingerprints and the packing; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
