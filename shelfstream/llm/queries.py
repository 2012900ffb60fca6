"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.llm import (
    alignment, exact_dedup, html_text, language_id, neighbours, packing, periodic_runs, pieces, repeats, simhash, sketches,
    substring_dedup, suffix_dedup, wavelet,
)


def _table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    return spark.read.options(**options).parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    untouched, cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return untouched.drop("kept", "text_sha256").unionByName(cut.drop("kept", "text_sha256"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neighbours.usable(_table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(rows, rows.filter("vec_id % 100 = 0"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), carry=["doc_id"])


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(packing.byte_lengths(_table(spark, sf_dir, "documents")))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.filter(~F.col("held_out")))
    found = language_id.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "prediction.lang_pred", "prediction.score")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_windows(_table(spark, sf_dir, "documents", **repeats.READ_IN_PIECES)).drop("kept")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode_pieces(docs, _tokenizer("piece_bpe_32k.model"), decode=True)
    return found.select("doc_id", "pieces.n_tokens", "pieces.ids_sha256", F.sha2("pieces.decoded", 256).alias("decoded_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary"))).withColumn("w", F.expr(r"""
        CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"""))
    # From word a on, the p words there are repeated to the end.
    cut = (
        words.withColumn("g", F.expr("h DIV 10")).withColumn("n", F.size("w")).withColumn("a", F.expr("CAST(IF(n > 0, g % n, 0) AS INT)"))
        .withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    )
    echo = "array_join(slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT)))), 1, n), ' ')"
    echoed = cut.select("doc_id", F.expr(f"IF(n > 0, {echo}, text)").alias("text"))
    found = echoed.select("doc_id", periodic_runs.periodic_runs(F.col("text")).alias("f"))
    most = """array_sort(f.runs, (x, y) -> CASE
        WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
        WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1) ELSE CAST(sign(x.period - y.period) AS INT) END)"""
    return found.withColumn("best", F.expr(f"get({most}, 0)")).select(
        "doc_id", F.size("f.runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(f.runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256)").alias("runs_sha256"),
        F.sha2(F.col("f.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_in_order(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_nearest_neighbours, op3_exact_dedup, op4_token_files, op5_best_fit_packing, op6_simhash_dedup,
        op7_language_id, op8_substring_dedup, op9_html_text, op10_sentencepiece, op11_alignment, op12_periodic_runs, op13_fingerprints,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), ranked AS (
            SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM plain
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM ranked
    """,
}
