"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm import quality_rules as quality
from tablesift.llm.ctw import score
from tablesift.llm.edit_counts import scrubbed_counts
from tablesift.llm.exact_dedup import exact_dedup
from tablesift.llm.license_scan import license_digest, license_scan
from tablesift.llm.lz_dedup import duplicate_spans
from tablesift.llm.mixing import drawn, mix
from tablesift.llm.ngram_join import similar_classes
from tablesift.llm.order_minhash import near_classes
from tablesift.llm.packing import pack_documents
from tablesift.llm.periodic_runs import periodic_runs
from tablesift.llm.rlbwt_dedup import duplicate_bytes
from tablesift.llm.spelling import letter_runs, variants


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def label_domain() -> Column:
    """Domain of a labelled document: toxic, or its quality."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


# Shares of the tokens that each domain is to have.
DOMAIN_TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, domains = mix(documents(spark, sf_dir), labels, label_domain(), DOMAIN_TARGETS)
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.col("__n").alias("n_tokens"),
        *[F.round(F.element_at("__posterior", k + 1), 9).alias(f"p_{d}") for k, d in enumerate(domains)],
        F.round("__rate", 9).alias("rate"),
        drawn(F.col("__id"), F.col("__rate")).alias("copies"),
    )


def op2_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scored = score(documents(spark, sf_dir), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op4_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_spans(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op6_rlbwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_bytes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scrubbed_counts(documents(spark, sf_dir))
    return counts.withColumn("text_after_sha256", F.sha2("text_after", 256)).drop("text_after")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(license_scan(documents(spark, sf_dir)))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir)).drop("node")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rules", "n_stop_words", "n_lines",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text (by the checksum of its id) is periodic from one of its words on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", h)
    # words are made for the texts to change only
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("a", F.when(n > 0, g % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("p").isNull(), F.col("text")).otherwise(planted).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    key = lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_min(F.transform("runs", key))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    return found.select(
        "doc_id", "n_words", "n_runs",
        F.col("b.start").alias("start"), (-F.col("b.short")).alias("length"), F.col("b.period").alias("period"),
        F.floor(-1000 * F.col("b.short") / F.col("b.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(documents(spark, sf_dir))


def with_planted_misspellings(runs: DataFrame) -> DataFrame:
    """``word`` of each row, without one of its code points in about one of 97 of the pairs of id and word."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
    rows = runs.select("word", h.alias("h"))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return rows.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("word")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(with_planted_misspellings(letter_runs(documents(spark, sf_dir))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_ctw": op2_ctw,
        "op3_packing": op3_packing,
        "op4_lz_dedup": op4_lz_dedup,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_rlbwt_dedup": op6_rlbwt_dedup,
        "op7_edit_counts": op7_edit_counts,
        "op8_license_scan": op8_license_scan,
        "op9_order_minhash": op9_order_minhash,
        "op10_quality_rules": op10_quality_rules,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_ngram_join": op12_ngram_join,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    from tablesift.llm import oracle

    return oracle.ORACLES
