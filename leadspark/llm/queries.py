"""Registered queries of this subpackage, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadspark.llm import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_substring_dedup", sql.SUBSTRING_DEDUP)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.substring_dedup import dedup_substrings

    kept = dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_suffix_tree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.suffix_tree import score_texts

    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query("op7_ngram_jaccard", sql.NGRAM_JACCARD)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.jaccard_join import similar_components

    return similar_components(table(spark, sf_dir, "documents"))


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.mixing import mix_sources, word_count
    from leadspark.session import keep

    # Counted once; the mix reads the counts several times.
    sizes = keep(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mix_sources(sizes).drop("source")


@query("op2_decontamination", sql.DECONTAMINATION)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.decontamination import decontaminate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.license_texts import LICENSE_TEXTS
    from leadspark.llm.licenses import scan_licenses

    known = spark.createDataFrame(list(LICENSE_TEXTS), "license_id string, text string")
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), known)
    return found.select("doc_id", "digest", F.array_join("license_ids", ",").alias("license_ids"), "licensed")


@query("op6_line_dedup", sql.LINE_DEDUP)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_warc", sql.WARC)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.warc import archive_pages

    records = archive_pages(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.toxicity import fit, score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), held_out)
    scored = score_toxicity(docs, model, held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_toxic")


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.quality import judge_quality, measured
    from leadspark.session import keep

    judged = judge_quality(keep(measured(table(spark, sf_dir, "documents").select("doc_id", "text"), text=False)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str, folder: str = "/opt/tokenizers") -> DataFrame:
    from leadspark.llm.alignment import align_tokenizers, read_files

    files = read_files(f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *files)[0]


@query("op12_exact_dedup", sql.EXACT_DEDUP)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.exact_dedup import dedup_exact

    return dedup_exact(table(spark, sf_dir, "documents"))


@query("op13_ranked_search", sql.RANKED_SEARCH)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadspark.llm.ranked_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
