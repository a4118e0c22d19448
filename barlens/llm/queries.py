"""One query per operator, over its whole table, with the columns of the query contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.llm import (
    contamination, html_text, line_dedup, manifest, near_duplicates, packing, quality_rules,
    ranked_search, secret_scan, substring_dedup, token_files, url_rules, warc,
)
from barlens.llm.common import with_file_rows
from barlens.session import stage, work_folder

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public vocabularies lie, on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    measured = stage(quality_rules.measured(docs).drop("text"), "measures")
    hosts = stage(quality_rules.host_verdicts(measured, "source"), "hosts")
    return quality_rules.judged(measured, hosts, "source").select(
        "doc_id", *quality_rules.MEASURES, "base_failed", "kept"
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_file_rows(table(spark, folder, "documents").select("doc_id", "text"), "row")
    return substring_dedup.remove_repeats(docs, row_column="row").drop("spans")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan_versions(docs, work_folder(spark, "ledger"))
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages)
    stated = F.when(F.col("rule_rank") == 1, F.col("rule"))
    return judged.select("page_id", "host", "path", stated.alias("rule"), "verdict")


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages)


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contamination.is_contaminated().alias("contaminated"),
    )


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = work_folder(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.read_archive(spark, archive, keep_payload=False).drop("url")


def op11_ranked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, folder, "documents"))
    return ranked_search.search(index, table(spark, folder, "benchmark"), k=50)


def op12_merkle_dataset_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    stored = [F.col(c) for c in manifest.FIELDS]
    # Documents whose id has an even checksum are tampered with: their line feeds go.
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(F.coalesce(even, F.lit(False)), F.translate("text", "\n", "")).otherwise(F.col("text"))
    tree = manifest.build_manifest(
        docs, manifest.leaf_digest(*stored), keep={"claimed": manifest.leaf_digest(*stored[:-1], text)}
    )
    requests = tree.leaves.select("tree", "idx", "doc_id", "leaf", "claimed")
    proofs = manifest.prove(tree, requests).select(
        "doc_id", "leaf", "subroot", F.lit(tree.root).alias("root"),
        manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        manifest.folded(F.col("path"), F.col("claimed")).alias("folded_root"),
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_binary_output(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), path, tokenizer_path())
    return token_files.token_checksums(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_rules,
        op3_substring_dedup,
        op4_line_dedup,
        op5_secret_scans,
        op6_url_filters,
        op7_html_extraction,
        op8_benchmark_decontamination,
        op9_warc,
        op10_ngram_jaccard_join,
        op11_ranked_lexical_search,
        op12_merkle_dataset_manifest,
        op13_token_binary_output,
    )
}
