"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.llm import license_scan, oracles, quality, secrets
from duotower.llm.common import read_table
from duotower.llm.conversation_repair import audit_conversations
from duotower.llm.decontaminate import decontaminate
from duotower.llm.html_text import extract_text
from duotower.llm.near_join import near_join
from duotower.llm.packing import pack
from duotower.llm.token_counts import token_counts
from duotower.llm.token_file import token_file_round_trip
from duotower.llm.url_filter import judge_urls
from duotower.llm.warc import warc_round_trip
from duotower.llm.whitening import whitened_rows

TOKENIZER = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document: doc_id, n_bytes, n_tokens, over_limit."""
    return token_counts(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    judged = quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), drop_text=True)
    return judged.select("doc_id", *[F.col("q_" + c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for a table of source files: documents under made-up paths, every tenth one named LICENSE."""
    d = read_table(spark, sf_dir, "documents")
    group, package = F.concat(F.lit("g"), F.floor(F.col("doc_id") / 1000)), F.concat(F.lit("p"), F.floor(F.col("doc_id") / 10))
    path = (F.when(F.col("doc_id") % 100 == 0, F.concat_ws("/", "source", group, F.lit("LICENSE")))
            .when(F.col("doc_id") % 10 == 0, F.concat_ws("/", "source", group, package, F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", "source", group, package, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))))
    return d.select("doc_id", path.alias("path"), "text")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every file, by its own notices or from the nearest licensed directory."""
    return license_scan.scan(source_files(spark, sf_dir))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return judge_urls(read_table(spark, sf_dir, "pages"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return near_join(read_table(spark, sf_dir, "documents"))


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as wavelet-matrix shards and read back: doc_id, start, n_tokens, ids_crc32."""
    back = token_file_round_trip(read_table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    hits = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in mixture-controlled windows of 4096 ids."""
    packed = pack(read_table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(read_table(spark, sf_dir, "pages"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secrets.span_text(F.col("spans"), ("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"), count("random"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding. A deviation beyond a long is null (the operator has it as a decimal)."""
    rows = whitened_rows(read_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least edits and repaired hash of every conversation after damage."""
    return audit_conversations(read_table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as dictionary-compressed WARC archives and read back."""
    back = warc_round_trip(read_table(spark, sf_dir, "pages"), payloads=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_quality_rules, op3_license_scan, op4_url_filters, op5_ngram_jaccard, op6_token_file,
                                    op7_decontamination, op8_packing, op9_html_text, op10_secret_scan, op11_embedding_whitening,
                                    op12_conversation_repair, op13_warc, pipeline)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
