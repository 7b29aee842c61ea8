"""Training-data pipeline over ``documents``: quality rules, near duplicates, decontamination, secrets, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of documents. Each result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.llm import quality, secrets
from duotower.llm.common import read_table, written
from duotower.llm.decontaminate import decontaminate
from duotower.llm.near_join import near_join
from duotower.llm.packing import pack

TOKENIZER = "word_bpe_49k.json"


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A written snapshot of the documents with a row number, under a name that no column has."""
    number = "_".join(["row", *docs.columns])
    return written(docs.withColumn(number, F.monotonically_increasing_id()), name), number


def _without(docs: DataFrame, number: str, rows: DataFrame) -> DataFrame:
    """The documents whose row number is not among ``rows`` (number); null fields keep their row."""
    gone = written(rows.select(F.col("number").alias(number)), "dropped")
    return docs.join(gone, number, "left_anti").drop(number)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that it rejects go."""
    judged = quality.judge(docs)
    verdict = judged.columns[-1]
    return judged.where(F.col(f"`{verdict}`")).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each class of near duplicates the document with the least doc_id stays (a null one last)."""
    rows, number = _numbered(docs, "near_stage")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(f"`{number}`").alias("number"))
    classes = near_join(rows.select(key.alias("key"), "text"), id_col="key")
    return _without(rows, number, classes.where("doc_id.number != class_id.number").select("doc_id.number"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark window go."""
    rows, number = _numbered(docs, "benchmark_stage")
    hits = decontaminate(rows, read_table(spark, sf_dir, "benchmark"), id_col=number)
    return _without(rows, number, hits.where(F.size("spans") > 0).select(F.col("doc_id").alias("number")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets are replaced by a mark; n_chars follows the text."""
    clean = secrets.redact_documents(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.col("n_chars").isNotNull() & F.col("text").contains("[SECRET]")
        clean = clean.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: all documents in windows of 4096 ids with the corpus' mixture of sources."""
    return pack(docs, TOKENIZER, end_id=2)


STAGES = [("quality_rules", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage), ("secrets", secret_stage),
          ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


#: Packing needs the tokenizer, which SQL does not have; tests compare every stage with a brute-force version.
ORACLE_SQL = None
