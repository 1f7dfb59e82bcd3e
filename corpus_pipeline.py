"""The corpus pipeline: language, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's rows as Parquet into the shared folder and reads them again as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.llm import decontam, langid, ngram_join, packing, secret_scan
from tierlake.llm.components import written
from tierlake.llm.queries import held_out, tokenizer_path
from tierlake.llm.shipping import ship
from tierlake.sources.tables import table_path


REST = "__rest"


def apart(docs):
    """The text, and all other columns as one struct: no name of theirs meets a column that a stage makes."""
    rest = [c for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*rest).alias(REST))


def together(stage, columns):
    """The columns as they were, the text as the stage left it."""
    return stage.select(*[F.col("text") if c == "text" else F.col(f"{REST}.`{c}`").alias(c) for c in columns])


def language_id(spark, docs, sf_dir):
    """Drops documents without a language (null texts, texts without a letter)."""
    ship(spark)
    labelled = docs.where(F.col("lang").isNotNull() & ~F.coalesce(held_out(), F.lit(False)))
    sample = langid.sample_texts(labelled, "doc_id", "text", "lang")
    known = langid.identify(apart(docs), sample).where(F.col("lang_pred") != langid.UNDETERMINED)
    return together(known, docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Keeps the row of smallest id of each group of near-duplicates; of repeated rows, one."""
    ship(spark)
    rows = written(spark, apart(docs).withColumn(
        "__row", F.struct(F.col(f"{REST}.doc_id"), F.monotonically_increasing_id().alias("n"))), "pipeline_rows")
    group = ngram_join.near_duplicates(spark, rows.select("__row", "text"), doc_id="__row")
    keep = group.where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("__keep"))
    return together(rows.join(keep, F.col("__row") == F.col("__keep"), "left_semi"), docs.columns)


def benchmark_decontamination(spark, docs, sf_dir):
    """Drops documents that hold a benchmark passage."""
    ship(spark)
    return decontam.remove_contaminated(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def secret_scans(spark, docs, sf_dir):
    """Blanks secrets out of the texts; no document goes."""
    ship(spark)
    found = secret_scan.find_secrets(spark, apart(docs), keep_text=True)
    clean = together(secret_scan.redact(found), docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def token_packing(spark, docs, sf_dir):
    """Pieces of training sequences of 1024 tokens."""
    ship(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"),
                        tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [("language_id", language_id), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("secret_scans", secret_scans),
          ("packing", token_packing)]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
