"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next one's documents. All but the last return the columns they got, extra ones of
whatever name included: documents travel as one struct wherever a stage adds columns of its own.
A stage's folder and the frames kept while it was made are dropped once the next one is written.

NULL texts count as empty; empty tables give empty results. Rows are told apart by id and text: rows that agree in
both are one document to the near-duplicate stage and go or stay together in the others, and each is as many copies
as the mix takes of it. Of documents that tie within a group of near-duplicates the least id stays, of equal ids the
least text hash; rows without an id stay only where their group has no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, mixing, queries, simhash, toxicity
from tessera.llm.common import release, releasing, saved, whole_rows


def _with_row(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of documents with (doc_id, text_hash) rows; a repeated id is told apart by its text."""
    wanted = rows.select(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_hash"))
    same = docs["doc_id"].eqNullSafe(wanted["row_id"]) & (F.xxhash64(docs["text"].cast("string")) == wanted["row_hash"])
    return docs.join(wanted, same, how)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    found = toxicity.toxicity(docs, queries.table(spark, sf_dir, "labels"))
    rejected = found.frame.filter("predicted = 1").select("doc_id", "text_hash").distinct()
    return _with_row(docs, rejected, "left_anti")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the least id
    (of equal ids the least text hash; rows without an id only in groups that have none).
    Rows that agree in id and text are one document."""
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    kept = simhash.simhash_groups(docs).groupBy("component_node").agg(F.min(row).alias("row"))
    # One set of keys for the join and for equal rows, so texts are shuffled once for both.
    keys = ["nameless", "own_id", "own_hash"]
    wanted = kept.select(F.col("row.nameless").alias(keys[0]), F.coalesce("row.doc_id", F.lit(0)).alias(keys[1]),
                         F.col("row.text_hash").alias(keys[2]))
    keyed = docs.select(whole_rows(docs).alias("document"), F.col("doc_id").isNull().alias(keys[0]),
                        F.coalesce("doc_id", F.lit(0)).alias(keys[1]), F.xxhash64(F.col("text").cast("string")).alias(keys[2]))
    return keyed.join(wanted, keys, "left_semi").dropDuplicates(keys).select("document.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontamination.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files; one row per document, read back from them."""
    return queries.token_digest(docs)


STAGES = [("toxicity", toxicity_stage), ("simhash_near_dedup", near_dedup_stage),
          ("benchmark_decontamination", decontamination_stage), ("mixing", mixing_stage), ("token_ids", token_stage)]

# Fitted models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with releasing() as made:
            done = saved(stage(spark, docs, sf_dir), f"stage-{name}")
            made.pop()  # the stage itself stays
        if name != STAGES[0][0]:
            release(docs)
        docs = done
    found = STAGES[-1][1](spark, docs, sf_dir)  # its files are written by now
    release(docs)
    return found
