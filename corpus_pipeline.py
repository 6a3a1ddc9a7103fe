"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets; ``run``
writes what a stage returns as Parquet and reads it back as the next one's docs.
All but the last return the columns of documents.

Defined results: rows with a null text are rejected as too short; documents are
matched by doc_id (null like any other) and text, so rows that share an id but
not a text are judged apart; of repeated rows one stays; an empty table passes
through; extra columns are carried along, also those that share a name with a
column of an operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import decontaminate, near_dedup, pieces, quality_model, quality_rules
from folioscope.llm.queries import table, vocabulary
from folioscope.llm.shared import marked, new_folder, stored

#: The classifier and the rest can't be said in SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def _apart(docs: DataFrame, key: Column, keys: DataFrame, of: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is surely not among the keys, all others): only the others need move to a join."""
    own = marked(docs, key, keys, of)
    return own.filter("NOT __may").select(docs.columns), own.filter("__may").select(docs.columns)


def _among(docs: DataFrame, keys: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """The rows surely not among ``keys`` (doc_id, text_hash, others), all other rows, the keys as stored, and when a row has a key."""
    own = keys.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"}).withColumn("__key", F.xxhash64("__id", "__hash"))
    own = stored(own, new_folder(docs.sparkSession, name), "rows")
    sure, others = _apart(docs, F.xxhash64("doc_id", F.xxhash64("text")), own, "__key")
    return sure, others, own, others["doc_id"].eqNullSafe(own["__id"]) & (F.xxhash64(others["text"]) == own["__hash"])


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't among ``rejected`` (doc_id, text_hash)."""
    sure, others, bad, same = _among(docs, rejected.select("doc_id", "text_hash").distinct(), "rejected")
    return sure.union(others.join(bad, same, "left_anti"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, which here is the id (null after all others) and the hash of the text, and text."""
    return docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("doc_id"), "text")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return _without(docs, quality_rules.judge(docs).filter("NOT kept"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go. It learns from the labelled raw documents."""
    model = quality_model.fit(quality_model.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return quality_model.keep(docs, model)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: one document of each group stays, that of the least doc_id (of one id's texts, that of the least hash)."""
    found = near_dedup.near_duplicates(_keyed(docs)).groupBy("doc_id").agg(F.bool_or("kept").alias("__kept"), F.count("*").alias("__n"))
    sure, others, special, same = _among(docs, found.filter("NOT __kept OR __n > 1").select("doc_id.doc_id", "doc_id.text_hash", "__kept"), "kept")
    return sure.union(others.join(special.filter("NOT __kept"), same, "left_anti").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    found = decontaminate.decontaminate(_keyed(docs), table(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    return _without(docs, found.select("doc_id.doc_id", "doc_id.text_hash"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: doc_id, ids, n_tokens and ids_crc32 of each document."""
    coded = pieces.encode(docs, vocabulary("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32")


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near dedup", dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    folder = new_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
