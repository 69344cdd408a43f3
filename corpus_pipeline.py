"""A training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage returns a DataFrame over all rows that its predecessor kept. The first four filter or rewrite and return
the columns of ``documents``; the last one returns one encoded row per document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm.common import col, ensure_checkpoint_dir, spare, table
from headwater.llm.decontam import drop_leaks
from headwater.llm.piece_nbest import encode_nbest
from headwater.llm.quality_knn import fit, score_quality
from headwater.llm.secret_scan import redact
from headwater.llm.simhash_dedup import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier accepts."""
    space, score = fit(docs, table(spark, sf_dir, "labels")), spare(docs, "score")[0]
    return score_quality(docs, space, out=score).where(F.col(score) >= 0.5).select(*map(col, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose five-word shingle sets have a similarity of 0.8 or more."""
    return keep_one(docs, width=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; ``n_chars`` follows the new text."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation of every document, with the n best scores."""
    out = encode_nbest(docs, keep=["doc_id", "lang", "source"], kept_words=100_000)
    return out.select("doc_id", "lang", "source", "n_pieces", "ids", "ids_sha256", F.transform("paths", lambda p: p["score"]).alias("scores"), "decoded_equal")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("SentencePiece encoding", encoding),
]

#: Model scores, fingerprints and piece lattices have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
