"""The training-data queries: one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm.chat_trees import CHAT_SQL, chat_report
from headwater.llm.common import table
from headwater.llm.cover_topk import TOPK_SQL, topk_report
from headwater.llm.decontam import leak_report
from headwater.llm.exact_digest import digest_report
from headwater.llm.hash_shards import shard_report, shard_sql
from headwater.llm.license_scan import license_report
from headwater.llm.merkle import MERKLE_SQL, merkle_report
from headwater.llm.periodic_runs import runs_report
from headwater.llm.piece_nbest import piece_report
from headwater.llm.quality_knn import quality_report
from headwater.llm.recompress import SUBSTRING_SQL, substring_report
from headwater.llm.secret_scan import secret_report
from headwater.llm.simhash_dedup import simhash_report

#: Byte limit of a shard in the query.
SHARD_BYTES = 1 << 20


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    roles = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), roles).withColumn("text", said)
    return chat_report(c.unionByName(probe.withColumn("turn", F.col("turn").cast("long"))))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op6_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op7_cover_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_report(table(spark, sf_dir, "embeddings"))


def op8_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"))


def op9_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_exact_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_report(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_report(table(spark, sf_dir, "documents"))


def queries() -> dict:
    ops = (
        op1_license_scan,
        op2_quality_knn,
        op3_simhash_dedup,
        op4_chat_trees,
        op5_secret_scan,
        op6_hash_shards,
        op7_cover_topk,
        op8_piece_nbest,
        op9_recompress,
        op10_decontam,
        op11_exact_digest,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_trees": CHAT_SQL, "op6_hash_shards": shard_sql(SHARD_BYTES), "op7_cover_topk": TOPK_SQL, "op9_recompress": SUBSTRING_SQL, "op12_merkle_manifest": MERKLE_SQL}
