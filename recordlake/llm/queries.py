"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.alignment import align, count_links
from recordlake.llm.ann import nearest
from recordlake.llm.decontamination import decontaminate
from recordlake.llm.frames import written
from recordlake.llm.license_rules import scan_licenses
from recordlake.llm.lm_score import score_texts
from recordlake.llm.merkle import manifest
from recordlake.llm.packing import pack
from recordlake.llm.piece_sampling import sample_pieces
from recordlake.llm.pii import find_personal_data
from recordlake.llm.quality import judge_quality
from recordlake.llm.secret_scan import scan_secrets
from recordlake.llm.simhash import near_duplicates
from recordlake.llm.warc import pages_through_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.pmod("vec_id", F.lit(20)) == 0
    return nearest(table(spark, sf_dir, "embeddings"), is_query=asks)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_warc(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op10_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = manifest(
        table(spark, sf_dir, "documents"),
        tampered={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))},
        touched=F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
    )
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    stored = written(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return count_links(stored)


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_quality_rules,
        op3_personal_data,
        op4_arc_to_warc,
        op5_secret_scan,
        op6_simhash_near_dedup,
        op7_best_fit_packing,
        op8_license_scan,
        op9_lm_score,
        op10_piece_sampling,
        op11_merkle_manifest,
        op12_decontamination,
        op13_token_alignment,
    )
}
