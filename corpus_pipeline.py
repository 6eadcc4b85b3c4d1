"""The corpus pipeline: quality rules, near-duplicates, secrets, packing.

Every stage takes all rows its predecessor kept and works row by row or on whole
groups, so an empty table gives an empty table. Columns may have any names: rows
travel through the operators as one struct, so none is taken for a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.frames import written
from recordlake.llm.packing import pack
from recordlake.llm.quality import judge_quality
from recordlake.llm.secret_scan import redact, scan_secrets
from recordlake.llm.simhash import first_of_group


def as_rows(docs: DataFrame) -> DataFrame:
    """Each document whole as ``row``, beside its ``text``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep, unchanged.

    A null, empty or blank text has under 50 words, so it goes. Repeated rows
    are judged alike and stay repeated.
    """
    judged = judge_quality(as_rows(docs), keep=["row"]).where("kept")
    return judged.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash group (3-word shingles, within two bits) the document with the least id.

    Null, empty and blank texts are one group. A null id comes after all
    others; of rows that share the least id one stays, and so does one of
    repeated rows.
    """
    return first_of_group(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and n_chars made to fit.

    A null text stays null, and a text without secrets keeps its n_chars,
    right or not. Repeated rows stay repeated.
    """
    found = redact(scan_secrets(as_rows(docs), keep=["row", "text"]))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own = F.col("row").getField("n_chars")
        changed["n_chars"] = F.when(F.col("spans") == "", own).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)
        )
    return found.select(
        *[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document at its place in a training sequence.

    A null or empty text is its end token alone; null and repeated ids are
    packed row by row. Columns other than the id are not carried.
    """
    return pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("secrets", remove_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


# the tokenizer and zstandard's novelty cannot be written in SQL
ORACLE_SQL = None
