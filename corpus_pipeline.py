"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage works on all rows that the one before kept, and all but the last
return the columns of its input. A document that loses all its text in a stage
that only cuts texts stays as an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm import best_fit_packing, line_frequency, ordinal_toxicity, probminhash, suffix_dedup
from loadkit.llm.shared import shared_dir


def _sized(docs: DataFrame) -> DataFrame:
    """`n_chars` as it is after the text changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents of a host hold, near copies counted once, are cut; documents that fail the base rule or keep too little go."""
    return _sized(line_frequency.clean(docs, line_frequency.Rules(near=True)))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is too high go."""
    model = ordinal_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = docs.columns
    judged = ordinal_toxicity.judge(docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), "text"), model, carry=("row",))
    return judged.where("kept").select(*[F.col("row").getField(n).alias(n) for n in names])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return probminhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur more than once are cut from every document."""
    names = docs.columns
    others = [n for n in names if n != "text"]
    given = docs.select("text", F.struct(*[F.col(f"`{n}`") for n in others]).alias("row"))
    cut = suffix_dedup.deduplicated(given, suffix_dedup.PASSAGES, carry=("row",))
    return _sized(cut.select(*[F.col("kept_text").alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in names]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        pieces = best_fit_packing.cut(docs, file.read(), end_id=0)
    return best_fit_packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
                                   ("repeated_passages", repeated_passages), ("packing", packing)]
#: No stage but the first two figures of quality can be said in SQL. tests/llm holds repeated_passages against plain Python, and quality
#: to near_duplicates on a planted group; there is no brute-force version of the whole run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
