"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import alignment, byte_bpe, chat, fingerprints, language, mixing, neighbours, ngram_join, packing, quality, repair, substrings, toxicity
from .common import documents


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(configure(spark), sf_dir), _labels(spark, sf_dir))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(configure(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(configure(spark), sf_dir), _labels(spark, sf_dir))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_report(documents(configure(spark), sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(configure(spark), sf_dir), keep_ids=False).drop("ids")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(documents(configure(spark), sf_dir), words=3, percent=90)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(configure(spark), sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(configure(spark), sf_dir))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.format_chat(chat.conversations(configure(spark), sf_dir)))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(configure(spark), sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(configure(spark), sf_dir), keep_groups=False).drop("groups")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = repair.damaged(configure(spark).read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.digests(repair.repair(turns, F.col("present")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(documents(configure(spark), sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_neighbours": op2_neighbours,
    "op3_quality": op3_quality,
    "op4_substrings": op4_substrings,
    "op5_packing": op5_packing,
    "op6_ngram_join": op6_ngram_join,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_chat": op9_chat,
    "op10_fingerprints": op10_fingerprints,
    "op11_alignment": op11_alignment,
    "op12_repair": op12_repair,
    "op13_byte_bpe": op13_byte_bpe,
}
SQL = {"op8_mixing": mixing.SQL, "op9_chat": chat.SQL}
