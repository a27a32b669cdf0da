"""One query per operator, each over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import Scratch
from .ann import nearest
from .binpack import packed_fullest
from .bpe import encode_decode
from .chat import formatted, read_back
from .collocations import collocations
from .lines import line_classes
from .lm import language_scores
from .minhash import NearDuplicates, near_duplicates
from .packing import packed
from .quality import judged
from .repair import repaired
from .secrets import KINDS, listed, secret_spans
from .wordpiece import token_counts

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), NearDuplicates(shingle=4))


@query
def op2_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op3_partial_matching_scores(spark: SparkSession, folder: str) -> DataFrame:
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return language_scores(_table(spark, folder, "documents"), F.crc32(number) % 10 == 0)


@query
def op4_word_piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_concatenate_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = encode_decode(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    saying = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", saying), (-7, 1, "assistant", saying)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return read_back(Scratch(spark).keep(formatted(turns), "formatted"))


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_spans(_table(spark, folder, "documents"))
    sizes = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *sizes, F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"), listed(KINDS).alias("spans"))


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_classes(_table(spark, folder, "documents"))


@query
def op11_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_fullest(_table(spark, folder, "documents"), path, keep_ids=False).drop("ids")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: a row's number, by its checksum, says whether it goes, loses its text or marks, comes twice or
    turns into a user's."""
    said = turns.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    written = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    said = said.withColumn("fault", F.crc32(F.concat_ws(":", *written)) % 20).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return said.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


@query
def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    return repaired(damaged(turns), turns)


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"))
