"""The registered queries opN_<name>: each operator over its whole table, as digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, collocations, gam, iblt, license_join, line_rules, lm, mixing, oracles, pii, repeats, simhash, vector_codes
from .common import table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_rules.judged(table(spark, sf_dir, "documents"))
            .select("doc_id", *line_rules.STATS, "base_failed", "kept", "words_left"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train(pii.labelled_table(spark))
    return pii.find(table(spark, sf_dir, "documents"), field)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.sample(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(table(spark, sf_dir, "documents")).drop("found")


def op9_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.with_probe(table(spark, sf_dir, "conversations")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_gam": op2_gam,
    "op3_line_rules": op3_line_rules,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_mix": op6_mix,
    "op7_repeats": op7_repeats,
    "op8_licenses": op8_licenses,
    "op9_iblt": op9_iblt,
    "op10_lm": op10_lm,
    "op11_chat": op11_chat,
    "op12_collocations": op12_collocations,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op3_line_rules": oracles.LINE_RULES,
    "op7_repeats": oracles.REPEATS,
    "op8_licenses": oracles.licenses(),
    "op6_mix": oracles.MIX,
    "op11_chat": oracles.CHAT,
    "op12_collocations": oracles.COLLOCATIONS,
    "op13_vector_codes": oracles.vector_codes(),
}
