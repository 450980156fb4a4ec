"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.llm import (
    bpe,
    htmltext,
    langid,
    maxsketch,
    neardup,
    neighbours,
    packing,
    pii,
    repetition,
    ruleensemble,
    toxicity,
    urlfilter,
    whitening,
)
from dimstar.llm.common import crc_mod, read


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op2_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.label(read(spark, sf_dir, "documents"))


def held_out(scored: DataFrame, divisor: int, remainder: int) -> DataFrame:
    """The column held_out after doc_id: whether its labels took no part in the training."""
    rest = [c for c in scored.columns if c != "doc_id"]
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), divisor) == remainder).alias("held_out"), *rest)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(langid.training_rows(docs))
    return held_out(langid.predict(docs, model), 4, 2)


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, toxicity.training_rows(labels))
    return held_out(toxicity.score(docs, model), 4, 2)


def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(read(spark, sf_dir, "documents")).drop("longest_repeat")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = ruleensemble.fit(docs, ruleensemble.training_rows(labels))
    return held_out(ruleensemble.score(docs, model), 5, 0)


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxsketch.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.detect(docs, pii.fit(docs))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_length_buckets": op2_length_buckets,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language": op5_language,
    "op6_url_rules": op6_url_rules,
    "op7_toxicity": op7_toxicity,
    "op8_repetition_rules": op8_repetition_rules,
    "op9_quality_rules": op9_quality_rules,
    "op10_nn_descent": op10_nn_descent,
    "op11_max_sketches": op11_max_sketches,
    "op12_whitening": op12_whitening,
    "op13_personal_data": op13_personal_data,
}

ORACLE: dict[str, str] = {
    "op4_near_duplicates": neardup.oracle_sql(),
    "op6_url_rules": urlfilter.oracle_sql(),
    "op8_repetition_rules": repetition.oracle_sql(),
    "op11_max_sketches": maxsketch.oracle_sql(),
}
