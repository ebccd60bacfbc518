"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import bottomk, cube, licenses, llr, neardup, pii, prefix_trie, quality, spelling, substring, viterbi, warc, wavelet

WORD_BPE, WORD_BPE_SIZE = "word_bpe_49k.json", 49408
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers of a local session find this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bytenet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_index(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return wavelet.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), WORD_BPE_SIZE)


def op4_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return llr.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.fingerprints(table(spark, sf_dir, "documents"))


def op6_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return viterbi.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(corpus_pipeline.PIECES), ["doc_id"])


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op9_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.mix(table(spark, sf_dir, "documents"))


def op10_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_euler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "documents")
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bytenet": op1_bytenet,
        "op2_warc": op2_warc,
        "op3_wavelet": op3_wavelet,
        "op4_llr": op4_llr,
        "op5_bottomk": op5_bottomk,
        "op6_viterbi": op6_viterbi,
        "op7_minhash": op7_minhash,
        "op8_debruijn": op8_debruijn,
        "op9_cube": op9_cube,
        "op10_semicrf": op10_semicrf,
        "op11_euler": op11_euler,
        "op12_spelling": op12_spelling,
        "op13_licenses": op13_licenses,
        "pipeline": pipeline,
    }
