"""The registered queries of the training-data operators.

Each ``opN_`` query applies its operator, with production parameters, to its
whole table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, divergence, fim, html_text, mixing, neighbours, passages, quality, secrets, simhash,
               tokenize, toxicity)
from .common import table

#: Folder of the public vocabulary files; they are read, never copied.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECE_MODEL = "piece_bpe_32k.model"


def model_path(name: str) -> str:
    """Place of a vocabulary file (the installed package knows its own folder)."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(TOKENIZER_DIR, name)
    return public_tokenizers.path(name)


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.hit_digests(decontaminate.find_hits(docs, items))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_documents(table(spark, sf_dir, "documents")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.digests(simhash.near_duplicates(docs, shingle=4, max_bits=4))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenize.token_digests(tokenize.encode_documents(docs, model_path(PIECE_MODEL)))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(table(spark, sf_dir, "conversations"), spark)
    return chat.digests(chat.format_windows(turns))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_passages": op1_passages,
    "op2_decontaminate": op2_decontaminate,
    "op3_secrets": op3_secrets,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_html": op7_html,
    "op8_chat": op8_chat,
    "op9_neighbours": op9_neighbours,
    "op10_toxicity": op10_toxicity,
    "op11_divergence": op11_divergence,
    "op12_mixing": op12_mixing,
    "op13_fim": op13_fim,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op3_secrets": secrets.ORACLE,
    "op8_chat": chat.ORACLE,
    "op11_divergence": divergence.ORACLE,
    "op12_mixing": mixing.ORACLE,
    "op13_fim": fim.ORACLE,
}
