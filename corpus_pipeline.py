"""Cleaning a training corpus: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps
with the same columns (the last one: the encoded documents). ``run`` writes
each stage's result as Parquet to the shared folder and reads it again, so a
stage never recomputes an earlier one and a lost executor costs its tasks only.
The folder (``pipeline-*`` below ``spark.checkpoint.dir``) holds what the
result is read from, and is removed by its owner when the session has ended;
a stage's copy goes as soon as the next one has been written.

Special cases, in all stages: a null text counts as empty and stays null where
it is kept; very long texts are handled whole; a null id is an id like any
other; repeated rows are documents of their own until the near-dedup stage,
which keeps one of them; ties are decided by the smallest id and then the
smallest fingerprint; an empty table gives an empty result with the same
columns; extra columns pass through the first four stages unread, whatever
their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, quality, secrets, simhash, tokenize
from starloom.llm.common import table
from starloom.llm.queries import PIECE_MODEL, model_path
from starloom.session import checkpoint_dir
from starloom.sources.versions import delete


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents with a score under its threshold go. Null and
    empty texts are scored like others; without labels nothing is rejected."""
    return quality.accept(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4-word shingles, 4 bits): one document of each group
    stays, that of the smallest id; texts without words are one group."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: spans that hold 10-word windows of an item are
    cut out, again until none is left; items without words cut nothing."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: every secret found is masked, by a ledger of this run's texts; null stays null."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids of each document, and the digests of ids and decoded
    text; null and empty texts have the end id only."""
    encoded = tokenize.encode_documents(docs, model_path(PIECE_MODEL), keep=("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", "ids", *tokenize.digest_columns())


STAGES = [
    ("quality", keep_good),
    ("simhash", keep_first),
    ("decontaminate", cut_benchmark),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: A fitted classifier, fingerprints and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; the last one's result."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
