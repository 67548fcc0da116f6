"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import is_small
from ..session import checkpoint_dir

#: A-Z to a-z, every other byte unchanged (UTF-8 bytes of other letters stay).
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Characters one Arrow batch hands to Python at once, at most (one row may
#: exceed it): rows are re-cut by text size, not by number of rows.
BATCH_CHARS = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_batches(batches: Iterator[pa.RecordBatch], text: str, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Re-cut Arrow batches so that one holds a bounded amount of text."""
    for batch in batches:
        n = batch.num_rows
        size = batch.column(batch.schema.get_field_index(text)).nbytes
        step = max(1, int(n * chars / size)) if size > chars else max(n, 1)
        for at in range(0, n, step):
            yield batch.slice(at, step)


def by_text(df: DataFrame, make: Callable[[], Callable[[list], dict[str, pa.Array]]], schema: str,
            keep: list[str], text: str = "text", chars: int = BATCH_CHARS) -> DataFrame:
    """Apply a per-task function of lists of texts; the ``keep`` columns pass through.

    ``make()`` runs once per task (models load there) and returns a function
    from a list of texts (None for null) to the new columns. It gets texts of
    ``chars`` bytes at once, or a single longer one.
    """
    passed = [c for c in keep if c != text]
    frame = df.select(*[F.col(f"`{c}`") for c in passed], F.col(f"`{text}`").cast("string").alias("__text"))

    def run(batches):
        of = make()
        for batch in small_batches(batches, "__text", chars):
            cols = {c: batch.column(i) for i, c in enumerate(passed)}
            texts = batch.column(len(passed)).to_pylist()
            if text in keep:
                cols[text] = batch.column(len(passed))
            cols.update(of(texts))
            yield pa.RecordBatch.from_pydict(cols)

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[:len(passed)])
    head += (", " if head and text in keep else "") + (f"`{text}` string" if text in keep else "")
    return frame.mapInArrow(run, f"{head}, {schema}" if head else schema)


#: Tasks over which the rows of one key are dealt in a salted join.
SALTS = 32


def salted_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``, whose rows on the left are dealt over ``SALTS`` tasks.

    ``right`` has one row a key, for few of the left's keys: its rows are
    repeated ``SALTS`` times.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return left.withColumn("__salt", salt).join(right.withColumn("__salt", every), [key, "__salt"], "left").drop("__salt")


#: Rows of one key beyond which a join takes the key's rows apart from the others.
HOT_ROWS = 10_000


def hot_split_join(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join of many rows to one row a key, where ``rows`` of ``right`` is the
    number of the key's rows on the left.

    Keys of more than ``HOT_ROWS`` rows (a ten-thousandth of the left's rows at
    most) are broadcast where their rows measure small, so a hot key's rows stay
    where they are; only the others are shuffled by the key.
    """
    hot = checkpoint(right.where(F.col(rows) > HOT_ROWS))
    if not is_small(hot):
        return left.join(right, key)  # Spark's skew handling splits the large partitions
    at_home = left.join(F.broadcast(hot), key)
    others = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.where(F.col(rows) <= HOT_ROWS), key)
    return at_home.unionByName(others)


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """One row per labelled doc_id: null ids and labels are left out, repeated
    rows count once, and of conflicting rows the more frequent label holds (1 in a tie)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, fold: tuple[int, int], rows: int) -> DataFrame:
    """(doc_id, text_hash, text, label) of a bounded sample of labelled rows.

    Rows whose ``fold_of(doc_id, fold[0])`` is ``fold[1]`` are held out. Of the
    others the ``rows`` ids with the smallest hash are taken: the same ids
    whatever the partitions, and as good as random. Rows count once per
    (doc_id, text_hash): every id has its text of the smallest hash in the
    sample, and what is left of ``rows`` goes to the smallest hashes of the
    ids' other texts, whatever their label. These keys (at most ``rows``) are
    chosen once and broadcast, so the texts are not shuffled. Equal rows of a
    key all come: a caller groups what it makes of them by the key.
    """
    known = one_label(labels, label).where(fold_of("doc_id", fold[0]) != fold[1])
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    keys = texts.select("doc_id", "text_hash").join(F.broadcast(some), "doc_id").distinct().withColumn(
        "order", F.xxhash64("doc_id", "text_hash"))
    first = keys.groupBy("doc_id").agg(F.min(F.struct("order", "text_hash")).alias("first"))
    keys = keys.join(F.broadcast(first), "doc_id").orderBy(
        F.struct("order", "text_hash") != F.col("first"), "order", "doc_id", "text_hash").limit(rows)
    keys = keys.select("doc_id", "text_hash", "label")
    chosen = docs.sparkSession.createDataFrame(keys.collect(), keys.schema)  # at most ``rows`` rows
    return texts.join(F.broadcast(chosen), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "label")
