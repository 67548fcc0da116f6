"""Warehouse tables in the session's catalog (K3-K6, C16): declared by DDL,
loaded by name, read by name.

* ``create_table`` declares columns and types (and, where joins should not
  shuffle, hash buckets) with ``CREATE TABLE IF NOT EXISTS``.
* ``overwrite_table`` casts a frame to the declared types and replaces the
  rows (``INSERT OVERWRITE``); the values that did not fit are counted in the
  same pass.
* ``publish_views`` gives the tables of a published star (``lake``) names:
  views over the folders of one snapshot. They are replaced after a publish,
  so SQL by name follows the published version, and running queries keep the
  one that they started with.

``INSERT OVERWRITE`` removes the files of the rows before: who reads a table
while it is loaded takes the views.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .lake import SIDE_BY_SIDE, conform_counted, read_star, star_manifest


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """K3: ``CREATE DATABASE IF NOT EXISTS``; its tables live below ``location`` where given."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}" + (f" LOCATION '{location}'" if location else ""))
    return name


def create_table(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = (),
                 cluster_by: Sequence[str] = (), buckets: int = 0) -> str:
    """K3: ``CREATE TABLE IF NOT EXISTS`` with the declared columns.

    ``cluster_by`` and ``buckets`` deal the rows by a hash of these columns
    into so many buckets: tables with equal buckets join on them without a
    shuffle. A table that exists with other columns is an error.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if cluster_by:
        keys = ", ".join(f"`{c}`" for c in cluster_by)
        ddl += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS"
    spark.sql(ddl)
    have = {f.name: f.dataType for f in spark.table(name).schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    if have != want:
        raise ValueError(f"table {name} exists with other columns: {have}")
    return name


def _bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}
    count = int(rows.get("Num Buckets") or 0)
    return count, [c.strip(" `") for c in rows.get("Bucket Columns", "[]").strip("[]").split(",") if c.strip(" `")]


def overwrite_table(df: DataFrame, name: str) -> dict[str, int]:
    """K4: replace the rows of a declared table by ``df``, conformed to its
    types. Returns ``_rows`` and the number of values of each column that did
    not fit and became NULL."""
    spark = df.sparkSession
    frame, seen = conform_counted(df, spark.table(name).schema)
    buckets, keys = _bucket_spec(spark, name)
    if buckets:  # one task writes a bucket, so a bucket is one file
        frame = frame.repartition(buckets, *keys)
    frame.write.insertInto(name, overwrite=True)
    return dict(seen.get)


def load_tables(tables: Mapping[str, tuple[DataFrame, StructType]], database: str) -> DataFrame:
    """K5: create (where missing) and replace every table of a map; one row
    (table_name, column_name, n_rows, n_lost) per declared column."""
    spark = next(iter(tables.values()))[0].sparkSession

    def load(name: str) -> dict[str, int]:
        frame, schema = tables[name]
        return overwrite_table(frame, create_table(spark, f"{database}.{name}", schema))

    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        counts = dict(zip(tables, pool.map(load, tables)))
    rows = [(name, f.name, counts[name]["_rows"], counts[name][f.name])
            for name, (_, schema) in tables.items() for f in schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, n_rows long, n_lost long")


def publish_views(spark: SparkSession, database: str, root: str, version: int | None = None) -> list[str]:
    """``database.table`` for every table of a star, all of one version
    (the current one by default). Called again after a publish, the names follow it."""
    create_database(spark, database)
    manifest = star_manifest(spark, root, version)
    if manifest is None:
        raise FileNotFoundError(f"{root} has no published version")
    for name, folder in manifest.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(f'{database}.{name}')} AS SELECT * FROM parquet.`{root.rstrip('/')}/{folder}`")
    return sorted(manifest)


def star_views(spark: SparkSession, root: str, version: int | None = None, prefix: str = "") -> list[str]:
    """The same as views of this session only (``prefix`` + table), which no other session sees."""
    frames = read_star(spark, root, version)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return sorted(frames)
