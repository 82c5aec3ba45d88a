"""The product table and the choice of destination."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.upsert import KEY_PART, conform, key_part, rows_to_insert
from ..schemas import TABLE, TABLE_KEY, TABLE_NOT_NULL
from ..session import stage
from .files import write_csv

DESTINATIONS = ("dir", "db")
ID = "id"

_SQL_TYPES = {T.StringType: "TEXT", T.DecimalType: "NUMERIC(10, 2)", T.TimestampType: "TIMESTAMP", T.IntegerType: "INTEGER"}


def table_name(run_key: str) -> str:
    """The table of a run: its folder name with ``-`` as ``_``."""
    return run_key.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def create_table(spark: SparkSession, table: str, buckets: int | None = None, parts: int | None = None) -> None:
    """The managed table, if it does not exist: a number and the fixed columns.

    ``buckets`` stores the rows by key, so that an upsert into a large table moves only the batch.
    ``parts`` stores them in that many folders by a hash of the key, so that an upsert reads only
    the folders its batch touches; the table remembers the number.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLE)
    clustered = f" CLUSTERED BY ({TABLE_KEY}) INTO {buckets} BUCKETS" if buckets else ""
    if parts:
        columns += f", {KEY_PART} int"
        clustered = f" PARTITIONED BY ({KEY_PART}){clustered} TBLPROPERTIES ('{KEY_PART}s' = '{parts}')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ID} bigint, {columns}) USING parquet{clustered}")


def save_by_key(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """The rows as a managed table that is stored by a hash of ``key`` in ``buckets`` parts, each sorted.

    Collected pages are moved once, here; joins of the table by ``key`` then bring the other side's
    narrow rows to where the pages are.  Every part is written by one task, so choose as many as
    the session's ``spark.sql.shuffle.partitions`` or more; with fewer Spark deals both sides anew.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def _parts(spark: SparkSession, table: str) -> int | None:
    """The number of parts that a table was created with."""
    if KEY_PART not in spark.table(table).columns:
        return None
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{KEY_PART}s')").head()["value"])


def insert_new(batch: DataFrame, table: str, order: list[str | Column]) -> int:
    """Insert-only upsert of conformed rows; returns how many rows were offered.

    ``batch`` is read more than once, so give rows of files or of a stage table.
    A null in a not-null column fails the batch before anything is written.  One writer at
    a time: looking up and appending is not a transaction.  Numbers are distinct and grow
    from run to run, with gaps.
    """
    spark = batch.sparkSession
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in TABLE_NOT_NULL]
    seen = batch.agg(F.count(F.lit(1)).alias("offered"), *nulls).head()
    broken = [f"{c} not null: {seen[c]} rows" for c in TABLE_NOT_NULL if seen[c]]
    if broken:
        raise ValueError("; ".join(broken))
    target, parts = spark.table(table), _parts(spark, table)
    used = target.agg(F.coalesce(F.max(ID) + 1, F.lit(0))).head()[0]
    new = rows_to_insert(batch, target, order, parts=parts)
    numbered = new.select((F.monotonically_increasing_id() + F.lit(used)).alias(ID), *TABLE.names)
    if parts:
        # Rows of a part meet in few tasks, so a batch adds few files to it.
        numbered = numbered.withColumn(KEY_PART, key_part(TABLE_KEY, parts)).hint("rebalance", KEY_PART)
    numbered.write.insertInto(table)
    return seen["offered"]


def table_ddl(table: str) -> str:
    """The same table for a database, with its constraints."""
    lines = [f"{ID} SERIAL PRIMARY KEY"]
    for f in TABLE:
        extra = " NOT NULL" if f.name in TABLE_NOT_NULL else " UNIQUE" if f.name == TABLE_KEY else ""
        lines.append(f"{f.name} {_SQL_TYPES[type(f.dataType)]}{extra}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(lines)})"


def merge_sql(table: str, staging: str) -> str:
    """Moves staged rows into the database table; existing keys are left alone."""
    columns = ", ".join(TABLE.names)
    return (
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({TABLE_KEY}) DO NOTHING"
    )


def write_jdbc_staging(batch: DataFrame, url: str, staging: str, properties: dict[str, str]) -> None:
    """Rows of one run into a staging table, in parallel; ``merge_sql`` then runs in the database."""
    batch.select(*TABLE.names).write.mode("overwrite").jdbc(url, staging, properties=properties)


def snapshot_path(root: str, slug: str, when: datetime) -> str:
    return f"{root.rstrip('/')}/final_{slug}_{when:%d%m%Y_%H%M%S}.csv"


def write_products(
    df: DataFrame,
    destination: str,
    path: str | None = None,
    table: str | None = None,
    order: list[str] = (),
    buckets: int | None = None,
    parts: int | None = None,
) -> None:
    """Clean rows to ``dir`` (CSV at ``path``) or ``db`` (upsert into ``table``).

    Arguments are checked before any job starts.
    """
    if destination not in DESTINATIONS:
        raise ValueError(f"unknown destination {destination!r}, known are {DESTINATIONS}")
    if destination == "dir":
        if path is None:
            raise ValueError("destination 'dir' needs a path")
        write_csv(df, path, order)
        return
    if table is None or not re.fullmatch(r"[\w.]+", table):
        raise ValueError("destination 'db' needs a table name")
    create_table(df.sparkSession, table, buckets, parts)
    batch = stage(conform(df, keep=[c for c in order if c not in TABLE.names]), "batch")
    insert_new(batch, table, list(order) or [TABLE_KEY])
