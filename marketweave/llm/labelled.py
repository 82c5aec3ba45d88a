"""Bounded samples of labelled rows for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(key: str, parts: int) -> Column:
    """crc32 of an id as text, modulo `parts`; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(parts)), F.lit(-1)).cast("int")


def smallest(keys: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` keys with the smallest hashes.

    Keys beyond four times the share that is wanted are filtered before the limit, so what
    meets in one task does not grow with the table.
    """
    place = F.pmod(F.xxhash64(key), F.lit(2**40))
    total = keys.count()
    bound = 2**40 if total <= 4 * rows else -(-(2**40) * 4 * rows // total)
    return keys.filter(place < bound).orderBy(place, key).limit(rows)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, trained: Column) -> DataFrame:
    """`doc_id, text, y` of at most `rows` labelled rows, the same ones in any order of the input.

    The rows are those whose hashed ids are smallest.  Null ids and labels are left out; of
    rows that repeat an id in `labels` the largest label counts.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & trained)
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    marks = smallest(marks, "doc_id", rows)
    # At most `rows` ids and labels are sent to the executors.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")
