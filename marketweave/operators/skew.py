"""Joins and top-n that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SALTS = 64

# Rows per group up to which one limit pass is enough: every map task then forwards at
# most this many rows of a group.
SINGLE_PASS_LIMIT = 16


def row_salt(df: DataFrame, order: list[str | Column], salts: int) -> Column:
    """A salt from the row's order columns, which tell rows of a group apart: a re-run task
    gives each row the same one.  Maps have no hash and are passed over."""
    plain = [c for c in order if not isinstance(c, str) or not isinstance(df.schema[c].dataType, T.MapType)]
    named = [c for c in plain if isinstance(c, str)]
    return F.pmod(F.xxhash64(*(named or [F.lit(0)])), F.lit(salts)).cast("int")


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Left or inner join on ``key`` where ``right`` holds each key once.

    One plain join at every size: adaptive execution cuts the partition of a key that owns many
    left rows, or of the rows without a key, into several tasks and sends each the one right row.
    """
    return left.join(right, key, how)


def first_n(df: DataFrame, by: list[str | Column], order: list[str | Column], n: int | None) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (a total order); all rows for None.

    Spark limits each group inside every map task before the shuffle, up to the ``n`` that
    ``spark.sql.optimizer.windowGroupLimitThreshold`` allows (``session.SETTINGS`` lifts it).
    That leaves up to ``n`` rows per task and group, so for a larger ``n`` the group is first
    limited in ``SALTS`` parts, which bounds what meets in one task to ``n * SALTS`` rows.
    """
    if n is None:
        return df
    if n > SINGLE_PASS_LIMIT:
        df = _limit(df.withColumn("_salt", row_salt(df, order, SALTS)), [*by, "_salt"], order, n).drop("_salt")
    return _limit(df, by, order, n)


def _limit(df: DataFrame, by: list, order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
