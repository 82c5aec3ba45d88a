"""Conform to the target table, check its constraints, insert what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.parse import money, parse_date
from ..schemas import TABLE, TABLE_KEY, TABLE_NOT_NULL
from .quality import dedupe_keep_first


def _conformed(df: DataFrame, target: T.StructField) -> Column:
    present = target.name in df.columns
    kind = target.dataType
    if isinstance(kind, T.StringType):
        return F.col(target.name).cast("string") if present else F.lit("")
    if isinstance(kind, T.DecimalType):
        return money(target.name) if present else F.lit(0).cast(kind)
    if not present:
        return F.lit(None).cast(kind)
    if isinstance(df.schema[target.name].dataType, T.StringType):
        return parse_date(target.name).cast(kind)
    return F.col(target.name).cast("date").cast(kind)


def conform(df: DataFrame, schema: T.StructType = TABLE, keep: list[str] = ()) -> DataFrame:
    """The schema's columns in its order; others are dropped, except ``keep``.

    A column the frame lacks gets a default ("" or 0); a null in a column it has stays null.
    """
    return df.select(*[_conformed(df, f).alias(f.name) for f in schema], *keep)


def constraint_violations(df: DataFrame, not_null: list[str] = TABLE_NOT_NULL, unique: str = TABLE_KEY) -> DataFrame:
    """``(constraint, violations)``: rows without a value, and rows beyond the first of a key.

    One aggregation by key, partial in the map tasks.  Null keys do not conflict.
    """
    per_key = df.groupBy(unique).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    )
    repeats = F.when(F.col(unique).isNotNull(), F.col("n") - 1).otherwise(0)
    total = per_key.agg(
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null],
        F.coalesce(F.sum(repeats), F.lit(0)).alias("repeats"),
    )
    rows = [
        F.struct(F.lit(f"{c} not null").alias("constraint"), F.col(f"null_{c}").alias("violations")) for c in not_null
    ]
    rows.append(F.struct(F.lit(f"{unique} unique").alias("constraint"), F.col("repeats").alias("violations")))
    return total.select(F.inline(F.array(*rows)))


def check_constraints(df: DataFrame, not_null: list[str] = TABLE_NOT_NULL, unique: str = TABLE_KEY) -> None:
    broken = constraint_violations(df, not_null, unique).filter("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r['constraint']}: {r['violations']} rows" for r in broken))


KEY_PART = "key_part"


def key_part(key: Column | str, parts: int) -> Column:
    """The number of the part of a partitioned target in which a key is; null keys are in part 0."""
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(parts)), F.lit(0)).cast("int")


def touched_parts(batch: DataFrame, target: DataFrame, parts: int, key: str = TABLE_KEY) -> DataFrame:
    """Of a target partitioned by ``key_part`` what may hold keys of the batch.

    The driver learns which parts the batch touches (``parts`` numbers at most) and its smallest
    and largest key.  The scan then lists the folders of these parts only, and skips the row groups
    whose keys are all smaller or larger; so it grows with the batch and not with the target.
    """
    known = batch.filter(F.col(key).isNotNull())
    seen = known.agg(F.collect_set(key_part(key, parts)).alias("parts"), F.min(key).alias("low"), F.max(key).alias("high")).head()
    if not seen["parts"]:
        return target.filter("false")
    return target.filter(F.col(KEY_PART).isin(sorted(seen["parts"])) & F.col(key).between(seen["low"], seen["high"]))


def rows_to_insert(
    batch: DataFrame, target: DataFrame, order: list[str | Column], key: str = TABLE_KEY, parts: int | None = None
) -> DataFrame:
    """Rows of ``batch`` an insert-only upsert adds to ``target``; ``parts`` if that is partitioned by key.

    A key that exists is left alone, the first row of a new key wins, and rows without a key
    never conflict: those pass without a shuffle, so they cannot meet in one task.  Of the
    target only the key column is read.  Deduplication and look-up share one partitioning by
    key, and a target that is bucketed by it is not moved at all.
    """
    first = dedupe_keep_first(batch.filter(F.col(key).isNotNull()), [key], order)
    target = touched_parts(batch, target, parts, key) if parts else target
    known = target.filter(F.col(key).isNotNull()).select(key)
    new = first.join(known, key, "left_anti").select(*batch.columns)
    return new.unionByName(batch.filter(F.col(key).isNull()))
