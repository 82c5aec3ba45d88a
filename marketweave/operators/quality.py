"""Profile, clean and count product rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.parse import coerce_numeric, nan_to_null
from ..schemas import NULLABLE_PRIORITY, NUMERIC_COLUMNS, PRIORITY
from .skew import first_n

_FLOATS = (T.DoubleType, T.FloatType)


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _FLOATS)


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column.  An empty string is present."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if _is_float(df, column) else c.isNull()


def missing_columns(columns: list[str], expected: list[str] = PRIORITY) -> list[str]:
    """Expected columns a frame does not have, in expected order."""
    return [c for c in expected if c not in columns]


def select_priority(df: DataFrame, priority: list[str] = PRIORITY) -> DataFrame:
    """Priority columns in their order, then the other columns by name."""
    absent = missing_columns(df.columns, priority)
    if absent:
        raise ValueError(f"the frame lacks {absent}")
    return df.select(*priority, *sorted(set(df.columns) - set(priority)))


def _missing_counts(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(position, column, missing_count)`` per column, from one pass over the rows."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*_missing_counts(df, columns))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.inline(rows))


def observe_profile(df: DataFrame, name: str, columns: list[str] | None = None) -> tuple[DataFrame, Observation]:
    """The same rows; their profile and number are known once a job has run over them, so the job
    that writes them spares the pass that ``missing_profile`` needs."""
    seen = Observation(name)
    columns = df.columns if columns is None else columns
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *_missing_counts(df, columns)), seen


def observed_profile(spark: SparkSession, seen: Observation, columns: list[str]) -> DataFrame:
    """What ``missing_profile`` gives, from the counts of a job that has run."""
    counts = [seen.get[f"m{i}"] for i in range(len(columns))]
    names = ["position", "column", "missing_count"]
    kinds = [pa.int32(), pa.string(), pa.int64()]
    values = [list(range(len(columns))), columns, counts]
    return spark.createDataFrame(pa.table([pa.array(v, k) for v, k in zip(values, kinds)], names))


def coerce_columns(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Number columns as double; whatever is no number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: nan_to_null(c) if _is_float(df, c) else coerce_numeric(c) for c in present})


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with a value in every required column, as predicates a file scan can use."""
    for c in required:
        df = df.filter(~is_missing(df, c))
    return df


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row in ``order`` of each key; missing values compare equal.

    ``order`` must be total.  Each map task drops its own repeats before the shuffle, so a
    key that owns a third of the rows sends one row per task.
    """
    by = [nan_to_null(k) if _is_float(df, k) else F.col(k) for k in keys]
    return first_n(df, by, order, 1)


def clean_products(df: DataFrame, order: list[str | Column], priority: list[str] = PRIORITY) -> DataFrame:
    """Coerce numbers, drop rows with gaps, keep the first of each repeated row."""
    required = [c for c in priority if c not in NULLABLE_PRIORITY]
    return dedupe_keep_first(drop_incomplete(coerce_columns(df), required), priority, order)


def split_malformed(df: DataFrame, malformed: Column) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``; a null condition counts as good."""
    bad = F.coalesce(malformed, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def observe_malformed(df: DataFrame, malformed: Column, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows; how many were ``read`` and ``malformed`` comes with the job that uses them,
    not from a second pass."""
    seen = Observation(name)
    bad = F.coalesce(malformed, F.lit(False))
    return df.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("malformed")), seen


def run_counts(records: DataFrame, page: str, product: str) -> DataFrame:
    """Pages visited, products collected, distinct products: one row."""
    return records.agg(
        F.count_distinct(F.col(page)).alias("pages"),
        F.count(product).alias("products"),
        F.count_distinct(F.col(product)).alias("distinct_products"),
    )
