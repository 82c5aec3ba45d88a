"""A bounded prefilter that spares the shuffle rows a join would drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bits of the filter, in words of 64: at most 131,072 rows of 16 bytes, whatever the number of ids.
BITS = 2**23


def _flagged(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """`df` with `_hit`: whether the key's bit is set. A null key has none."""
    slot = F.pmod(F.xxhash64(key), F.lit(BITS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63)).cast("int")
    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = ids.select(word.alias("_word"), set_.alias("_set")).groupBy("_word").agg(F.bit_or("_set").alias("_bits"))
    wide = df.withColumn("_word", word).join(F.broadcast(words), "_word", how)
    hit = F.coalesce(F.col("_bits").bitwiseAND(set_) != 0, F.lit(False))
    return wide.withColumn("_hit", hit & F.col(key).isNotNull())


def thin(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of `df` whose key may be in `ids`: all that are, and those that share a bit with one.

    The filter is two megabytes at most, so it is broadcast at any size.  The more ids there
    are, the less it spares; it never drops a wanted row.  Null keys are dropped.
    """
    return _flagged(df, ids, key, "inner").filter("_hit").select(*df.columns)


def split_by(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in `ids`, and the others, which surely are not."""
    flagged = _flagged(df, ids, key, "left")
    return flagged.filter("_hit").select(*df.columns), flagged.filter("not _hit").select(*df.columns)
