"""Quality rules in DataFrame functions only: counts, and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into BUCKETS.  Their counts over the trusted
texts (all that are labelled as good) and over all texts give two multinomials (add-one); a
bucket weighs the logarithm of their ratio, in thousandths.  A text's ratio is the mean weight of its words and
pairs.  Texts that fail the base rules, or whose ratio is below LEAST_RATIO, are not kept.  The
counts cover every row; only BUCKETS sums reach the driver.

Defined results: a null text has no words; texts of fewer than 50 words fail the base rules.
The ratio of a text without words is 0.  Without trusted texts all weights are 0.  Null ids and
repeated rows keep their rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from marketweave.llm.decontam import _let
from marketweave.llm.thin import thin

BUCKETS = 16384
LEAST_RATIO = -0.3
LEAST_WORDS = 50
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _grams(found: Column) -> Column:
    """Buckets of the words and of each word with the next."""
    one = F.transform(found, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    two = F.transform(F.slice(found, 1, F.greatest(F.lit(0), F.size(found) - 1)), lambda w, i: F.pmod(F.xxhash64(w, F.get(found, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, two)


def trusted(docs: DataFrame, good: DataFrame) -> DataFrame:
    """`text` of every row of `docs` whose doc_id is in `good`; only texts that may be are moved."""
    ids = good.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The same plan at any size. A semi join would be pushed below the filter and move all texts.
    return thin(rows, ids).join(ids.hint("merge"), "doc_id").select("text")


def weights(docs: DataFrame, trusted: DataFrame) -> list[int]:
    """Thousandths of the log ratio of each bucket's share among `trusted` (`text`) and `docs`."""

    def shares(df: DataFrame) -> np.ndarray:
        grams = df.select(F.explode(_let(words(F.coalesce("text", F.lit(""))), _grams)).alias("g")).groupBy("g").count()
        table = np.ones(BUCKETS)
        for r in grams.collect():  # at most BUCKETS rows
            table[r["g"]] += r["count"]
        return table / table.sum()

    target = shares(trusted)
    if np.ptp(target) == 0:
        return [0] * BUCKETS
    return np.rint(1000 * np.log(target / shares(docs))).astype(int).tolist()


def _mean_weight(found: Column, table: Column) -> Column:
    total = lambda g: F.aggregate(g, F.lit(0).cast("long"), lambda s, b: s + F.get(table, b))
    return F.when(F.size(found) == 0, F.lit(0.0)).otherwise(_let(_grams(found), lambda g: total(g) / F.size(g) / 1000.0))


def repeated_words(found: Column) -> Column:
    """Words in three-word windows that the text holds twice or more.

    Hashes are sorted with their places in the low bits, so equal windows are neighbours, and
    neighbours are compared word by word.
    """
    count = F.size(found) - 2
    bits = F.ceil(F.log2(F.size(found) + 1)).cast("int")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda s, x: s + x)

    def twice(packed: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        place = lambda x: x.bitwiseAND(mask).cast("int")

        def same(x: Column, y: Column) -> Column:
            equal = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
            for j in range(3):
                equal = equal & (F.get(found, place(x) + j) == F.get(found, place(y) + j))
            return F.coalesce(equal, F.lit(False))

        hit = F.filter(packed, lambda x, k: same(x, F.get(packed, k + 1)) | same(x, F.get(packed, k - 1)))
        return _let(F.sort_array(F.transform(hit, place)), covered)

    def pack(hashes: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(F.sort_array(packed), twice))

    places = F.sequence(F.lit(0), count - 1)
    return F.when(count < 2, F.lit(0).cast("long")).otherwise(_let(F.transform(places, window), pack))


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def judge(docs: DataFrame, table: list[int], id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, the counts, `ratio`, `base_failed` and `kept` of every row of `docs`."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    value = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    found = docs.select(
        F.col(id_),
        _without(whole, " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.length(whole) - _without(whole, "#*$%&|<>")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(words(whole), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"), _mean_weight(w, value).alias("m"))).alias("_s"),
    )
    found = found.select(id_, F.col("_s.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_s.r").alias("n_repeat_words"), F.col("_s.m").alias("ratio"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= LEAST_RATIO))
