"""Benchmark decontamination by SimHash windows, in DataFrame functions only.

Words are runs of letters and digits, lower-cased; shingles are five words (an item of fewer
words is one shingle).  A shingle weighs ln(1 + items / items that hold it), in thousandths.
The similarity of a window of a document and an item is the summed weight of the shingles both
have over that of the shingles either has; SIMILARITY or more is a leak.

A window is as many words as the item has, or as the text has from there on, at any place of the
text, so an item that the text's end cuts short is compared with what there is of it.  Windows that cannot reach the similarity are not built.  An item's *anchors* are its
rarest shingles, ANCHORED of its weight or more; a similar window lacks 1 - SIMILARITY of the
item's weight at most, so it holds the other anchors.  Anchors are looked up in every text, and
the windows that hold enough of them, in whatever order, get a 64-bit SimHash of their weighted
shingles.  Places are handled in stretches of the item's length, so a text that repeats an item
many times costs in proportion.  Fingerprints are cut into RADIUS + 1 blocks; two that differ
in RADIUS bits at most agree on one, so a join on (words, block, bits) meets all of them.
Candidates within the radius are verified by their exact similarity.  At the similarity's
bound fingerprints differ in about 11 bits; RADIUS leaves over two standard deviations.

Defined results: null or empty texts hold no window; a null doc_id or item_id is not reported;
rows that repeat an id are texts of their own under one id, and repeated items one item of all
their shingles; of several windows the most similar, then the first, is
reported.  Empty tables give an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketweave.llm.thin import thin
from marketweave.session import shared_dir, stage

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 19
ANCHORED = 0.6
#: Shingles of items (about 40 bytes each) that are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _runs(words: Column, size: int) -> Column:
    """Hashes of each run of `size` words, with their places from 0."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.lit(size), F.slice(words, i + 1, size)))


def _runs_of(words: Column, size: int) -> Column:
    """The same, with `words` evaluated once."""
    return _let(words, lambda ws: _runs(ws, size))


def _blocks() -> list[tuple[int, int]]:
    """Shift and width of each block of a fingerprint."""
    count, out, at = RADIUS + 1, [], 0
    for j in range(count):
        width = 64 // count + (1 if j < 64 % count else 0)
        out.append((at, width))
        at += width
    return out


def fingerprints(shingles: DataFrame, *keys: str) -> DataFrame:
    """`keys, fp, held`: the SimHash of each group's `h, w` rows, and the rows."""
    votes = [F.sum(F.when(F.shiftright("h", b).bitwiseAND(F.lit(1)) == 1, F.col("w")).otherwise(-F.col("w"))).alias(f"v{b}") for b in range(64)]
    grouped = shingles.groupBy(*keys).agg(F.collect_set(F.struct("h", "w")).alias("held"), *votes)
    fp = F.lit(0).cast("long")
    for b in range(64):
        bit = (1 << b) if b < 63 else -(1 << 63)
        fp = fp.bitwiseOR(F.when(F.col(f"v{b}") >= 0, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return grouped.select(*keys, fp.alias("fp"), "held")


def _fingerprint(held: Column) -> Column:
    """The same SimHash of one row's array of `h, w`."""
    one = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)
    vote = lambda b: F.aggregate(
        held, F.lit(0).cast("long"), lambda s, x: s + F.when(F.call_function("shiftright", x["h"], b).bitwiseAND(F.lit(1)) == 1, x["w"]).otherwise(-x["w"])
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(F.when(vote(b) >= 0, one(b)).otherwise(F.lit(0).cast("long"))))


def _blocked(df: DataFrame) -> DataFrame:
    parts = [F.struct(F.lit(j).alias("block"), F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1)).alias("bits")) for j, (at, n) in enumerate(_blocks())]
    return df.select("*", F.explode(F.array(*parts)).alias("_b")).select("*", "_b.*").drop("_b")


def _weight(held: Column) -> Column:
    return F.aggregate(held, F.lit(0).cast("long"), lambda s, x: s + x["w"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`doc_id, item_id, start, n_words, similarity, distance` of each document that holds an item."""
    spark = docs.sparkSession
    root = shared_dir(spark)
    items = benchmark.filter("item_id is not null").select(F.col("item_id").cast("long"), _words("text").alias("ws"))
    items = items.withColumn("n_words", F.size("ws")).filter("n_words > 0").withColumn("q", F.least("n_words", F.lit(SHINGLE)))
    runs = F.when(F.col("q") == SHINGLE, _runs(F.col("ws"), SHINGLE))
    for q in range(1, SHINGLE):
        runs = runs.when(F.col("q") == q, _runs(F.col("ws"), q))
    parts = stage(items.select("item_id", "n_words", "q", F.posexplode(runs).alias("at", "h")), "parts", root)
    total = parts.select("item_id").distinct().count()
    frequency = parts.groupBy("h").agg(F.count_distinct("item_id").alias("df"))
    frequency = stage(frequency.select("h", F.round(F.log1p(total / F.col("df")) * 1000).cast("long").alias("w")), "weights", root)
    rarest = round(math.log1p(total) * 1000)
    parts = parts.join(frequency, "h")
    one = parts.groupBy("item_id", "n_words", "q", "h").agg(F.first("w").alias("w"))
    order = Window.partitionBy("item_id", "n_words").orderBy(F.desc("w"), "h").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("item_id", "n_words")
    anchors = one.withColumn("before", F.coalesce(F.sum("w").over(order), F.lit(0))).withColumn("all", F.sum("w").over(whole))
    anchors = anchors.filter(F.col("before") < ANCHORED * F.col("all")).withColumn("need", F.sum("w").over(whole) - (1 - SIMILARITY) * F.col("all"))
    anchors = stage(anchors.select("h", "q", "w", "item_id", "n_words", "need"), "anchors", root)
    targets = stage(fingerprints(one, "item_id", "n_words"), "targets", root)

    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_id"), "text")
    sizes = [r[0] for r in anchors.select("q").distinct().collect()]  # at most five values
    small = frequency.count() <= BROADCAST_ROWS and anchors.count() <= BROADCAST_ROWS
    hits = None
    for q in sizes:
        # One pass reads the words of a text once, though each shingle names them.
        places = docs.select("doc_id", "text_id", F.posexplode(_runs_of(_words("text"), q)).alias("pos", "h"))
        wanted = anchors.filter(F.col("q") == q)
        found = places.join(F.broadcast(wanted) if small else wanted, "h") if small else thin(places, wanted, "h").join(wanted, "h")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        empty = docs.filter("false").crossJoin(parts.filter("false").select("item_id", "n_words"))
        return empty.selectExpr("doc_id", "item_id", "0 start", "n_words", "0d similarity", "0 distance")
    hits = stage(hits, "hits", root)

    # Stretches of an item's length: a window that starts in one ends in the next at the latest.
    unit = ["doc_id", "text_id", "n_words", "q", "stretch"]
    turn = F.floor(F.col("pos") / F.col("n_words")).cast("int")
    near = hits.withColumn("stretch", F.explode(F.array(turn, turn - 1))).filter("stretch >= 0")
    near = near.groupBy(*unit, "item_id", "need").agg(F.collect_set(F.struct("pos", "h", "w")).alias("found"))
    near = near.filter(_weight(F.array_distinct(F.transform("found", lambda f: F.struct(f["h"], f["w"])))) >= F.col("need"))
    inside = lambda s: F.filter("found", lambda f: (f["pos"] >= s) & (f["pos"] <= s + F.col("n_words") - F.col("q")))
    held = lambda s: _weight(F.array_distinct(F.transform(inside(s), lambda f: F.struct(f["h"], f["w"]))))
    first = F.col("stretch") * F.col("n_words")
    starts = F.filter(F.sequence(first, first + F.col("n_words") - 1), lambda s: held(s) >= F.col("need"))
    starts = near.select(*unit, F.explode(starts).alias("start")).distinct()
    units = stage(starts.groupBy(*unit).agg(F.collect_list("start").alias("starts")), "units", root)

    text = thin(docs, units).join(units, ["doc_id", "text_id"]).withColumn("ws", _words("text")).select(*unit, "starts", "ws")
    text = text.withColumn("ws", F.slice("ws", first + 1, 2 * F.col("n_words") + F.col("q")))
    q = F.col("q")
    runs = F.when(q == SHINGLE, _runs_of(F.col("ws"), SHINGLE))
    for n in range(1, SHINGLE):
        runs = runs.when(q == n, _runs_of(F.col("ws"), n))
    cut = text.select(*unit, "starts", F.posexplode(runs).alias("at", "h"))
    cut = cut.join(F.broadcast(frequency) if small else frequency, "h", "left").withColumn("w", F.coalesce("w", F.lit(rarest)))
    # A set, as rows may repeat an id and its text.
    cut = cut.groupBy(*unit).agg(F.first("starts").alias("starts"), F.array_sort(F.collect_set(F.struct("at", "h", "w"))).alias("runs"))
    cut = cut.select(*unit, "runs", F.explode("starts").alias("start"))
    window = F.slice("runs", F.col("start") - first + 1, F.col("n_words") - q + 1)
    cut = cut.withColumn("held", F.array_distinct(F.transform(window, lambda r: F.struct(r["h"].alias("h"), r["w"].alias("w")))))
    key = ["doc_id", "text_id", "start", "n_words"]
    cut = stage(cut.select(*key, _fingerprint(F.col("held")).alias("fp"), "held"), "windows", root)

    side = _blocked(targets.select("item_id", "n_words", F.col("fp"))).withColumnRenamed("fp", "item_fp")
    near = _blocked(cut.select(*key, "fp")).join(side, ["n_words", "block", "bits"])
    near = near.withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).filter(F.col("distance") <= RADIUS)
    near = near.select(*key, "item_id", "distance").distinct()
    both = near.join(cut.select(*key, "held"), key)
    both = both.join(targets.select("item_id", "n_words", F.col("held").alias("target")), ["item_id", "n_words"])
    common = _weight(F.array_intersect("held", "target"))
    similarity = common / (_weight(F.col("held")) + _weight(F.col("target")) - common)
    best = both.withColumn("similarity", similarity).filter(F.col("similarity") >= SIMILARITY)
    best = best.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words", (-F.col("distance")).alias("d"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.s")).alias("start"), "b.n_words", "b.similarity", (-F.col("b.d")).alias("distance"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all columns."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(found, docs["doc_id"] == F.col("_leak"), "left_anti")
