"""How five document filters act on one another, in every order they may be applied.

Filters (a document fails if): A fewer than 200 words; B under half of its words are distinct;
C over 3 percent of its characters are A-Z; D it holds one of # $ % & * |; E its text is that of
a document with a smaller id.  Words are what is between ASCII white space, case counts.

A first pass reads each text once: the four flags that it decides by itself, and two 64-bit hashes
of it.  E needs other documents.  A counting Bloom prepass spares most of that: each text adds one
to PROBES cells that its hashes name, tasks add up their own cells, and the merged sketch says
which cells were hit once.  A text with such a cell is unique for sure.  Only the others, possible
repeats, are read again and shuffled by their full text, copies dropped in every task first, for
the smallest id of each text.  Those ids go back to the flags by the two hashes; should two texts
share both, which the full texts show, all is hashed anew with another seed.

The flags of a document make a mask of five bits.  Counts by part and mask (32 of them) add up;
every order, step and figure is a sum over masks.

The sketch has CELLS cells a document, MOST at most (a bit of each goes to the executors, 16 MB).
Beyond some 30 million documents it clears fewer and fewer, never a wrong one.

Defined results: a null text counts as the empty text, and all empty texts are copies of one
another.  A null language is the part "".  A null doc_id is no copy of anything and nothing is a
copy of it; rows that repeat a doc_id are documents of their own and not copies of each other.
Labels of rows that repeat a doc_id count if any of them is 1.  Very long texts are read in
segments.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marketweave.llm import tokens
from marketweave.session import shared_dir, stage

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3  # words, and two percentages
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CELLS, MOST, PROBES = 16, 2**27, 2


def own_flags(text: str) -> int:
    """The filters A to D that a text fails, as bits."""
    data = text.encode()
    n, distinct = 0, set()
    for segment in tokens.segments(data):
        words = segment.split()
        n += len(words)
        distinct.update(words)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    failed = (n < LEAST_WORDS, 100 * len(distinct) < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * len(text), len(data.translate(None, SYMBOLS)) < len(data))
    return sum(1 << i for i, f in enumerate(failed) if f)


def _read(batches):
    for batch in batches:
        masks = pa.array([own_flags(t.as_py()) for t in batch.column("text")], pa.int32())
        names = ["doc_id", "part", "h1", "h2"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), masks], [*names, "mask"])


def _hashed(docs: DataFrame, seed: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).withColumns(
        {"h1": F.xxhash64(F.lit(2 * seed), "text"), "h2": F.xxhash64(F.lit(2 * seed + 1), "text")}
    )


def _cell(probe: int, cells: int) -> Column:
    # Not a sum of both hashes, which may pass the range of a long.
    return F.pmod(F.xxhash64("h1", F.lit(probe)), F.lit(cells))


def sketch(rows: DataFrame, cells: int) -> DataFrame:
    """`word, alone`: 64 cells each, with a bit for each cell that was counted once."""
    hit = rows.select(F.explode(F.array(*[_cell(j, cells) for j in range(PROBES)])).alias("cell"))
    # Tasks count their own cells before these are merged.
    once = hit.groupBy("cell").count().filter("count = 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(F.lit(63)).cast("int"))
    return once.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("alone"))


def _marked(rows: DataFrame, found: DataFrame, cells: int) -> DataFrame:
    """`rows` with `unique`: whether one of the cells was counted once."""
    out, unique = rows, F.lit(False)
    for j in range(PROBES):
        # MOST / 64 rows at most.
        out = out.withColumn("_cell", _cell(j, cells)).withColumn("word", F.shiftright("_cell", 6))
        out = out.join(F.broadcast(found), "word", "left")
        bit = F.call_function("shiftright", F.col("alone"), F.col("_cell").bitwiseAND(F.lit(63)).cast("int"))
        out = out.withColumn(f"_u{j}", F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))).drop("word", "alone", "_cell")
        unique = unique | F.col(f"_u{j}")
    return out.withColumn("unique", unique).drop(*[f"_u{j}" for j in range(PROBES)])


def flags(docs: DataFrame, root: str) -> DataFrame:
    """`doc_id, part, mask` of each row, with all five flags."""
    seed = 0
    while True:
        hashed = _hashed(docs, seed)
        kind = docs.schema["doc_id"].dataType.simpleString()
        rows = hashed.mapInArrow(_read, f"doc_id {kind}, part string, h1 long, h2 long, mask int")
        rows = stage(rows, f"own_{seed}", root)
        with_id = rows.filter("doc_id is not null")
        cells = min(MOST, 1 << max(6, (CELLS * rows.count()).bit_length()))
        found = stage(sketch(with_id, cells), f"sketch_{seed}", root)
        marked = stage(_marked(rows, found, cells), f"marked_{seed}", root)
        maybe = _marked(hashed.filter("doc_id is not null").select("doc_id", "text", "h1", "h2"), found, cells).filter("not unique")
        texts = maybe.groupBy("h1", "h2", "text").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        first = stage(texts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("last").alias("last")), f"first_{seed}", root)
        if first.filter("texts > 1").isEmpty():
            break
        seed += 1
    # Only texts of two ids are of interest, and only rows that may be repeats look them up.
    many = first.filter("first < last").select("h1", "h2", "first")
    copied = marked.filter("not unique and doc_id is not null").join(many, ["h1", "h2"], "left")
    mask = F.when(F.col("doc_id") > F.col("first"), F.col("mask").bitwiseOR(F.lit(COPY))).otherwise(F.col("mask"))
    others = marked.filter("unique or doc_id is null").select("doc_id", "part", "mask")
    return copied.select("doc_id", "part", mask.alias("mask")).unionByName(others)


def mask_counts(found: DataFrame, labels: DataFrame) -> DataFrame:
    """`part, n, good, toxic`: arrays of the documents of each mask, of those labelled good, and toxic."""
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    joined = found.join(marks, "doc_id", "left")
    counted = joined.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    columns = []
    for c in ("n", "good", "toxic"):
        columns.append(F.array(*[F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(2 * COPY)]).alias(c))
    return counted.groupBy("part").agg(*columns)


def _steps() -> str:
    """SQL rows of all orders and steps: order, step, the filter's bit, the bits of those before."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append(f"struct('{''.join(order)}' as filter_order, {step} as step, {bit} as bit, {before} as before)")
            before |= bit
    return f"array({', '.join(rows)})"


def _sum_of(counts: str, condition: str, factor: str = "1L") -> Column:
    """The sum over masks `m` of the counts that fulfil a condition."""
    return F.expr(f"aggregate(sequence(0, {2 * COPY - 1}), 0L, (s, m) -> s + if({condition}, {counts}[m] * {factor}, 0L))")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`part, filter_order, step` and the counts of that filter at that step."""
    root = shared_dir(docs.sparkSession)
    counts = stage(mask_counts(flags(docs, root), labels), "counts", root)
    every = counts.select("*", F.expr(f"inline({_steps()})"))
    here = "(m & bit) != 0 and (m & before) = 0"
    return every.select(
        "part",
        "filter_order",
        "step",
        _sum_of("n", "(m & (bit | before)) = 0").alias("kept"),
        _sum_of("n", here).alias("removed"),
        _sum_of("n", "(m & bit) != 0 and (m & before) != 0").alias("redundant"),
        F.expr("n[bit]").alias("unique_fails"),
        _sum_of("good", here).alias("good_lost"),
        _sum_of("toxic", here).alias("toxic_lost"),
        # Of all orders, a filter is first among the k that a document fails in one of k.
        _sum_of("n", "(m & bit) != 0", "(120L div bit_count(m))").alias("shapley"),
    )
