"""Large CSV files in byte ranges: quoted fields may hold line breaks, and no task needs a whole file.

Spark cuts a text file into ranges at line ends, which may lie inside a quoted field.  Whether one
does is a matter of the quotes before it: after an odd number a field is open.  So a first pass
counts the quotes of each range, and their running parity says of each range whether it begins
inside a field.  A second pass puts the lines of a range together to records; what belongs to a
record of other ranges, its first lines or its last, goes out as a fragment.  Fragments, two for a
range at most, are joined across ranges, and every record is parsed by itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a row of the second pass is: a record, or a record's last lines, lines amid, first lines.
WHOLE, LAST, AMID, FIRST = range(4)
_ROWS = "file string, split long, row long, kind int, record string"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the ranges of a task; ``file, split, open, value`` come line by line."""
    at, lines, open_, first, row = None, [], False, False, 0

    def rest() -> list[tuple]:
        # Lines that no record end followed.
        return [(*at, row, AMID if first else FIRST, "\n".join(lines))] if at and lines else []

    for batch in batches:
        out: list[tuple] = []
        quotes = pc.count_substring(batch.column("value"), '"').to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("file", "split", "open", "value")]
        for file, split, begins_open, value, n in zip(*columns, quotes):
            if (file, split) != at:
                out += rest()
                at, lines, open_, first, row = (file, split), [], begins_open, begins_open, 0
            lines.append(value)
            open_ ^= bool(n % 2)
            if not open_:
                out.append((*at, row, LAST if first else WHOLE, "\n".join(lines)))
                lines, first, row = [], False, row + 1
        yield _batch(out)
    yield _batch(rest())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    values = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["file", "split", "row", "kind", "record"])


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, row, record``: the records of CSV files as text, headers included.

    Records sort by file, by the offset of the range they begin in, and by row.  A quote that is
    never closed makes what follows it one record, as for any reader of the format.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range, some hundred million bytes each: a small table.
    opens = ranges.select("file", "split", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("open"))
    found = lines.join(F.broadcast(opens), ["file", "split"]).select("file", "split", "open", "value").mapInArrow(_assembled, _ROWS)
    found = stage(found, "records")  # records and fragments go different ways from here
    whole = found.filter(F.col("kind") == WHOLE).select("file", "split", "row", "record")
    # A record that begins in one range ends in the next one that has last lines.
    pieces = found.filter(F.col("kind") != WHOLE)
    chain = F.sum(F.when(F.col("kind") == FIRST, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("split", "row"))
    pieces = pieces.withColumn("chain", chain).groupBy("file", "chain")
    parts = F.array_sort(F.collect_list(F.struct("split", "row", "record")))
    joined = pieces.agg(parts.alias("p")).select("file", F.get("p", F.lit(0))["split"].alias("split"), F.get("p", F.lit(0))["row"].alias("row"), F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
