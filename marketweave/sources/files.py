"""JSON and CSV files of product rows, and the choice of the latest snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.parse import coerce_numeric, nan_to_null
from ..functions.text import safe_key
from ..schemas import CLEAN, LISTING
from ..session import stage
from .ranges import csv_records

# Row position in the source: file, split within the file, row within the split.
SOURCE_POS = "source_pos"


def _with_position(df: DataFrame) -> DataFrame:
    """Adds a struct that sorts rows in source order.

    Row numbers grow within a split and a split is read by one task, so file, split offset
    and row number together order all rows without moving any.
    """
    return df.withColumn(
        SOURCE_POS,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def scan_products(
    spark: SparkSession, path: str | list[str], schema: T.StructType = LISTING, multiline: bool = False
) -> DataFrame:
    """Product rows of JSON files with their source position.

    JSON lines are split across tasks; ``multiline=True`` reads files that hold one array
    each, one file per task.  Rows without a name, such as the one row of a file that holds
    ``null`` instead of products, are no products.  A missing path fails the job.
    """
    rows = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return _with_position(rows.filter(F.col("name").isNotNull()))


def scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = CLEAN) -> DataFrame:
    """Rows of CSV files with a header; quoted fields may hold line breaks.

    The columns are those of the header, in its order, with the schema's type where it names
    them and text otherwise.  An empty field is missing, whether it was empty text or null
    when it was written.  Files with different headers fail the job.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rows = _with_position(reader.option("enforceSchema", False).csv(path))
    types = {f.name: f.dataType for f in schema}
    return rows.select(*[_typed(c, types.get(c)) for c in rows.columns])


def scan_csv_ranges(spark: SparkSession, path: str | list[str], schema: T.StructType = CLEAN) -> DataFrame:
    """The rows of ``scan_csv``, each file read by as many tasks as it has ranges.

    Fields are read as ``scan_csv`` does, line breaks of quoted ones as they are in the file.  For
    one large file; it is read twice, first for its quotes.  Files with different headers fail
    the job.
    """
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    records = csv_records(spark, path).filter(F.col("record") != "")
    text = ", ".join(f"`{n}` string" for n in names)
    fields = F.from_csv("record", F.lit(text), {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    rows = records.select(F.struct("file", "split", "row").alias(SOURCE_POS), fields.alias("_f"))
    header = (F.col(f"{SOURCE_POS}.split") == 0) & (F.col(f"{SOURCE_POS}.row") == 0)
    same = F.lit(True)
    for n in names:
        same = same & (F.trim(F.col("_f")[n]) == n)
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), F.col(f"{SOURCE_POS}.file")))
    rows = rows.filter(F.when(header, F.when(F.coalesce(same, F.lit(False)), F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(F.lit(True)))
    rows = rows.select(*[F.col("_f")[n].alias(n) for n in names], SOURCE_POS)
    types = {f.name: f.dataType for f in schema}
    return rows.select(*[_typed(c, types.get(c)) for c in names], SOURCE_POS)


def _typed(column: str, kind: T.DataType | None) -> Column:
    if kind is None or isinstance(kind, T.StringType):
        return F.col(column)
    value = coerce_numeric(column) if isinstance(kind, T.DoubleType) else F.col(column).try_cast(kind)
    return value.alias(column)


def write_json(df: DataFrame, path: str, partition_by: list[str] = (), order: list[str | Column] = ()) -> None:
    """JSON lines, nulls written out, replacing an earlier run of the same partitions.

    Partitions that ``df`` has no rows of stay as they are; ``write_listings`` with the listings
    of the run clears those that were emptied.

    With ``order`` rows are range-partitioned by listing and order: file after file holds
    the rows in sequence, and a listing that owns many rows is cut into several files.
    Without it Spark rebalances: small listings share tasks, large ones are split.
    """
    _partitioned(df, partition_by, order).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).option("ignoreNullFields", False).json(path)


LISTING_LAYOUT = ["marketplace_key", "category_key", "subcategory_key"]


def run_manifest(df: DataFrame, listings: DataFrame) -> DataFrame:
    """One row per listing of a run: its folder names, ``products``, and ``state``.

    ``listings`` has the three name columns of every listing the run visited, and may have
    ``failed``.  A listing is ``written`` if it delivered rows, ``emptied`` if it delivered none,
    and ``kept`` if it failed, whatever it delivered before that.  Rows of listings that the run
    does not know are ``written``.  Counting is partial in the map tasks.
    """
    keys = {key: F.coalesce(safe_key(key.removesuffix("_key")), F.lit("")) for key in LISTING_LAYOUT}
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in listings.columns else F.lit(False)
    visited = listings.select(*[v.alias(k) for k, v in keys.items()], failed.alias("failed"))
    visited = visited.groupBy(*LISTING_LAYOUT).agg(F.max("failed").alias("failed"))
    counted = df.select(*[v.alias(k) for k, v in keys.items()]).groupBy(*LISTING_LAYOUT).agg(F.count(F.lit(1)).alias("products"))
    both = visited.join(counted, LISTING_LAYOUT, "full").withColumn("products", F.coalesce("products", F.lit(0)))
    state = F.when(F.col("failed"), "kept").when(F.col("products") == 0, "emptied").otherwise("written")
    return both.select(*LISTING_LAYOUT, "products", state.alias("state"))


def write_listings(
    df: DataFrame, root: str, order: list[str | Column] = (), listings: DataFrame | None = None, run: str | None = None
) -> DataFrame | None:
    """Product rows under ``root/<marketplace>/<category>/<subcategory>``, in listing order.

    The folder names are path-safe copies of the three columns, so the rows stay whole;
    ``order`` columns set the sequence and are not written.  A listing replaces its own
    folder; other listings stay.

    With the ``listings`` of the run, one that was visited and is empty now replaces its folder by
    a row without values, which ``scan_products`` passes over, so rows of an earlier run do not
    outlive it; a failed one keeps its folder and its rows of this run are left out.  What became
    of each listing is returned, and appended to ``root/_manifest`` under the name of the run.
    All listings go out in one write.
    """
    keys = {key: safe_key(key.removesuffix("_key")) for key in LISTING_LAYOUT}
    manifest = None
    if listings is not None:
        df = stage(df, "delivered")
        manifest = stage(run_manifest(df, listings), "manifest")
        kept = manifest.filter("state = 'kept'").select(*LISTING_LAYOUT)
        plain = {f"_{key}": F.coalesce(value, F.lit("")) for key, value in keys.items()}
        same = [F.col(f"_{key}") == kept[key] for key in LISTING_LAYOUT]
        df = df.withColumns(plain).join(kept, same, "left_anti").drop(*plain)
    keyed = df.withColumns(keys)
    if manifest is not None:
        keyed = keyed.unionByName(manifest.filter("state = 'emptied'").select(*LISTING_LAYOUT), allowMissingColumns=True)
    keyed = _partitioned(keyed, LISTING_LAYOUT, order).drop(*order)
    writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LISTING_LAYOUT)
    writer.option("ignoreNullFields", False).json(root)
    if manifest is not None:
        manifest.withColumn("run", F.lit(run).cast("string")).write.mode("append").json(f"{root.rstrip('/')}/_manifest")
    return manifest


def _partitioned(df: DataFrame, partition_by: list[str], order: list) -> DataFrame:
    """Rows as they are to be written.  A range partitioning reads its input twice, for the
    bounds and for the rows, so the input is staged and what made it runs once."""
    if order:
        df = stage(df, "ordered")
        keys = [*partition_by, *[c for c in order if c not in partition_by]]
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_csv(df: DataFrame, path: str, order: list[str | Column] = (), mode: str = "errorifexists") -> None:
    """CSV with header and doubled quotes; null and empty text are both written empty.

    ``order`` columns set the row sequence over the files; they are not written.
    """
    written = [f for f in df.schema if f.name not in order]
    plain = [
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in written
    ]
    rows = _partitioned(df, [], order).select(*plain)
    writer = rows.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


# --- snapshots -------------------------------------------------------------------------

# What in a name identifies a run.
_DIGITS = r"(\d+)"
_STAMP = r"(\d{8}_\d{6})"


def list_snapshots(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """``name``: files and written folders right under ``root`` that end in ``suffix``.

    Only file names are read; the content column is pruned away.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    base = root.rstrip("/").split("://")[-1]
    base = base.split(":", 1)[-1] if base.startswith("file:") else base
    inside = F.substring_index(F.col("path"), f"{base}/", -1)
    names = files.select(F.substring_index(inside, "/", 1).alias("name"))
    return names.filter(F.col("name").endswith(suffix)).distinct()


def name_key(name: Column | str = "name") -> Column:
    """All digit runs of a name joined by ``_``; null without digits."""
    runs = F.regexp_extract_all(F.col(name) if isinstance(name, str) else name, F.lit(_DIGITS), F.lit(1))
    return F.when(F.size(runs) > 0, F.array_join(runs, "_"))


def time_key(name: Column | str, layout: str) -> Column:
    """The run's time from ``<8 digits>_<6 digits>`` in ``layout``; null when there is none."""
    text = F.nullif(F.regexp_extract(F.col(name) if isinstance(name, str) else name, _STAMP, 1), F.lit(""))
    return F.try_to_timestamp(text, F.lit(layout))


def latest_snapshot(files: DataFrame, order: str = "time", layout: str = "ddMMyyyy_HHmmss") -> DataFrame:
    """The one latest ``name``, with the ``snapshot_key`` that decided; no row if none has a key.

    ``order="time"`` reads the time stamp in the name.  ``order="name"`` compares the digit
    runs as text, takes the greatest, and then the first name that contains it.
    """
    if order == "time":
        keyed = files.select("name", time_key("name", layout).alias("snapshot_key"))
        candidates = keyed.filter(F.col("snapshot_key").isNotNull())
    elif order == "name":
        keyed = files.select("name", name_key("name").alias("key")).filter(F.col("key").isNotNull())
        greatest = keyed.agg(F.max("key")).scalar()
        candidates = keyed.filter(F.col("name").contains(greatest)).select("name", greatest.alias("snapshot_key"))
    else:
        raise ValueError(f"order must be 'time' or 'name', not {order!r}")
    first_names = candidates.groupBy("snapshot_key").agg(F.min("name").alias("name")).select("name", "snapshot_key")
    return first_names.orderBy(F.desc("snapshot_key")).limit(1)


def scan_latest(
    spark: SparkSession, root: str, schema: T.StructType = CLEAN, order: str = "time", layout: str = "ddMMyyyy_HHmmss"
) -> DataFrame:
    """Rows of the latest CSV snapshot under ``root``; only that snapshot is read."""
    found = latest_snapshot(list_snapshots(spark, root), order, layout).head()
    if found is None:
        raise FileNotFoundError(f"no CSV snapshot under {root}")
    return scan_csv(spark, f"{root.rstrip('/')}/{found['name']}", schema)
