import csv
import json
import random
import re
import uuid
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from marketweave.operators import upsert
from marketweave.plans import run
from marketweave.operators.quality import dedupe_keep_first
from marketweave.operators.upsert import conform, rows_to_insert
from marketweave.schemas import CLEAN, ENRICHED, LISTING, TABLE
from marketweave.session import shared_dir, stage
from marketweave.sources import files, tables

from test_quality import enriched


def test_json_array_and_order(spark, tmp_path):
    for name, names in {"b.json": ["x", "y"], "a.json": ["p", "q", "r"]}.items():
        (tmp_path / name).write_text(json.dumps([{"name": n, "price": 1.5} for n in names], indent=3))
    (tmp_path / "c.json").write_text("null")
    df = files.scan_products(spark, str(tmp_path), multiline=True)
    assert df.columns == [*LISTING.names, files.SOURCE_POS]
    assert [r["name"] for r in df.orderBy(files.SOURCE_POS).collect()] == ["p", "q", "r", "x", "y"]


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_products(spark, str(tmp_path / "nowhere"))


def test_json_lines_keep_order_over_splits(spark, tmp_path):
    df = spark.range(5000).select(F.format_string("n%05d", "id").alias("name"), F.col("id").alias("pos"))
    files.write_json(df, str(tmp_path / "out"), order=["pos"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        back = files.scan_products(spark, str(tmp_path / "out"))
        assert back.rdd.getNumPartitions() > 4
        names = [r["name"] for r in back.orderBy(files.SOURCE_POS).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert names == [f"n{i:05d}" for i in range(5000)]


def test_json_by_listing_replaces_and_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    df = enriched(spark, [{"category": "a"}, {"category": "b", "brand": None}, {"category": "b"}])
    for _ in range(2):
        files.write_json(df, path, partition_by=["marketplace", "category"], order=["pos"])
    assert sorted(p.name for p in (tmp_path / "out" / "marketplace=m").iterdir()) == ["category=a", "category=b"]
    back = files.scan_products(spark, path, ENRICHED)
    assert back.count() == 3 and back.filter("brand is null").count() == 1
    texts = spark.read.text(path).collect()
    assert sum('"brand":null' in r[0] for r in texts) == 1


def test_listing_folders(spark, tmp_path):
    rows = [{"category": "pet food", "subcategory": "dry & wet", "name": f"n{i}"} for i in range(6)]
    df = enriched(spark, rows + [{"category": "other"}])
    files.write_listings(df, str(tmp_path / "out"), order=["pos"])
    folder = tmp_path / "out" / "marketplace_key=m" / "category_key=pet_food" / "subcategory_key=dry_wet"
    assert folder.is_dir()
    back = files.scan_products(spark, str(folder), ENRICHED).orderBy(files.SOURCE_POS)
    assert back.columns == [*ENRICHED.names, files.SOURCE_POS]
    assert [(r["name"], r["category"], r["subcategory"]) for r in back.collect()] == [
        (f"n{i}", "pet food", "dry & wet") for i in range(6)
    ]


def test_hot_listing_is_cut_into_files(spark, tmp_path):
    df = spark.range(20000).select(F.lit("hot").alias("category"), F.lit("n").alias("name"), F.col("id").alias("pos"))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        files.write_json(df, str(tmp_path / "out"), partition_by=["category"], order=["pos"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert len(list((tmp_path / "out" / "category=hot").glob("part-*.json"))) >= 3


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "final_x_01012025_000000.csv")
    text = 'line1\nline2 "q", z\\n \\" end '
    df = enriched(spark, [{"description": text, "currency": "", "brand": None, "total_reviews": float("nan")}, {}])
    files.write_csv(df.select(*CLEAN.names, "pos"), path, order=["pos"])
    rows = files.scan_csv(spark, path).orderBy(files.SOURCE_POS).collect()
    assert len(rows) == 2
    row = rows[0]
    assert row["description"] == text
    assert row["currency"] is None and row["brand"] is None and row["total_reviews"] is None
    assert row["price"] == 12.5 and rows[1]["brand"] == "acme"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_csv(df, path)


def test_csv_bytes(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame([("a,b", None, 1.0), ('q"q', "", 2.5), (" s ", "x", None)], "a string, b string, c double")
    files.write_csv(df.coalesce(1), str(path))
    written = next(path.glob("part-*.csv")).read_text()
    assert written == 'a,b,c\n"a,b",,1.0\n"q""q",,2.5\n s ,x,\n'


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('price,name,other\n12.5,"x\ny",1\n,z,\n')
    df = files.scan_csv(spark, str(tmp_path / "a.csv"))
    assert df.dtypes[:3] == [("price", "double"), ("name", "string"), ("other", "string")]
    assert [tuple(r)[:3] for r in df.orderBy(files.SOURCE_POS).collect()] == [(12.5, "x\ny", "1"), (None, "z", None)]
    assert conform(df).head()["brand"] == "" and conform(df.filter("price is null")).head()["price"] is None
    (tmp_path / "b.csv").write_text("name,price,other\nx,1,2\n")
    with pytest.raises(Exception):
        files.scan_csv(spark, str(tmp_path)).collect()


NAMES = ["final_x_31122024_000000.csv", "final_x_01012025_000000.csv", "notes.csv", "final_x_02012025_000000.txt"]


@pytest.mark.parametrize("order, expected", [("name", NAMES[0]), ("time", NAMES[1])])
def test_latest_snapshot(spark, tmp_path, order, expected):
    for n in NAMES:
        (tmp_path / n).write_text(f"name\n{n}\n")
    schema = LISTING.__class__([LISTING["name"]])
    rows = files.scan_latest(spark, str(tmp_path), schema, order).collect()
    assert [r["name"] for r in rows] == [expected]
    listed = files.list_snapshots(spark, str(tmp_path))
    assert sorted(r["name"] for r in listed.collect()) == sorted(NAMES[:3])


def test_latest_snapshot_of_written_folders(spark, tmp_path):
    df = enriched(spark, [{}]).select(*CLEAN.names)
    for day in (1, 2):
        files.write_csv(df.withColumn("name", F.lit(f"day {day}")), tables.snapshot_path(str(tmp_path), "x", datetime(2025, 1, day)))
    assert [r["name"] for r in files.scan_latest(spark, str(tmp_path)).collect()] == ["day 2"]


def test_no_snapshot_is_an_error(spark, tmp_path):
    (tmp_path / "notes.csv").write_text("name\n")
    for order in ("name", "time"):
        with pytest.raises(FileNotFoundError):
            files.scan_latest(spark, str(tmp_path), order=order)
    with pytest.raises(ValueError):
        files.latest_snapshot(spark.createDataFrame([("a",)], "name string"), "size")


def test_table_upsert(spark):
    table = tables.table_name("data/pet-food/dry-food")
    assert table == "dry_food"
    rows = [{"product_detail_url": u, "name": n} for u, n in [("u1", "a"), ("u1", "b"), (None, "c"), (None, "c"), ("u2", "d")]]
    df = enriched(spark, rows).select(*CLEAN.names, "pos")
    tables.write_products(df, "db", table=table, order=["pos"])
    tables.create_table(spark, table)
    offered = tables.insert_new(conform(df.filter("pos < 3"), keep=["pos"]), table, ["pos"])
    assert offered == 3
    stored = spark.table(table)
    assert stored.columns == ["id", *TABLE.names]
    assert sorted(r["name"] for r in stored.collect()) == ["a", "c", "c", "c", "d"]
    assert stored.select("id").distinct().count() == 5
    with pytest.raises(ValueError, match="price not null: 1"):
        tables.insert_new(conform(enriched(spark, [{"price": None}]), keep=["pos"]), table, ["pos"])
    assert spark.table(table).count() == 5


def test_upsert_does_not_move_a_bucketed_table(spark):
    tables.create_table(spark, "bucketed", buckets=4)
    df = enriched(spark, [{"product_detail_url": f"u{i % 20}", "name": f"n{i}"} for i in range(40)] + [{"product_detail_url": None}])
    batch = conform(df, keep=["pos"])
    tables.insert_new(batch.filter("pos < 10"), "bucketed", ["pos"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = rows_to_insert(batch, spark.table("bucketed"), ["pos"])
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        tables.insert_new(batch, "bucketed", ["pos"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["name"] for r in spark.table("bucketed").collect()) == sorted([f"n{i}" for i in range(20)] + ["cat food"])


def test_destinations(spark, tmp_path):
    df = enriched(spark, [{}]).select(*CLEAN.names, "pos")
    path = str(tmp_path / "final_x_01012025_000000.csv")
    tables.write_products(df, "dir", path=path, order=["pos"])
    assert files.scan_latest(spark, str(tmp_path)).count() == 1
    for bad in ({"destination": "xlsx"}, {"destination": "dir"}, {"destination": "db"}, {"destination": "db", "table": "a b"}):
        with pytest.raises(ValueError):
            tables.write_products(df, **bad)


def test_products_reach_folder_and_table(spark, tmp_path):
    """JSON rows -> clean CSV snapshot -> table, as one listing's load."""
    rows = [{"name": "a", "date_collected": "2025-07-05"}, {"name": "a"}, {"name": "b", "brand": None}, {"name": "c", "product_detail_url": "v"}]
    files.write_json(enriched(spark, rows), str(tmp_path / "rich"), order=["pos"])
    rich = files.scan_products(spark, str(tmp_path / "rich"), ENRICHED)
    clean = run.load(rich, order=[files.SOURCE_POS])
    assert clean.columns == [*CLEAN.names, files.SOURCE_POS]
    path = tables.snapshot_path(str(tmp_path / "out"), "m_c_s", datetime(2025, 7, 5, 2, 39, 18))
    tables.write_products(clean, "dir", path=path, order=[files.SOURCE_POS])
    latest = files.scan_latest(spark, str(tmp_path / "out"))
    tables.write_products(latest, "db", table="c_s", order=[files.SOURCE_POS])
    stored = spark.table("c_s").orderBy("name").collect()
    assert [(r["name"], str(r["price"]), str(r["date_collected"])) for r in stored] == [
        ("a", "12.50", "2025-07-05 00:00:00"), ("c", "12.50", "2025-07-05 00:00:00"),
    ]
    assert stored[0]["about"] == "" and stored[0]["marketplace_name"] == ""


def test_database_statements():
    """The statements as another engine understands them, apart from its number generator."""
    con = duckdb.connect()
    con.execute("CREATE SEQUENCE ids")
    con.execute(tables.table_ddl("t").replace("SERIAL", "INTEGER DEFAULT nextval('ids')"))
    con.execute("CREATE TABLE s AS SELECT * EXCLUDE id FROM t")
    for url in ("u1", "u2", "u1", None):
        con.execute("INSERT INTO s (name, price, product_detail_url) VALUES ('n', 1, ?)", [url])
    con.execute(tables.merge_sql("t", "s"))
    con.execute(tables.merge_sql("t", "s"))
    assert con.execute("SELECT count(*), count(product_detail_url) FROM t").fetchone() == (4, 2)


def test_stage_and_shared_dir(spark):
    root = shared_dir(spark)
    assert root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) != root
    staged = stage(spark.range(10), "numbers", root)
    assert staged.count() == 10 and staged.inputFiles()[0].startswith(f"file://{root}/numbers")


def test_a_listing_replaces_only_itself(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = lambda sub, name: enriched(spark, [{"name": name, "marketplace": "m", "category": "c", "subcategory": sub}])
    for sub, name in (("dry food", "a"), ("wet food", "b"), ("dry food", "c")):
        files.write_listings(rows(sub, name), root)
        files.write_json(rows(sub, name), root + "2", partition_by=["subcategory"])
    assert sorted(r["name"] for r in files.scan_products(spark, root).collect()) == ["b", "c"]
    assert sorted(r["name"] for r in files.scan_products(spark, root + "2").collect()) == ["b", "c"]


def test_ordered_sinks_read_their_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id", "cast(id as string) as name").mapInArrow(counted, "id long, name string")
    files.write_json(df, str(tmp_path / "out"), order=["id"])
    assert seen.value == 1000


def test_keep_first_from_files(spark, tmp_path):
    lines = [{"name": "a", "price": 1.0, "url": str(i)} for i in range(3)]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, lines)))
    df = files.scan_products(spark, str(tmp_path / "x.json"))
    assert [r["url"] for r in dedupe_keep_first(df, ["name"], [files.SOURCE_POS]).collect()] == ["0"]


# --- listings of a run -----------------------------------------------------------------


def listed(spark, rows):
    rows = [(n, "Shop", c, s, i) for i, (n, c, s) in enumerate(rows)]
    return spark.createDataFrame(rows, "name string, marketplace string, category string, subcategory string, at int")


def test_an_emptied_listing_clears_its_folder(spark, tmp_path):
    root = str(tmp_path / "listings")
    all_ = spark.createDataFrame([("Shop", "A & b", s) for s in ("x", "y", "z")] + [("Shop", "c", "x"), ("Shop", "n", None)], "marketplace string, category string, subcategory string")
    first = listed(spark, [("one", "A & b", "x"), ("two", "A & b", "y"), ("three", "A & b", "z"), ("four", "c", "x"), ("five", "n", None)])
    done = files.write_listings(first, root, order=["at"], listings=all_, run="1")
    assert {r.state for r in done.collect()} == {"written"} and sum(r.products for r in done.collect()) == 5
    failed = all_.withColumn("failed", (F.col("subcategory") == "y") | (F.col("category") == "c"))
    second = listed(spark, [("new", "A & b", "x"), ("part of a failed one", "c", "x"), ("unknown", "d", "x")])
    done = files.write_listings(second, root, order=["at"], listings=failed, run="2")
    states = {(r.category_key, r.subcategory_key): (r.products, r.state) for r in done.collect()}
    assert states == {
        ("A_b", "x"): (1, "written"), ("A_b", "y"): (0, "kept"), ("A_b", "z"): (0, "emptied"), ("c", "x"): (1, "kept"), ("d", "x"): (1, "written"), ("n", ""): (0, "emptied"),
    }
    kept = sorted(r["name"] for r in files.scan_products(spark, root).collect())
    assert kept == ["five", "four", "new", "two", "unknown"] or kept == ["four", "new", "two", "unknown"]
    logged = spark.read.json(f"{root}/_manifest").groupBy("run").count().collect()
    assert {(r["run"], r["count"]) for r in logged} == {("1", 5), ("2", 6)}


def test_listings_that_all_came_out_empty(spark, tmp_path):
    root = str(tmp_path / "listings")
    rows = listed(spark, [("one", "a", "x"), ("two", "b", "x")])
    names = rows.select("marketplace", "category", "subcategory")
    files.write_listings(rows, root, listings=names)
    assert files.scan_products(spark, root).count() == 2
    files.write_listings(rows.limit(0), root, listings=names)
    assert files.scan_products(spark, root).count() == 0


# --- a target that is partitioned by key -----------------------------------------------


def test_an_upsert_reads_the_parts_its_batch_touches(spark):
    name = "parted_" + uuid.uuid4().hex
    tables.create_table(spark, name, parts=32)
    order = ["name"]
    wide = [(f"n{i}", 1.0, f"/p/{i}" if i else None) for i in range(400)]
    rows = lambda some: upsert.conform(spark.createDataFrame(some, "name string, price double, product_detail_url string"))
    assert tables.insert_new(stage(rows(wide), "batch"), name, order) == 400
    batch = stage(rows([("again", 2.0, "/p/7"), ("new", 2.0, "/p/new"), ("keyless", 2.0, None), ("new too", 3.0, "/p/new")]), "batch")
    touched = upsert.touched_parts(batch, spark.table(name), 32)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*key_part", plan) and "GreaterThanOrEqual(product_detail_url" in plan
    read = len(touched.inputFiles())
    assert 0 < read <= 2 * max(1, len(spark.table(name).inputFiles()) // 32) + 2 < len(spark.table(name).inputFiles())
    assert tables.insert_new(batch, name, order) == 4
    found = spark.table(name)
    assert found.count() == 402 and found.select("id").distinct().count() == 402
    assert [r["name"] for r in found.filter("product_detail_url = '/p/7'").collect()] == ["n7"]
    assert [r["name"] for r in found.filter("product_detail_url = '/p/new'").collect()] == ["new"]
    assert found.filter("product_detail_url is null").count() == 2
    nothing = stage(rows([("keyless", 2.0, None)]), "batch")
    assert tables.insert_new(nothing, name, order) == 1 and spark.table(name).count() == 403
    with pytest.raises(ValueError):
        tables.insert_new(stage(rows([(None, 2.0, "/p/x")]), "batch"), name, order)


# --- ranges of large files -------------------------------------------------------------


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "700b"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_csv_file_is_read_in_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    words = ["plain", 'with "quotes"', "a,b", "two\nlines", "", "\n\n", '"', "long " * 300, "é", " spaced ", "x\n" * 200]
    rows = [{"name": f"n{i}", "currency": rng.choice(words) or None, "category": rng.choice(words) or None, "price": i / 2} for i in range(300)]
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="") as file:
            writer = csv.DictWriter(file, list(rows[0]), lineterminator="\n" if part else "\r\n")
            writer.writeheader()
            writer.writerows(rows[part::2])
    schema = "name string, currency string, category string, price double"
    kinds = T.StructType.fromDDL(schema)
    found = files.scan_csv_ranges(spark, str(tmp_path), kinds)
    got = [tuple(r)[:4] for r in found.orderBy(files.SOURCE_POS).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert [r[0] for r in got] == [r["name"] for part in range(2) for r in rows[part::2]]
    assert sorted(got, key=key) == sorted((tuple(r.values()) for r in rows), key=key)
    assert found.select(files.SOURCE_POS).distinct().count() == 300
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.select("_metadata.file_block_start").distinct().count() > 20
    assert found.schema.simpleString().startswith("struct<name:string,currency:string,category:string,price:double,source_pos:struct<file")


def test_ranges_of_odd_csv_files(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("name,price\n")
    assert files.scan_csv_ranges(spark, str(tmp_path / "a.csv")).count() == 0
    (tmp_path / "b.csv").write_text('name,price\n\nx,1\n\ny,"2"')
    assert [(r["name"], r["price"]) for r in files.scan_csv_ranges(spark, str(tmp_path / "b.csv")).orderBy(files.SOURCE_POS).collect()] == [("x", 1.0), ("y", 2.0)]
    (tmp_path / "c.csv").write_text('name,price\nx,"never closed' + "\nmore" * 400)
    assert files.scan_csv_ranges(spark, str(tmp_path / "c.csv")).count() == 1
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("name,price\nx,1\n")
    (tmp_path / "d" / "2.csv").write_text("price,name\n1,x\n")
    with pytest.raises(Exception, match="unexpected header"):
        files.scan_csv_ranges(spark, str(tmp_path / "d")).collect()
