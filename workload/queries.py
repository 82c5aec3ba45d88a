"""One entry per query: ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marketweave.functions import parse, text, urls
from marketweave.operators import catalog, pages, products, quality, skew, upsert
from marketweave.plans import run
from marketweave.schemas import CLEAN, LISTING, PRIORITY
from marketweave.session import shared_dir, stage
from marketweave.sources import files, tables

from . import inputs as I
from .inputs import table

ENRICHED = ["page_no", "pos", "product_detail_url", "brand", "description", "total_reviews", "review_score"]


# --- text, values, URLs ----------------------------------------------------------------


def q_slug(spark, sf):
    return I.wide(spark, sf, "documents", "doc_id", "text").select("doc_id", text.slug("text").alias("slug"))


def q_normalize_query(spark, sf):
    docs = I.wide(spark, sf, "documents", "doc_id", "source", "text")
    return docs.select("doc_id", text.normalize_query("source", "text").alias("query"))


def q_safe_key(spark, sf):
    docs = I.wide(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", text.safe_key("text").alias("safe_key"))


def q_search_url(spark, sf):
    docs = I.wide(spark, sf, "documents", "doc_id", "source", "text")
    return docs.select("doc_id", urls.search_url(F.concat(F.lit("https://"), "source"), F.col("text")).alias("search_url"))


def q_page_frontier(spark, sf):
    listed = table(spark, sf, "pages").select("page_id", F.concat("url", F.lit("&n={page}")).alias("template"))
    return catalog.page_frontier(listed, "template", 1, 3).select("page_id", "page_no", "frontier_url")


def q_page_links(spark, sf):
    links = pages.extract_records(collected_pages(spark, sf), I.LINKS, keep=["page_id"])
    return links.filter(pages.has_link("href"))


def q_resolve_url(spark, sf):
    collected = I.wide(spark, sf, "pages", "page_id", "url", "html")
    links = pages.extract_records(collected, I.LINKS, keep=["page_id", "url"])
    return links.select("page_id", "pos", urls.resolve_url("url", "href").alias("resolved"))


def q_resolve_references(spark, sf):
    """References of seven forms, by key, against addresses of two levels."""
    shape, key = F.col("o_orderkey") % 7, F.col("o_custkey").cast("string")
    base = F.concat(F.lit("https://shop.example.com/a/b"), key, F.lit("/page?q=1"))
    href = (
        F.when(shape == 0, F.concat(F.lit("c"), key))
        .when(shape == 1, F.concat(F.lit("../d"), key))
        .when(shape == 2, F.concat(F.lit("//other.example.org/e"), key))
        .when(shape == 3, F.concat(F.lit("?f="), key))
        .when(shape == 4, F.concat(F.lit("./g/../h"), key))
        .when(shape == 5, F.concat(F.lit("http://x.example.net/i"), key, F.lit("#j")))
        .otherwise("")
    )
    return table(spark, sf, "orders").select("o_orderkey", urls.resolve_url(base, href).alias("resolved"))


BLOCKED_HOSTS = [*urls.BLOCKED_DOMAINS, "spam-farm", "cheap-pills"]
BLOCKED_ENDS = [*urls.BLOCKED_EXTENSIONS, ".html"]


def q_block_filter(spark, sf):
    collected = table(spark, sf, "pages")
    kind = F.when(F.col("url").startswith("https"), "document").otherwise("media")
    requests = collected.select("page_id", "url", kind.alias("resource_type"))
    return requests.filter(~urls.is_blocked("url", "resource_type", BLOCKED_ENDS, BLOCKED_HOSTS))


def q_block_links(spark, sf):
    """Requests for the links of each page that pass the filter."""
    collected = I.wide(spark, sf, "pages", "page_id", "url", "html")
    links = pages.extract_records(collected, I.LINKS, keep=["page_id", "url"])
    requests = links.select("page_id", "pos", urls.resolve_url("url", "href").alias("resolved"))
    return requests.filter(~urls.is_blocked("resolved", None, [*BLOCKED_ENDS, "."], BLOCKED_HOSTS))


def q_parse_price(spark, sf):
    lines = I.priced_lines(spark, sf).withColumn("parsed", parse.parse_price("price_text"))
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", "price_text", "parsed.price", "parsed.currency")


def q_parse_reviews(spark, sf):
    shape = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_orderkey").cast("string")
    words = (
        F.when(shape == "1", F.concat(F.lit("1,"), key, F.lit(" ratings")))
        .when(shape == "2", F.concat(F.lit("("), key, F.lit(")")))
        .when(shape == "3", F.lit("no ratings"))
        .when(shape == "4", F.lit(","))
        .otherwise(F.concat(key, F.lit(" of 7")))
    )
    return I.wide(spark, sf, "orders").select("o_orderkey", parse.parse_reviews(words).alias("total_reviews"))


def q_parse_score(spark, sf):
    shape = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_custkey").cast("string")
    words = (
        F.when(shape == "1", F.concat(F.lit("4."), key, F.lit(" out of 5")))
        .when(shape == "2", F.concat(F.lit("score "), key))
        .when(shape == "3", F.lit("no score"))
        .when(shape == "4", F.lit("."))
        .otherwise(F.concat(F.lit("."), key, F.lit("/10")))
    )
    return I.wide(spark, sf, "orders").select("o_orderkey", parse.parse_score(words).alias("review_score"))


def q_compose_description(spark, sf):
    docs = I.wide(spark, sf, "documents", "doc_id", "lang", "text")
    bullets = F.when(F.col("lang") != "en", F.concat(F.lit(" "), "lang"))
    return docs.select("doc_id", text.compose_description(bullets, "text").alias("description"))


def q_strip_text(spark, sf):
    return pages.page_text(collected_pages(spark, sf), keep=["page_id"])


def q_awkward_markup(spark, sf):
    """Text and link of pages with upper-case tags, ``>`` in attributes and rare references."""
    collected = I.awkward_pages(spark, sf)
    links = pages.extract_records(collected, I.FIRST_LINK, keep=["p_partkey"]).select("p_partkey", "href")
    return pages.page_text(collected, keep=["p_partkey"]).join(links, "p_partkey")


def q_parse_date(spark, sf):
    shape, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    written = (
        F.when(shape == "1", F.date_format(day, "yyyy-MM-dd"))
        .when(shape == "2", F.date_format(day, "d/M/yyyy"))
        .when(shape == "3", F.date_format(day, "yyyy/MM/dd"))
        .when(shape == "4", F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    return I.wide(spark, sf, "orders").select("o_orderkey", parse.parse_date(written).cast("string").alias("date_collected"))


def q_coerce_numeric(spark, sf):
    lines = I.priced_lines(spark, sf)
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", parse.coerce_numeric("price_text").alias("price"))


def q_decimal_cast(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf, "lineitem").withColumn("net", net)
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", parse.money("net").cast("string").alias("net_price"))


# --- catalog ---------------------------------------------------------------------------


def customer_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a marketplace with its segment and one category nobody offers."""
    customer = I.wide(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf, "nation")
    markets = customer.select(
        F.col("c_name").alias("marketplace"),
        F.concat(F.lit("https://m"), "c_custkey", F.lit(".example.com")).alias("url"),
        F.array(F.col("c_mktsegment"), F.lit("UNLISTED"), F.col("c_mktsegment")).alias("categories"),
    )
    named = customer.select("c_mktsegment", "c_nationkey").distinct().join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    offers = named.groupBy(F.col("c_mktsegment").alias("category")).agg(F.collect_set("n_name").alias("subcategories"))
    return catalog.expand_catalog(markets, offers)


def q_catalog_expand(spark, sf):
    return customer_listings(spark, sf)


def q_catalog_lookup(spark, sf):
    return catalog.find_listing(customer_listings(spark, sf), "BUILDING", "NATION_7").select("marketplace", "page_url")


def q_page_chain(spark, sf):
    """Pages in the order of their links to the next one: tens of customers, of which some are loops."""
    key = F.col("c_custkey")
    back = F.when(F.floor(key / 10) % 7 == 3, key - 9)
    following = F.when(key % 10 == 9, back).otherwise(key + 1)
    address = lambda k: F.concat(F.lit(f"{I.SHOP}/c/"), k.cast("string"))
    chained = table(spark, sf, "customer").select("c_custkey", address(key).alias("url"), address(following).alias("next_url"))
    return catalog.page_order(chained).select("c_custkey", "first_url", "page_no")


# --- pages -----------------------------------------------------------------------------


def collected_pages(spark: SparkSession, sf: str) -> DataFrame:
    return I.wide(spark, sf, "pages", "page_id", "html")


def q_page_region(spark, sf):
    found = pages.extract_records(collected_pages(spark, sf), I.ARTICLE, keep=["page_id"])
    return found.select("page_id", "title")


def q_page_cards(spark, sf):
    cards = pages.extract_records(collected_pages(spark, sf), I.MENU, keep=["page_id"])
    return cards.filter(pages.has_link()).select("page_id", "pos", "href", "label")


def q_page_detail(spark, sf):
    found = pages.extract_records(collected_pages(spark, sf), I.ARTICLE, keep=["page_id"])
    return found.select("page_id", "ad", F.array_join("menu", "\n").alias("menu"), F.isnull("no_such").alias("absent"))


def q_product_details(spark, sf):
    return products.detail_rows(I.customer_pages(spark, sf))


def q_card_project(spark, sf):
    return run.extract(I.order_pages(spark, sf), I.order_listings(spark, sf), I.RUN_DATE)


def q_skip_malformed(spark, sf):
    cards = products.page_cards(I.order_pages(spark, sf), keep=["page_no"])
    good, quarantine = quality.split_malformed(cards, F.col("malformed"))
    return quarantine.select("page_no", "pos", "href")


def q_page_errors(spark, sf):
    """Menu links of pages kept as bytes, of which some are no text, with the reason in their place."""
    broken = F.concat(F.unhex(F.lit("FF")), F.encode("html", "UTF-8"))
    raw = collected_pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 7 == 3, broken).otherwise(F.encode("html", "UTF-8")))
    found = pages.extract_records(raw, I.MENU, keep=["page_id"], error="error")
    found = found.filter(F.col("error").isNotNull() | pages.has_link())
    return found.select("page_id", "pos", "href", "label", F.substring_index("error", ":", 1).alias("error"))


def q_skip_malformed_jvm(spark, sf):
    """The same cards from pages without a Python worker, but for a third that hold a comment."""
    comment = F.when(F.col("page_no") % 3 == 0, "<!-- > -->").otherwise("")
    collected = I.order_pages(spark, sf).withColumn("html", F.concat("html", comment))
    cards = products.page_cards(collected, keep=["page_no"], jvm=True)
    return quality.split_malformed(cards, F.col("malformed"))[1].select("page_no", "pos", "href")


def q_card_project_jvm(spark, sf):
    cards = products.page_cards(I.order_pages(spark, sf), keep=["page_url", "page_no"], jvm=True)
    return run.listed(cards, I.order_listings(spark, sf), I.RUN_DATE)


def q_product_details_jvm(spark, sf):
    return products.detail_rows(I.customer_pages(spark, sf), jvm=True)


# --- enrichment, limits ----------------------------------------------------------------


def q_enrich_left(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").alias("quality"))
    labels = table(spark, sf, "labels").select("doc_id", "quality", F.col("toxic").cast("double"))
    return products.enrich(docs, labels, key="doc_id")


def q_enrich_pages(spark, sf):
    found = run.extract(I.order_pages(spark, sf), I.order_listings(spark, sf), I.RUN_DATE)
    return run.transform(found, I.customer_pages(spark, sf), ["collected"], limit=None).select(*ENRICHED)


def q_enrich_recollected(spark, sf):
    """Two collected pages per product: the first one counts."""
    found = run.extract(I.order_pages(spark, sf), I.order_listings(spark, sf), I.RUN_DATE)
    return run.transform(found, I.recollected_pages(spark, sf), ["collected"], limit=None).select(*ENRICHED)


def q_enrich_stored_pages(spark, sf):
    """Details from pages that are stored by their address: the chosen products come to them."""
    name = "pages_" + uuid.uuid4().hex
    stored = tables.save_by_key(I.recollected_pages(spark, sf), name, "url", 16)
    found = run.extract(I.order_pages(spark, sf), I.order_listings(spark, sf), I.RUN_DATE)
    return run.transform(found, stored, ["collected"], limit=5).select(*ENRICHED)


def q_enrich_hot(spark, sf):
    """A key that owns a third of the rows, and as many rows without a key."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 3 == 1, F.col("l_partkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key.alias("key"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), "p_brand")
    return products.enrich(lines, part, key="key")


def q_first_n(spark, sf):
    return skew.first_n(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], 5)


def q_first_n_large(spark, sf):
    return skew.first_n(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], 500)


def q_first_n_huge(spark, sf):
    return skew.first_n(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], 5000)


def q_preview(spark, sf):
    return table(spark, sf, "lineitem").orderBy(*LINE_ORDER).limit(3)


# --- quality ---------------------------------------------------------------------------

LINE_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def q_missing_profile(spark, sf):
    return quality.missing_profile(I.gappy_events(spark, sf))


def q_missing_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("category"),
        F.col("l_linestatus").alias("subcategory"),
        F.col("l_extendedprice").alias("price"),
    )
    absent = quality.missing_columns(lines.columns, PRIORITY)
    rows = lines.groupBy("category").agg(F.count(F.lit(1)).alias("rows_without"))
    return rows.withColumn("column", F.explode(F.array(*map(F.lit, absent))))


def q_dropna_subset(spark, sf):
    return quality.drop_incomplete(I.gappy_events(spark, sf), ["event_type", "value", "props"])


def q_select_priority(spark, sf):
    return quality.select_priority(table(spark, sf, "part"), ["p_type", "p_brand", "p_name"])


def q_dedupe_keep_first(spark, sf):
    return quality.dedupe_keep_first(table(spark, sf, "lineitem"), ["l_partkey", "l_returnflag"], LINE_ORDER)


def q_dedupe_missing_equal(spark, sf):
    events = I.gappy_events(spark, sf)
    first = quality.dedupe_keep_first(events, ["user_id", "event_type", "value"], ["event_id"])
    return first.select("event_id", "user_id", "event_type")


def q_run_counts(spark, sf):
    links = pages.extract_records(collected_pages(spark, sf), I.LINKS, keep=["page_id"])
    return quality.run_counts(links, "page_id", "href")


# --- files -----------------------------------------------------------------------------

DOC_FIELDS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "currency", "category")] + [T.StructField("price", T.DoubleType())]
)


def document_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("text").alias("name"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("currency"),
        F.col("source").alias("category"),
        F.col("n_chars").cast("double").alias("price"),
    )


def q_scan_json(spark, sf):
    path = f"{shared_dir(spark)}/products.json"
    files.write_json(document_products(spark, sf), path)
    return files.scan_products(spark, path, DOC_FIELDS).drop(files.SOURCE_POS)


def q_json_partitions(spark, sf):
    path = f"{shared_dir(spark)}/products.json"
    keyed = document_products(spark, sf).withColumn("category_key", text.safe_key("category"))
    files.write_json(keyed, path, partition_by=["category_key"], order=["price", "name", "currency"])
    back = files.scan_products(spark, path, T.StructType([*DOC_FIELDS, T.StructField("category_key", T.StringType())]))
    return back.groupBy("category_key").agg(F.count("name").alias("products"), F.sum("price").alias("price_sum"))


def listing_of_documents(spark: SparkSession, sf: str, lang: str | None = None) -> DataFrame:
    found = table(spark, sf, "documents")
    found = found if lang is None else found.filter(F.col("lang") == lang)
    blank = {c: F.lit(None).cast(LISTING[c].dataType) for c in LISTING.names}
    return found.select("doc_id", *[{
        **blank, "name": F.col("text"), "marketplace": F.lit("Shop"), "category": F.col("lang"), "subcategory": F.col("source"),
    }[c].alias(c) for c in LISTING.names])


def q_json_two_listings(spark, sf):
    """A listing written after another leaves it; written again, it replaces its own rows."""
    root = f"{shared_dir(spark)}/listings"
    files.write_listings(listing_of_documents(spark, sf, "de"), root, order=["doc_id"])
    files.write_listings(listing_of_documents(spark, sf, "fr"), root, order=["doc_id"])
    again = listing_of_documents(spark, sf, "de").withColumn("name", F.length("name").cast("string"))
    files.write_listings(again, root, order=["doc_id"])
    back = files.scan_products(spark, root)
    return back.select("name", "category", "subcategory")


def q_listing_emptied(spark, sf):
    """Two runs: in the second the German listings are empty and the French ones failed."""
    root = f"{shared_dir(spark)}/listings"
    docs = listing_of_documents(spark, sf)
    listings = docs.select("marketplace", "category", "subcategory").distinct()
    files.write_listings(docs, root, order=["doc_id"], listings=listings, run="first")
    again = docs.filter("category <> 'de'").withColumn("name", F.length("name").cast("string"))
    failed = listings.withColumn("failed", F.col("category") == "fr")
    files.write_listings(again, root, order=["doc_id"], listings=failed, run="second")
    return files.scan_products(spark, root).select("name", "category", "subcategory")


def q_listing_manifest(spark, sf):
    """What became of each listing of a run in which some are empty and some failed."""
    docs = listing_of_documents(spark, sf)
    listings = docs.select("marketplace", "category", "subcategory").distinct()
    some = docs.filter("category <> 'de'")
    failed = listings.withColumn("failed", F.col("category") == "fr")
    return files.run_manifest(some, failed).select("category_key", "subcategory_key", "products", "state")


def q_scan_latest(spark, sf):
    """Two written snapshots; the later one is read."""
    root = shared_dir(spark)
    rows = enriched_documents(spark, sf)
    files.write_csv(rows.limit(3), f"{root}/final_docs_31122024_235959.csv")
    files.write_csv(rows, f"{root}/final_docs_01012025_000000.csv")
    return files.scan_latest(spark, root).select("name", "price", "category", "product_detail_url")


def q_scan_csv(spark, sf):
    path = f"{shared_dir(spark)}/products.csv"
    files.write_csv(document_products(spark, sf), path)
    return files.scan_csv(spark, path, DOC_FIELDS).drop(files.SOURCE_POS)


def q_scan_csv_ranges(spark, sf):
    """The same file read in byte ranges; its texts hold line breaks and quotes."""
    path = f"{shared_dir(spark)}/products.csv"
    files.write_csv(document_products(spark, sf), path)
    return files.scan_csv_ranges(spark, path, DOC_FIELDS).drop(files.SOURCE_POS)


def q_latest_snapshot_lex(spark, sf):
    return files.latest_snapshot(I.snapshot_names(spark, sf), order="name")


def q_latest_snapshot_time(spark, sf):
    found = files.latest_snapshot(I.snapshot_names(spark, sf), order="time")
    return found.select("name", F.date_format("snapshot_key", "yyyy-MM-dd HH:mm:ss").alias("snapshot_key"))


# --- target table ----------------------------------------------------------------------


def q_conform_schema(spark, sf):
    lines = I.wide(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber").alias("name"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("currency"),
        F.col("l_linestatus").alias("category"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("date_collected"),
        F.col("l_tax").alias("review_score"),
        F.col("l_suppkey").alias("dropped_column"),
    )
    rows = upsert.conform(lines)
    money = {c: F.col(c).cast("string") for c in ("price", "review_score", "total_reviews")}
    return rows.withColumns({**money, "date_collected": F.date_format("date_collected", "yyyy-MM-dd HH:mm:ss")})


def q_upsert_insert_only(spark, sf):
    batch = I.keyed_documents(spark, sf)
    target = batch.join(table(spark, sf, "labels"), "doc_id", "left_semi").select("product_detail_url")
    return upsert.rows_to_insert(batch, target, ["doc_id"]).select("doc_id", "source")


def enriched_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as clean products: one column of text, a number, and a key."""
    values = {
        "name": F.col("source"), "price": F.col("n_chars").cast("double"), "category": F.col("lang"),
        "product_detail_url": F.concat(F.lit("/d/"), "doc_id"), "date_collected": F.lit(I.RUN_DATE),
    }
    missing = {f.name: F.lit(None).cast(f.dataType) for f in CLEAN}
    return table(spark, sf, "documents").select(*[{**missing, **values}[c].alias(c) for c in CLEAN.names])


def _fresh_table(spark: SparkSession) -> str:
    return "products_" + uuid.uuid4().hex


def q_insert_twice(spark, sf):
    """Batches that overlap, one after the other: the first row of a key stays, ids differ."""
    name = _fresh_table(spark)
    rows = enriched_documents(spark, sf)
    tables.create_table(spark, name)
    key = F.when(F.col("category") != "de", F.col("product_detail_url"))
    for turn, batch in enumerate((rows.filter("price < 3000"), rows)):
        offered = batch.withColumn("product_detail_url", key).withColumn("currency", F.lit(f"turn {turn}"))
        conformed = upsert.conform(offered).withColumn("product_detail_url", F.nullif("product_detail_url", F.lit("")))
        tables.insert_new(stage(conformed, "batch"), name, ["name", "price"])
    found = spark.table(name)
    counts = [F.count(F.lit(1)).alias("rows_in"), F.count_distinct("id").alias("ids")]
    whole = found.agg(*counts).select(F.lit("all").alias("currency"), F.lit("all").alias("category"), "rows_in", "ids")
    return found.groupBy("currency", "category").agg(*counts).unionByName(whole)


def q_write_products_db(spark, sf):
    name = _fresh_table(spark)
    tables.write_products(enriched_documents(spark, sf), "db", table=name, buckets=4)
    tables.write_products(enriched_documents(spark, sf), "db", table=name, buckets=4)
    return spark.table(name).select("name", F.col("price").cast("string").alias("price"), "product_detail_url")


def q_write_products_dir(spark, sf):
    path = f"{shared_dir(spark)}/final_docs_01012025_000000.csv"
    tables.write_products(enriched_documents(spark, sf), "dir", path=path)
    return files.scan_csv(spark, path, CLEAN).select("name", "price", "product_detail_url")


def q_upsert_by_parts(spark, sf):
    """Batches into a table that is partitioned by key: the second adds what the first lacks."""
    name = _fresh_table(spark)
    rows = enriched_documents(spark, sf)
    for batch in (rows.filter("price < 3000"), rows):
        tables.write_products(batch, "db", table=name, parts=16)
    found = spark.table(name)
    return found.select("name", F.col("price").cast("string").alias("price"), "product_detail_url")


def q_constraint_check(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.when(F.col("lang") != "fr", F.col("source")).alias("name"),
        F.when(F.col("n_chars") > 100, F.col("n_chars")).alias("price"),
        F.when(F.col("lang") != "de", F.col("text")).alias("product_detail_url"),
    )
    return upsert.constraint_violations(docs)


# --- whole run -------------------------------------------------------------------------


def full_run(spark: SparkSession, sf: str, limit: int | None = 5) -> run.Run:
    """A run whose catalog lacks one nation's listings."""
    listings = I.order_listings(spark, sf).filter("subcategory <> 'NATION_7'")
    return run.full_run(I.order_pages(spark, sf), listings, I.customer_pages(spark, sf), I.RUN_DATE, ["collected"], limit)


def q_run_profile(spark, sf):
    return full_run(spark, sf).profile


def q_run_summary(spark, sf):
    return full_run(spark, sf).summary


def q_run_quarantine(spark, sf):
    return full_run(spark, sf).quarantine.select("page_no", "pos", "href")


def q_listing_run(spark, sf, limit=5):
    collected, listings = I.order_pages(spark, sf), I.order_listings(spark, sf)
    found = run.listing_run(collected, listings, I.customer_pages(spark, sf), I.RUN_DATE, ["collected"], limit)
    return found.select(*CLEAN.names)


def q_listing_run_all(spark, sf):
    return q_listing_run(spark, sf, limit=None)


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("q_")}
