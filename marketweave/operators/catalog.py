"""Category catalog: search URL per marketplace, category and subcategory."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text, urls
from ..session import shared_dir, stage
from .skew import join_unique

# The default catalog.
MARKETPLACES = [
    (
        "amazonae",
        "https://www.amazon.ae",
        ["pet food", "pet accessories", "pet health & grooming", "pet toys & entertainment"],
    ),
]
SUBCATEGORIES = [
    ("pet food", ["dry food", "wet food"]),
    ("pet accessories", ["collars & leashes", "pet bowls & containers", "carriers & travel gear"]),
    ("pet health & grooming", ["supplements & vitamins", "treatments", "pet toiletries"]),
    ("pet toys & entertainment", ["chew toys & balls", "interactive toys", "scratching posts"]),
]

PAGE_MARK = "{page}"


def default_catalog(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    markets = pa.table(list(zip(*MARKETPLACES)), names=["marketplace", "url", "categories"])
    offers = pa.table(list(zip(*SUBCATEGORIES)), names=["category", "subcategories"])
    return spark.createDataFrame(markets), spark.createDataFrame(offers)


def expand_catalog(marketplaces: DataFrame, subcategories: DataFrame, marketplace: str | None = None) -> DataFrame:
    """One row per listing: its names, search words, search URL and path keys.

    Marketplaces and categories are unique in their tables.  A category without
    subcategories has no listing, an unknown marketplace has none at all.  No side is
    forced to be broadcast: Spark does so while the size it sees allows it.
    """
    if marketplace is not None:
        marketplaces = marketplaces.filter(F.col("marketplace") == marketplace)
    wanted = marketplaces.select(
        "marketplace",
        "url",
        text.slug("marketplace").alias("market_slug"),
        F.explode(F.array_distinct("categories")).alias("category"),
    )
    # Words and keys depend on category and subcategory alone: made once, not once per marketplace.
    offered = subcategories.select(
        "category", F.transform(F.array_distinct("subcategories"), lambda s: _offer(F.col("category"), s)).alias("offers")
    )
    listings = join_unique(wanted, offered, "category", "inner").select("*", F.inline("offers"))
    return listings.select(
        "marketplace",
        "url",
        "category",
        "subcategory",
        "query",
        urls.search_url_of("url", "encoded").alias("page_url"),
        F.translate(F.trim(F.concat("market_slug", F.lit(" "), "query")), " ", "_").alias("slug"),
        "category_key",
        "subcategory_key",
    )


def _offer(category: Column, subcategory: Column) -> Column:
    query = text.normalize_query(category, subcategory)
    return F.struct(
        subcategory.alias("subcategory"),
        query.alias("query"),
        urls.form_encode(query).alias("encoded"),
        text.safe_key(category).alias("category_key"),
        text.safe_key(subcategory).alias("subcategory_key"),
    )


def find_listing(listings: DataFrame, category: str, subcategory: str) -> DataFrame:
    """The listing of one category and subcategory; an unknown pair is an error."""
    found = listings.filter((F.col("category") == category) & (F.col("subcategory") == subcategory))
    if found.isEmpty():
        raise LookupError(f"no search query for category {category!r} and subcategory {subcategory!r}")
    return found


def page_frontier(listings: DataFrame, template: str, first: int = 1, last: int = 1) -> DataFrame:
    """One row per page number: ``page_no`` and the URL from the ``{page}`` template column."""
    numbered = listings.withColumn("page_no", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return numbered.withColumn(
        "frontier_url", F.replace(F.col(template), F.lit(PAGE_MARK), F.col("page_no").cast("string"))
    )


def page_order(pages: DataFrame, root: str | None = None, key: str = "url", following: str = "next_url") -> DataFrame:
    """``pages`` with ``first_url`` and ``page_no``: the order that the links to the next page give.

    A listing starts at a page that no other page links to, and ends where a link is missing, empty,
    or leads to no page of the table.  Numbers come from list ranking: every page knows the page that
    is 1, 2, 4, ... links before it, so as many rounds suffice as the length of the longest listing
    has binary digits, each one join of addresses, written to the shared folder.  Every join is a
    merge join: the staged addresses are so small as files that Spark would send them through the
    driver, at any number of rows.  The last one gives every row its number; it moves the rows
    unless the table is bucketed by address, so pass narrow ones.

    A page that several pages link to follows the one with the smallest address.  Pages in a loop
    have no first one: their ``first_url`` and ``page_no`` are null.  Of rows that repeat an
    address, and of null addresses, nothing is known beyond their own row: repeats share the
    number, a null address has none.
    """
    root = root or shared_dir(pages.sparkSession)
    links = pages.filter(F.col(key).isNotNull()).select(F.col(key).alias("at"), F.nullif(F.col(following), F.lit("")).alias("to"))
    every = stage(links.groupBy("at").agg(F.min("to").alias("to")), "links", root)
    before = every.filter("to is not null and to <> at").groupBy(F.col("to").alias("at")).agg(F.min("at").alias("jump"))
    own_loop = F.col("to") == F.col("at")
    # A page that links to itself is a loop of one, unless another page leads there.
    known = every.join(before.hint("merge"), "at", "left").withColumn("jump", F.coalesce("jump", F.when(own_loop, F.col("at"))))
    # `jump` is the page `n` links before; once that is a first page, it is `first` and `jump` is null.
    alone = F.col("jump").isNull()
    start = known.select("at", "jump", F.when(alone, 0).otherwise(1).cast("long").alias("n"), F.when(alone, F.col("at")).alias("first"))
    now = stage(start, "rank_0", root)
    reach, left, before_round = 1, now.filter("jump is not null").count(), None
    # Each round numbers the pages up to `reach` links from a first one.  Where it numbers none, only loops are left.
    while left and left != before_round:
        reach, before_round = reach * 2, left
        ahead = now.select(F.col("at").alias("jump"), F.col("jump").alias("over"), F.col("n").alias("m"), F.col("first").alias("start"))
        step = now.filter("jump is not null").join(ahead.hint("merge"), "jump", "left")
        step = step.select("at", F.col("over").alias("jump"), (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"), F.col("start").alias("first"))
        # A page that has its first one keeps its number.
        now = stage(now.filter("jump is null").unionByName(step), f"rank_{reach}", root)
        left = now.filter("jump is not null").count()
    found = now.select(F.col("at").alias(key), F.col("first").alias("first_url"), F.when(F.col("first").isNotNull(), F.col("n") + 1).alias("page_no"))
    return pages.join(found.hint("merge"), key, "left").select(*pages.columns, "first_url", "page_no")
