"""Inputs the queries derive from the test tables: pages, cards, texts, names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketweave.functions import text, urls
from marketweave.operators.catalog import expand_catalog
from marketweave.operators.html import Match
from marketweave.operators.pages import Profile, Rule

SHOP = "https://shop.example.com"
RUN_DATE = "2025-07-05"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def wide(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """The wanted columns of a table, in the splits of its files."""
    rows = table(spark, sf, name)
    return rows.select(*columns) if columns else rows


# Markup of the collected test pages: a menu, one article, one advertisement.
MENU = Profile(
    regions=(Match("nav"),),
    record=Match("li"),
    fields={"href": Rule("attr", (Match("a"),), attr="href"), "label": Rule("text", (Match("a"),))},
)
LINKS = Profile(regions=(Match("nav"),), record=Match("li"), fields={"href": Rule("attr", (Match("a"),), attr="href")})
FIRST_LINK = Profile(regions=(Match("div", ("a",)),), fields={"href": Rule("attr", (Match("a"),), attr="href")})
ARTICLE = Profile(
    regions=(Match("body"), Match("article")),
    fields={
        "title": Rule("text", (Match("h1"),)),
        "ad": Rule("text", (Match("div", ("ad",)),), outer=True),
        "menu": Rule("texts", (Match("nav"), Match("li"), Match("a")), outer=True),
        "no_such": Rule("text", (Match("h4"),)),
    },
)


#: Rows of one task that makes markup of them: some MB of pages, read in seconds.
ROWS_A_TASK = 40_000


def dealt(rows: DataFrame, key: str, source: DataFrame) -> DataFrame:
    """Rows of keys dealt out to all cores before they become markup, in tasks of a bounded size.

    The number is asked for, so adaptive execution leaves it: by the size of the keys it would
    put them together again, but what they become is a thousand times as large.  ``source`` is the
    table that has as many rows; its footers tell the number.
    """
    tasks = -(-source.count() // ROWS_A_TASK)
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, tasks), key)


def order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One listing page per order: ``page_url, page_no, html``.

    The first card is a product whose price text depends on the order's priority.  The
    second depends on its status: F no name, O no link, P a product inside the first card.
    """
    orders = wide(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # Dealt after the joins, which may put the rows into a few tasks; these move keys and names only.
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    row = dealt(joined, "o_orderkey", orders)
    query = text.normalize_query("c_mktsegment", "n_name")
    number = F.concat(F.col("o_custkey").cast("string"), F.lit(".50"))
    priority = F.substring("o_orderpriority", 1, 1)
    price = (
        F.when(priority == "1", F.concat(F.lit("AED "), number))
        .when(priority == "2", number)
        .when(priority == "3", F.concat(F.lit("AED&nbsp;"), number))
        .when(priority == "4", F.concat(F.lit("AED 1,"), number))
    )
    price_markup = F.coalesce(
        F.concat(F.lit('<span class="a-price"><span class="a-offscreen"> '), price, F.lit(" </span></span>")), F.lit("")
    )
    second = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.lit('</div><div class="a-section a-spacing-base"><a class="a-link-normal" href="/dp/x">x</a>'),
        )
        .when(
            F.col("o_orderstatus") == "O",
            F.lit('</div><div class="a-section a-spacing-base"><h2><span>No link</span></h2>'),
        )
        .otherwise(
            F.concat(
                F.lit('<div class="a-section a-spacing-base"><a class="wide a-link-normal" href="https://o.example.org/p/'),
                F.col("o_custkey"),
                F.lit('?a=1&amp;b=2">y</a><h2><span>Inner</span></h2>'),
                F.lit('<p class="a-price"><span class="a-offscreen">USD 9.99</span></p></div>'),
            )
        )
    )
    html = F.concat(
        F.lit('<html><body><nav><a class="a-link-normal" href="/home">h</a></nav>'),
        F.lit('<span class="rush-component s-latency-cf-section"><div class="a-section a-spacing-base x">no card</div>'),
        F.lit('<div class="a-section a-spacing-base"><a class="a-link-normal" href="/dp/'),
        F.col("o_custkey"),
        F.lit('">go</a><span data-component-type="s-product-image"><img class="s-image" src="/i/'),
        F.col("o_custkey"),
        F.lit('.png"></span><h2><span> Item <b>'),
        F.col("o_orderstatus"),
        F.lit("</b> &amp; "),
        priority,
        F.lit("</span></h2>"),
        price_markup,
        second,
        F.lit("</div></span></body></html>"),
    )
    return row.select(urls.search_url(F.lit(SHOP), query).alias("page_url"), F.col("o_orderkey").alias("page_no"), html.alias("html"))


def order_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The listings of the order pages: every segment with every nation that has customers."""
    customer = table(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()
    named = customer.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    # At most 25 nations per segment and one segment list: both bounded by the nation table.
    offers = named.groupBy(F.col("c_mktsegment").alias("category")).agg(F.collect_set("n_name").alias("subcategories"))
    markets = offers.groupBy(F.lit("Shop").alias("marketplace"), F.lit(SHOP).alias("url")).agg(
        F.collect_set("category").alias("categories")
    )
    return expand_catalog(markets, offers)


def customer_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One product page per customer: ``url, collected, html``.

    Negative balance: the page lacks its centre column.  Segment MACHINERY: no brand.
    """
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    joined = customer.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    row = dealt(joined, "c_custkey", customer)
    brand = F.when(
        F.col("c_mktsegment") != "MACHINERY",
        F.concat(
            F.lit('<table><tr class="a-spacing-small po-brand"><td><span class="a-size-base po-break-word"> '),
            F.col("c_mktsegment"),
            F.lit(" </span></td></tr></table>"),
        ),
    ).otherwise("")
    html = F.concat(
        F.lit('<html><body><div id="dp-container"><div id="'),
        F.when(F.col("c_acctbal") < 0, "leftCol").otherwise("centerCol"),
        F.lit('">'),
        brand,
        F.lit('<div id="feature-bullets"><ul><li><span class="a-list-item">'),
        F.col("c_name"),
        F.lit('</span></li><li><span class="a-list-item"> Nation <b>'),
        F.col("n_name"),
        F.lit('</b></span></li></ul></div><div id="averageCustomerReviews"><span id="acrCustomerReviewText">1,'),
        F.col("c_custkey"),
        F.lit(' ratings</span><span class="a-size-base a-color-base">4.'),
        F.col("c_nationkey"),
        F.lit(' of 5</span></div></div><div id="productDescription">From &amp; for '),
        F.col("c_mktsegment"),
        F.lit("</div></div></body></html>"),
    )
    url = F.concat(F.lit(f"{SHOP}/dp/"), F.col("c_custkey"))
    return row.select(url.alias("url"), F.lit(2).alias("collected"), html.alias("html"))


def recollected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Two pages per customer: a later one, and one collected before with another score."""
    later = customer_pages(spark, sf)
    before = F.replace(F.col("html"), F.lit(" of 5</span>"), F.lit("7 of 5</span>"))
    return later.unionByName(later.select("url", F.lit(1).alias("collected"), before.alias("html")))


def awkward_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per part whose markup only a reader of HTML gets right: ``p_partkey, html``."""
    number = F.col("p_partkey")
    html = F.concat(
        F.lit('<DIV class="a"><SCRIPT>var a="<b>"</SCRIPT><A TITLE="a>b" href="/dp/'), number,
        F.lit("?a=1&amp;b=2&region=us&copy=2&x=&eacute;\">&eacute;&#x27;"), F.col("p_size"),
        F.lit(" < 90 <i>c</i></A><template>hid</template><!-- no --> &lt;"), number, F.lit("&gt;&nbsp;</DIV>"),
    )
    return table(spark, sf, "part").select("p_partkey", html.alias("html"))

def gappy_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with nulls, NaN and empty text in some columns."""
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(value < 10, F.lit(float("nan"))).when(value < 60, value).alias("value"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("props")).alias("props"),
    )


def priced_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a price text in seven shapes, by line number."""
    number = F.col("l_extendedprice").cast("string")
    shape = F.col("l_linenumber")
    price_text = (
        F.when(shape == 1, F.concat(F.lit("AED "), number))
        .when(shape == 2, number)
        .when(shape == 3, F.concat(F.lit("AED 1,"), number))
        .when(shape == 4, F.concat(F.lit("AED"), number))
        .when(shape == 5, F.concat(F.lit("From AED "), number))
        .when(shape == 6, F.concat(F.lit(" AED\u00a0"), number, F.lit("  ")))
        .otherwise(F.concat(number, F.lit("d")))
    )
    return wide(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice").withColumn(
        "price_text", price_text
    )


def keyed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as an upsert batch: the text is the key, German ones have none."""
    return table(spark, sf, "documents").select(
        "doc_id", "source", F.when(F.col("lang") != "de", F.col("text")).alias("product_detail_url")
    )


def snapshot_names(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot file name per order, and one without digits per status."""
    orders = wide(spark, sf, "orders", "o_orderdate", "o_orderstatus")
    stamped = F.concat(F.lit("final_x_"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit("_000000.csv"))
    plain = F.concat(F.lit("notes_"), F.col("o_orderstatus"), F.lit(".csv"))
    return orders.select(F.explode(F.array(stamped, plain)).alias("name"))
