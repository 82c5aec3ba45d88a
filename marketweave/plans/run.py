"""The three stages of a listing run: collected pages -> products -> details -> clean rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.products import detail_rows, enrich, page_cards, to_products
from ..operators.quality import clean_products, observe_malformed, observe_profile, observed_profile, run_counts, split_malformed
from ..operators.skew import first_n, join_unique
from ..schemas import CLEAN, TABLE_KEY
from ..session import shared_dir, stage

# Row order of a listing: page after page, card after card.
LISTING_ORDER = ["page_no", "pos"]
LISTING_KEYS = ["marketplace", "category", "subcategory"]


def extract(pages: DataFrame, listings: DataFrame, run_date: str) -> DataFrame:
    """Collected listing pages -> listing records, with their order columns.

    ``pages`` has ``page_url`` (the listing's search URL), ``page_no`` and ``html``.  Pages are
    parsed before the join, so the join moves small records instead of markup.
    """
    return listed(page_cards(pages, keep=["page_url", "page_no"]), listings, run_date)


def listed(cards: DataFrame, listings: DataFrame, run_date: str) -> DataFrame:
    """Cards joined with their listings' columns, as listing records."""
    found = join_unique(cards, listings.select("page_url", "url", *LISTING_KEYS), "page_url", "inner")
    return to_products(found, run_date, order=LISTING_ORDER)


def transform(
    products: DataFrame,
    detail_pages: DataFrame,
    detail_order: list[str],
    limit: int | None = 5,
    order: list[str] = LISTING_ORDER,
    by: list[str] = LISTING_KEYS,
    root: str | None = None,
) -> DataFrame:
    """The first ``limit`` products of each listing, with what their own pages say.

    A product has one detail: of several pages of its URL the first in ``detail_order``
    (columns of ``detail_pages``, such as the time of collection).  With a limit the chosen
    products are staged, and only their pages are parsed.
    """
    if limit is not None:
        products = stage(first_n(products, by, order, limit), "chosen", root)
        detail_pages = wanted_pages(detail_pages, products)
    return enrich(products, detail_rows(detail_pages, order=detail_order), detail_order=detail_order)


def wanted_pages(detail_pages: DataFrame, products: DataFrame) -> DataFrame:
    """Pages of these products.  Spark sends the URLs along while their size allows it; a page
    table that is stored by URL (``tables.save_by_key``) stays where it is beyond that."""
    wanted = products.select(F.col(TABLE_KEY).alias("url")).distinct()
    return detail_pages.join(wanted, "url", "left_semi")


@dataclass(frozen=True)
class Run:
    """What a run leaves: ``clean`` rows; ``profile``, missing values per column before anything
    is coerced or dropped; ``summary``, one row of counts; ``quarantine``, the cards and pages that
    gave no product, with the ``error`` of those that could not be read; ``root``, the folder of its stage tables, to be removed by the caller."""

    clean: DataFrame
    profile: DataFrame
    summary: DataFrame
    quarantine: DataFrame
    root: str


def full_run(
    pages: DataFrame,
    listings: DataFrame,
    detail_pages: DataFrame,
    run_date: str,
    detail_order: list[str],
    limit: int | None = 5,
) -> Run:
    """All three stages.  Cards and enriched products are written once each: later steps and tasks
    that are run again read those tables and parse nothing twice.  The profile and what can be
    counted row by row are taken while the rows are written."""
    spark = pages.sparkSession
    root = shared_dir(spark)
    cards, cards_seen = observe_malformed(page_cards(pages, keep=["page_url", "page_no"]), F.col("malformed"), "cards")
    cards = stage(cards, "cards", root)
    good, quarantine = split_malformed(cards, F.col("malformed"))
    products = listed(good, listings, run_date)
    enriched = transform(products, detail_pages, detail_order, limit, root=root)
    enriched, enriched_seen = observe_profile(enriched, "enriched", CLEAN.names)
    enriched = stage(enriched, "enriched", root)
    lost = cards.join(listings.select("page_url"), "page_url", "left_anti").agg(F.count(F.lit(1)).alias("without_listing"))
    # Two tables of one row each, side by side; the rest was counted as it was written.
    rows = lost.unionByName(run_counts(products, "page_no", TABLE_KEY), allowMissingColumns=True)
    known = {"cards": cards_seen.get["read"], "malformed": cards_seen.get["malformed"], "chosen": enriched_seen.get["rows"]}
    counted = {c: F.lit(n).cast("long").alias(c) for c, n in known.items()}
    summary = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    summary = summary.select(counted["cards"], counted["malformed"], *rows.columns, counted["chosen"])
    return Run(load(enriched), observed_profile(spark, enriched_seen, CLEAN.names), summary, quarantine, root)


def listing_run(
    pages: DataFrame,
    listings: DataFrame,
    detail_pages: DataFrame,
    run_date: str,
    detail_order: list[str],
    limit: int | None = 5,
) -> DataFrame:
    """The clean rows of a full run."""
    return full_run(pages, listings, detail_pages, run_date, detail_order, limit).clean


def load(enriched: DataFrame, order: list[str] = (*LISTING_KEYS, *LISTING_ORDER)) -> DataFrame:
    """Clean rows in output column order, with the order columns last."""
    extra = [c for c in order if c not in CLEAN.names]
    return clean_products(enriched, list(order)).select(*CLEAN.names, *extra)
