"""Listing records and their enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text, urls
from ..schemas import DETAIL_COLUMNS, LISTING, TABLE_KEY
from . import pages as P
from .quality import dedupe_keep_first
from .skew import join_unique


def page_cards(pages: DataFrame, keep: list[str], profile: P.Profile = P.LISTING_PAGE, jvm: bool = False) -> DataFrame:
    """Cards with a link, one row each; ``malformed`` marks those that give no product.

    A page or card that could not be read is a malformed row too; ``error`` says why.
    """
    cards = P.extract_records(pages, profile, keep=keep, error="error", jvm=jvm)
    failed = F.col("error").isNotNull()
    malformed = failed | F.coalesce(P.is_malformed(), F.lit(False))
    return cards.filter(failed | P.has_link()).withColumn("malformed", malformed)


def to_products(cards: DataFrame, run_date: str, root_url: Column | str = "url", order: list[str] = ()) -> DataFrame:
    """Cards joined with their listing's columns -> listing records.

    ``run_date`` is the date of the run as a parameter, so that a repeated run repeats its
    rows.  ``order`` columns are passed through for the stages that need row order.
    """
    columns = {
        **P.card_columns(),
        "product_detail_url": urls.resolve_url(root_url, "href"),
        "page_url": F.col("page_url"),
        "marketplace": F.lower("marketplace"),
        "category": F.lower("category"),
        "subcategory": F.lower("subcategory"),
        "date_collected": F.lit(run_date),
        "url": text._col(root_url),
    }
    return cards.filter(~F.col("malformed")).select(*[columns[c].alias(c) for c in LISTING.names], *order)


def enrich(
    products: DataFrame,
    details: DataFrame,
    key: str = TABLE_KEY,
    detail_order: list[str | Column] | None = None,
) -> DataFrame:
    """Each product with the columns of its detail row.

    A product without one keeps its own values and gets nulls in the new columns.  With one,
    the detail's value replaces the product's, a null included.  ``detail_order`` picks the
    first of several detail rows per key; leave it out when the key is unique already.
    """
    if detail_order is not None:
        details = dedupe_keep_first(details.filter(F.col(key).isNotNull()), [key], detail_order)
    sequence = [c for c in detail_order or () if isinstance(c, str)]
    columns = [c for c in details.columns if c != key and c not in sequence]
    packed = details.select(key, F.struct(*columns).alias("_detail"))
    joined = join_unique(products, packed, key, "left")
    found = F.col("_detail").isNotNull()
    kept = [
        F.when(found, F.col("_detail")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in products.columns
    ]
    new = [F.col("_detail")[c].alias(c) for c in columns if c not in products.columns]
    return joined.select(*kept, *new)


def detail_rows(
    pages: DataFrame, url: str = "url", all_or_nothing: bool = False, order: list[str] = (), jvm: bool = False
) -> DataFrame:
    """Detail rows of a table of product pages, keyed like the products, with ``order`` columns."""
    rows = P.product_details(pages, keep=[url, *order], all_or_nothing=all_or_nothing, jvm=jvm)
    return rows.select(F.col(url).alias(TABLE_KEY), *DETAIL_COLUMNS, *order)
