"""Column sets of the four record stages.

listing   one row per product card of a listing page
enriched  listing plus four columns from the product's own page
clean     priority columns first, then the other columns by name
table     the fixed columns of the target table
"""

from __future__ import annotations

from pyspark.sql import types as T

LISTING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("product_detail_url", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("marketplace", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("date_collected", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

DETAIL_FIELDS = [
    T.StructField("brand", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("total_reviews", T.DoubleType()),
    T.StructField("review_score", T.DoubleType()),
]
DETAIL_COLUMNS = [f.name for f in DETAIL_FIELDS]

ENRICHED = T.StructType(LISTING.fields + DETAIL_FIELDS)

# The priority columns, in output order.
PRIORITY = [
    "category",
    "subcategory",
    "marketplace",
    "brand",
    "name",
    "price",
    "currency",
    "description",
    "url",
    "image_url",
    "review_score",
    "date_collected",
]
NULLABLE_PRIORITY = ["review_score"]
NUMERIC_COLUMNS = ["price", "review_score"]

_EXTRAS = sorted(set(ENRICHED.names) - set(PRIORITY))
CLEAN = T.StructType([ENRICHED[c] for c in PRIORITY + _EXTRAS])

# The target table, in column order.
TABLE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("product_detail_url", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("marketplace_name", T.StringType()),
        T.StructField("date_collected", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("amazon_category", T.StringType()),
        T.StructField("review_score", T.DecimalType(10, 2)),
        T.StructField("total_reviews", T.DecimalType(10, 2)),
        T.StructField("brand", T.StringType()),
        T.StructField("about", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)
TABLE_NOT_NULL = ["name", "price"]
TABLE_KEY = "product_detail_url"
