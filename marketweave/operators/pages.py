"""Page table to record table: one Arrow pass over the HTML, then plain columns.

``extract_records`` is the only Python stage of the package, and ``jvm=True`` spares plain pages
even that.  It streams Arrow batches
through a task, emits one row per record, and leaves the HTML behind, so nothing
downstream ever shuffles markup.  It keeps the partitioning of the scan: large inputs
have splits enough, and moving raw pages costs more than parsing them where they are.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from operator import and_

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import parse, text
from . import html as html_module, plain
from .html import Match, Page

# The page pass carries its own code to the executors; they need nothing installed.
cloudpickle.register_pickle_by_value(html_module)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


@dataclass(frozen=True)
class Rule:
    """How one output field is read from a record.

    ``kind``: ``text`` first match, stripped; ``raw`` first match as is; ``attr`` an
    attribute of the first match; ``present`` whether there is a match; ``texts`` all
    matches, stripped.  ``within`` narrows the search to the first such element first,
    ``outer`` widens it from the innermost to the outermost region.
    """

    kind: str
    path: tuple[Match, ...]
    attr: str | None = None
    within: Match | None = None
    outer: bool = False

    @property
    def type(self) -> str:
        return {"present": "boolean", "texts": "array<string>"}.get(self.kind, "string")

    def read(self, page: Page, scope: range, root: int):
        if self.within is not None:
            holder = page.first((self.within,), scope, root)
            scope = page.inside(holder) if holder is not None else range(0)
        if self.kind == "texts":
            return [page.text(i) for i in page.matches(self.path, scope, root)]
        first = page.first(self.path, scope, root)
        if self.kind == "present":
            return first is not None
        if first is None:
            return None
        if self.kind == "attr":
            return page.attrs(first).get(self.attr)
        return page.text(first, strip=self.kind == "text")


def _reason(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}"[:500]


@dataclass(frozen=True)
class Profile:
    """What a record is on one kind of page.

    ``regions`` nest: each is the first match inside the one before; a page without one of
    them has no records.  ``record`` selects every record element inside the last region;
    without it the region itself is the one record.
    """

    regions: tuple[Match, ...]
    fields: dict[str, Rule] = field(hash=False)
    record: Match | None = None

    def attempts(self, html: str | bytes | None) -> Iterator[tuple[int | None, list | None, str | None]]:
        """Number, fields and, instead of the fields, the reason why there are none."""
        try:
            page = Page(html.decode() if isinstance(html, bytes) else html or "", self.regions[0] if self.regions else None)
            for n, read in enumerate(self.records(page), 1):
                try:
                    yield n, read(), None
                except Exception as failure:
                    yield n, None, _reason(failure)
        except Exception as failure:
            yield None, None, _reason(failure)

    def records(self, page: Page) -> Iterator[Callable[[], list]]:
        """What reads the fields of each record of a page."""
        scope, outer, root = range(len(page)), None, -1
        for region in self.regions:
            found = page.first((region,), scope, root)
            if found is None:
                return
            scope = page.inside(found)
            if outer is None:
                outer, root = scope, found
        outer = scope if outer is None else outer
        scopes = [scope] if self.record is None else map(page.inside, page.matches((self.record,), scope, root))
        for own in scopes:
            yield partial(self._read, page, own, outer, root)

    def _read(self, page: Page, own: range, outer: range, root: int) -> list:
        return [rule.read(page, outer if rule.outer else own, root) for rule in self.fields.values()]


# Markup of the listing pages and of the product pages.
LISTING_PAGE = Profile(
    regions=(Match("span", ("rush-component", "s-latency-cf-section")),),
    record=Match("div", class_attr="a-section a-spacing-base"),
    fields={
        "href": Rule("attr", (Match("a", ("a-link-normal",)),), attr="href"),
        "image_tag": Rule(
            "present",
            (Match("span", attr=("data-component-type", "s-product-image")), Match("img", ("s-image",))),
        ),
        "image_src": Rule(
            "attr",
            (Match("span", attr=("data-component-type", "s-product-image")), Match("img", ("s-image",))),
            attr="src",
        ),
        "name_text": Rule("text", (Match("span"),), within=Match("h2")),
        "price_text": Rule("text", (Match(classes=("a-price",)), Match(classes=("a-offscreen",)))),
    },
)

_REVIEWS = Match("div", id="averageCustomerReviews")
PRODUCT_PAGE = Profile(
    regions=(Match("div", id="dp-container"), Match("div", id="centerCol")),
    fields={
        "brand_text": Rule(
            "text",
            (Match("tr", ("a-spacing-small", "po-brand")), Match("span", ("a-size-base", "po-break-word"))),
        ),
        "bullets": Rule(
            "texts", (Match("div", id="feature-bullets"), Match("li"), Match("span", ("a-list-item",)))
        ),
        "long_text": Rule("text", (Match("div", id="productDescription"),), outer=True),
        "reviews_text": Rule("raw", (_REVIEWS, Match("span", id="acrCustomerReviewText"))),
        "score_text": Rule("raw", (_REVIEWS, Match("span", ("a-size-base", "a-color-base")))),
    },
)


def extract_records(
    pages: DataFrame,
    profile: Profile,
    keep: list[str] | None = None,
    html: str = "html",
    error: str | None = None,
    jvm: bool = False,
) -> DataFrame:
    """One row per record of each page: ``keep`` columns, 1-based ``pos``, profile fields.

    ``html`` is text, or bytes of UTF-8.  A page that cannot be read, or a record of it, does not
    end the job and leaves the others as they are: with ``error`` it gives a row whose column of
    that name holds the reason, with null fields (and a null ``pos`` if no record can be told);
    without it gives none.  With ``jvm`` plainly written pages are read by built-in expressions
    and the Arrow pass only gets the others; each branch scans the table.
    """
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    types = [_ARROW[r.type] for r in profile.fields.values()] + [pa.string()] * bool(error)
    names = [*profile.fields, *([error] if error else [])]
    schema = T.StructType([pages.schema[c] for c in keep])
    schema = schema.add("pos", T.IntegerType())
    for name, rule in profile.fields.items():
        schema = schema.add(name, T.DataType.fromDDL(rule.type))
    if error:
        schema = schema.add(error, T.StringType())

    # A page without what the attributes of a region must hold has no records.
    if isinstance(pages.schema[html].dataType, T.StringType):
        needed = [F.col(html).contains(r.needle) | F.col(html).contains("&") for r in profile.regions if r.needle]
        if jvm:
            # Conditions inside what generates the rows, not filters: those Spark would move down to the scan
            # of what the pages are made from, into as few tasks as that has, and make the pages once more for them.
            may, plain_page, none = reduce(and_, needed, F.lit(True)), plain.is_plain(F.col(html)), F.array().cast("array<string>")
            found = pages.select(*keep, F.posexplode(F.when(may, plain.records(profile, f"`{html}`"))).alias("pos", "_r"))
            found = found.select(*keep, (F.col("pos") + 1).alias("pos"), *[F.col("_r")[c].alias(c) for c in profile.fields])
            left = pages.select(*keep, F.explode(F.when(~may | plain_page, none).otherwise(F.array(html))).alias(html))
            rest = extract_records(left, profile, keep, html, error)
            return found.unionByName(rest, allowMissingColumns=True)
        for condition in needed:
            pages = pages.filter(condition)

    width = len(profile.fields)

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, pos = [], []
            values = [[] for _ in names]
            for row, markup in enumerate(batch.column(len(keep)).to_pylist()):
                for n, record, reason in profile.attempts(markup):
                    if reason and not error:
                        continue
                    source.append(row)
                    pos.append(n)
                    for column, value in zip(values, [*(record or [None] * width), *([reason] if error else [])]):
                        column.append(value)
            kept = [batch.column(i).take(pa.array(source, pa.int64())) for i in range(len(keep))]
            fields = [pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(pos, pa.int32())] + fields, keep + ["pos"] + names)

    return pages.select(*keep, html).mapInArrow(parse_batches, schema)


def page_text(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns and ``text``: all text of each page, node by node trimmed and joined."""
    schema = T.StructType([pages.schema[c] for c in keep]).add("text", T.StringType())

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if m is None else Page(m).whole_text() for m in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])

    return pages.select(*keep, html).mapInArrow(read_batches, schema)


def has_link(href: Column | str = "href") -> Column:
    """Cards without a link, or with an empty one, are passed over without notice."""
    href = text._col(href)
    return href.isNotNull() & (href != "")


def is_malformed() -> Column:
    """Cards that cannot become a product: no name, or an image element without source."""
    return F.col("name_text").isNull() | (F.col("image_tag") & F.col("image_src").isNull())


def card_columns() -> dict[str, Column]:
    """Product columns that come from the card itself."""
    price = parse.parse_price("price_text")
    return {
        "name": F.lower("name_text"),
        "price": price["price"],
        "currency": price["currency"],
        "image_url": F.col("image_src"),
    }


def _number_lost(field_text: str, pattern: str, value: Column) -> Column:
    return F.coalesce(F.col(field_text).rlike(pattern) & value.isNull(), F.lit(False))


def product_details(pages: DataFrame, keep: list[str], all_or_nothing: bool = False, jvm: bool = False) -> DataFrame:
    """Brand, description, review count and score, one row per product page that can be read.

    A count or score that is punctuation only is null.  With ``all_or_nothing`` such a page
    gives no row at all, so its product stays without any detail.
    """
    found = extract_records(pages, PRODUCT_PAGE, keep=keep, jvm=jvm)
    reviews, score = parse.parse_reviews("reviews_text"), parse.parse_score("score_text")
    if all_or_nothing:
        found = found.filter(
            ~_number_lost("reviews_text", r"[\p{Nd},]", reviews) & ~_number_lost("score_text", r"[\p{Nd}.]", score)
        )
    return found.select(
        *keep,
        F.lower("brand_text").alias("brand"),
        text.compose_description(F.array_join("bullets", "\n"), "long_text").alias("description"),
        reviews.alias("total_reviews"),
        score.alias("review_score"),
    )
