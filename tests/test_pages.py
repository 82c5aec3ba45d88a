"""Cards and product pages from markup."""

import random
import sys
from html import unescape
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from marketweave.functions import text
from marketweave.operators import catalog, html, pages, plain, products, quality
from marketweave.operators.html import NO_TEXT, VOID, Match, Page
from marketweave.plans import run

ROOT = "https://shop.example.com"
REGION = '<html><body>{before}<span class="a rush-component s-latency-cf-section">{cards}</span>{after}</body></html>'
LINK = '<a class="a-link-normal" href="/dp/1">x</a>'
IMAGE = '<span data-component-type="s-product-image"><img class="s-image" src="i.png"></span>'
NAME = "<h2><span>Cat Food</span></h2>"


def card(*parts, css="a-section a-spacing-base"):
    return f'<div class="{css}">{"".join(parts)}</div>'


def price(value):
    return f'<span class="a-price"><span class="a-offscreen">{value}</span></span>'


@pytest.fixture
def extract(spark):
    def run_(cards, html=None):
        html = REGION.format(before="", after="", cards=cards) if html is None else html
        df = spark.createDataFrame([(1, html)], "page_id int, html string")
        found = products.page_cards(df, ["page_id"])
        columns = {**pages.card_columns(), "url": products.urls.resolve_url(text.F.lit(ROOT), "href")}
        rows = found.filter("not malformed").select("pos", *[c.alias(n) for n, c in columns.items()])
        good = [(r["name"], r["price"], r["currency"], r["image_url"], r["url"]) for r in rows.orderBy("pos").collect()]
        return good, found.filter("malformed").count()

    return run_


FULL = ("cat food", 12.5, "AED", "i.png", f"{ROOT}/dp/1")


def test_full_card(extract):
    assert extract(card(LINK, IMAGE, NAME, price("AED 12.50"))) == ([FULL], 0)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12.50", (12.5, "")),
        ("AED 1,299.00", (None, None)),
        ("AED12.50", (None, None)),
        ("From AED 12", (None, None)),
        ("", (None, None)),
        ("AED&nbsp;12.50", (12.5, "AED")),
        ("AED <b>12</b>.50", (None, None)),
    ],
)
def test_price_shapes(extract, value, expected):
    good, bad = extract(card(LINK, IMAGE, NAME, price(value)))
    assert [(g[1], g[2]) for g in good] == [expected] and bad == 0


def test_no_price_tag(extract):
    assert extract(card(LINK, IMAGE, NAME))[0][0][1:3] == (None, None)


@pytest.mark.parametrize("name", ["", "<h2>bare</h2>", "<h2>bare</h2><h2><span>second</span></h2>"])
def test_no_name_is_malformed(extract, name):
    assert extract(card(LINK, IMAGE, name)) == ([], 1)


def test_empty_name_is_a_name(extract):
    assert extract(card(LINK, "<h2><span> </span></h2>"))[0][0][0] == ""


@pytest.mark.parametrize("link", ["", '<a class="other" href="/x">', '<a class="a-link-normal" href="">', '<a class="a-link-normal">'])
def test_no_link_is_silent(extract, link):
    assert extract(card(link, "</a>", IMAGE, NAME)) == ([], 0)


def test_first_link_decides(extract):
    assert extract(card('<a class="a-link-normal">', LINK, NAME)) == ([], 0)


def test_image_states(extract):
    assert extract(card(LINK, NAME))[0][0][3] is None
    bare = '<span data-component-type="s-product-image"><img class="s-image"></span>'
    assert extract(card(LINK, bare, NAME)) == ([], 1)
    empty = '<span data-component-type="s-product-image"><img class="s-image" src=""></span>'
    assert extract(card(LINK, empty, NAME))[0][0][3] == ""


def test_card_class_is_exact(extract):
    cards = card(LINK, NAME, css="a-section a-spacing-base x") + card(LINK, NAME, css="a-spacing-base a-section")
    assert extract(cards) == ([], 0)
    assert len(extract(card(LINK, NAME, css=" a-section \n a-spacing-base "))[0]) == 1


def test_nested_cards_both_count(extract):
    good, _ = extract(card(LINK, NAME, card(LINK, "<h2><span>In</span></h2>")))
    assert [g[0] for g in good] == ["cat food", "in"]


def test_split_text_joins_without_gap(extract):
    assert extract(card(LINK, "<h2><span>Dry <b>Food</b> </span></h2>"))[0][0][0] == "dryfood"


def test_no_region_no_rows(extract):
    html = f"<html><body>{card(LINK, NAME)}</body></html>"
    assert extract("", html) == ([], 0)
    assert extract("", "") == ([], 0)


def test_first_region_only(extract):
    html = REGION.format(before="", after="", cards=card(LINK, NAME)) + REGION.format(before="", after="", cards=card(LINK, NAME))
    assert len(extract("", html)[0]) == 1


def test_null_page(spark):
    df = spark.createDataFrame([(1, None)], "page_id int, html string")
    assert products.page_cards(df, ["page_id"]).count() == 0


DETAIL = """<div id="dp-container"><div id="{centre}">{brand}<div id="feature-bullets"><ul>{bullets}</ul></div>
<div id="averageCustomerReviews"><span id="acrCustomerReviewText">{reviews}</span>
<i><span class="a-size-base a-color-base">{score}</span></i></div></div>{long}</div>"""
BRAND = '<table><tr class="po-brand a-spacing-small"><td><span class="a-size-base po-break-word"> Acme </span></td></tr></table>'


def detail_page(**parts):
    defaults = dict(
        centre="centerCol",
        brand=BRAND,
        bullets='<li><span class="a-list-item"> One </span></li><li><span class="a-list-item">Two</span></li>',
        reviews="1,234 ratings",
        score=" 4.5 ",
        long='<div id="productDescription"><p>Long</p></div>',
    )
    return DETAIL.format(**{**defaults, **parts})


@pytest.mark.parametrize(
    "parts, expected",
    [
        ({}, ("acme", "one\ntwo\nlong", 1234.0, 4.5)),
        ({"bullets": ""}, ("acme", "long", 1234.0, 4.5)),
        ({"bullets": "", "long": ""}, ("acme", "", 1234.0, 4.5)),
        ({"brand": ""}, (None, "one\ntwo\nlong", 1234.0, 4.5)),
        ({"reviews": ",", "score": "."}, ("acme", "one\ntwo\nlong", None, None)),
        ({"reviews": "none", "score": ""}, ("acme", "one\ntwo\nlong", None, None)),
        ({"centre": "other"}, None),
    ],
)
def test_product_page(spark, parts, expected):
    df = spark.createDataFrame([("u", detail_page(**parts))], "url string, html string")
    rows = [tuple(r)[1:] for r in products.detail_rows(df).collect()]
    assert rows == ([expected] if expected else [])


def test_all_or_nothing_drops_the_page(spark):
    rows = [("a", detail_page()), ("b", detail_page(score=".")), ("c", detail_page(reviews="none"))]
    df = spark.createDataFrame(rows, "url string, html string")
    kept = products.detail_rows(df, all_or_nothing=True).collect()
    assert sorted(r["product_detail_url"] for r in kept) == ["a", "c"]


def test_page_is_lenient():
    page = Page('<div><p>a<br>b<p>c</i></p> d <!-- x -->e <script>if (a < b) "</p>"</script><img src=x /> 1 < 2 &amp; 3</div>z')
    assert page.text(0) == "abcde1 < 2 & 3"
    assert page.tags == ["div", "p", "br", "p", "script", "img"]
    assert page.ends[0] == 6


class PlainReader(HTMLParser):
    """The same lists from the standard library's event parser."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.rows, self.texts, self.open, self.joined = [], [], [], False
        self.feed(html)
        self.close()
        while self.open:
            self.shut()

    def shut(self):
        row = self.rows[self.open.pop()]
        row[3], row[5] = len(self.rows), len(self.texts)

    def handle_starttag(self, tag, attrs):
        self.joined = False
        self.rows.append([tag, {k: v or "" for k, v in attrs}, self.open[-1] if self.open else -1, None, len(self.texts), None])
        self.open.append(len(self.rows) - 1)
        if tag in VOID:
            self.shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.shut()

    def handle_endtag(self, tag):
        self.joined = False
        if any(self.rows[i][0] == tag for i in self.open):
            while self.rows[self.open[-1]][0] != tag:
                self.shut()
            self.shut()

    def handle_data(self, data):
        if any(self.rows[i][0] in NO_TEXT for i in self.open):
            return
        if self.joined:
            self.texts[-1] += data
        else:
            self.texts.append(data)
        self.joined = True

    def other(self, _):
        self.joined = False

    handle_comment = handle_decl = handle_pi = unknown_decl = other


def ours(html):
    page = Page(html)
    columns = zip(page.tags, map(page.attrs, range(len(page))), page.parents, page.ends, page.text_from, page.text_to)
    return [list(row) for row in columns], [unescape(t) for t in page.texts]


PIECES = [
    "<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "</br>", '<img src="a b">', "<img src='x>y' alt=q/>",
    "<a href=x/y/>", '<div class="a b" id=z/>', '<A HREF="q&amp;r">', "</A>", "text ", " ", "a < b", "1<2", " &amp; ",
    "&nbsp;", "<!-- c -->", "<!-- <b> -->", "<!DOCTYPE html>", '<script>if(a<b){"</p>"}</script>', "<style>p>b{}</style>",
    "<template>t<i>", "</template>", "<input disabled value=1>", '<span\n class = "x"\n>', "</span >", "<?pi x>", ">",
    "<x-y z>", '<a b="1" b="2">', "<h2 data-a='\"'>", "</h2>", "<script src=x></script>",
]


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_scan_agrees_with_the_event_parser(pieces):
    html = "".join(pieces)
    plain = PlainReader(html)
    assert ours(html) == (plain.rows, plain.texts)


def test_scan_agrees_on_the_test_pages():
    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        plain = PlainReader(html)
        assert ours(html) == (plain.rows, plain.texts)


def test_scan_is_linear_in_broken_markup():
    for html in ('<a b="' * 20000, "<" * 100000, "<!--" * 20000, "<a '" * 20000, "<div" * 50000, "</" * 50000):
        Page(html)
        Page(html + ">")
        Page(html + "\">'>")
    assert len(Page("<div>" * 50000 + "</b>" * 50000)) == 50000


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_events_are_those_of_the_page(pieces):
    markup = "".join(pieces)
    page, found = Page(markup), list(html.events(markup))
    assert [tag for kind, tag, _ in found if kind in ("start", "void")] == page.tags
    if not any(tag in NO_TEXT for tag in page.tags):
        assert [text for kind, text, _ in found if kind == "text"] == page.texts


@pytest.mark.parametrize(
    "value, want",
    [("&#" + "1" * 5000 + ";x", "\ufffdx"), ("&#" + "0" * 5000 + "65;", "A"), ("&#00000000;", "\ufffd"), ("&#99999999", "\ufffd"), ("a &#xFFFFFFFFFFFFF; b", "a \ufffd b"), ("&#65;&amp;", "A&")],
)
def test_references_of_any_length(spark, value, want):
    assert html.decoded(value) == html.unescape_attribute(value) == want
    df = spark.createDataFrame([(1, f"<nav a='{value}'>{value}</nav>")], "page_id int, html string")
    assert pages.page_text(df, ["page_id"]).head()["text"] == want


# Pieces of plain pages, and some that are not.
PLAIN_PIECES = [
    "<div>", "</div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "<hr />", "</br>", '<img src="a b">', '<div class="a  b" id="z">', '<div id="z">',
    '<a href="x?a=1&amp;b=2">', "</a>", "</a>", "text ", " ", " &amp; ", "&amp;lt;", "&nbsp;", "<h2>", "</h2>", "<li>", "</li>", '<span class="b a">', '<span class="ab">',
    "</span>", '<b href="y" href="z">', "\u2003x\x1c", "<i>deep</i>", "é", "<ul>", "</ul>", '<input disabled>', "<!-- c -->", "a < b", "<P>", "&copy;", "<script>1</script>",
]
CHECKED = [
    pages.Profile((), {"first": pages.Rule("text", (Match("b"),)), "raw": pages.Rule("raw", (Match("p"),)), "all": pages.Rule("texts", (Match("div"), Match("li")))}),
    pages.Profile(
        (Match("div", ("a",)),),
        {
            "href": pages.Rule("attr", (Match("a"),), attr="href"), "there": pages.Rule("present", (Match("h2"), Match(classes=("b",)))),
            "name": pages.Rule("text", (Match("span"),), within=Match("h2")), "out": pages.Rule("texts", (Match("b"),), outer=True),
            "deep": pages.Rule("text", (Match("div"), Match("ul"), Match("li"))), "any": pages.Rule("present", (Match("i"),), within=Match("p")),
        },
        record=Match("li"),
    ),
    pages.Profile((Match("div"), Match("div", id="z")), {"t": pages.Rule("texts", (Match(attr=("src", "a b")),)), "x": pages.Rule("raw", (Match("p"),), outer=True)}, record=Match("div", class_attr="a b")),
]


@pytest.mark.parametrize("number", range(len(CHECKED)))
def test_plain_pages_are_read_alike(spark, number):
    """The same records from expressions and from the Arrow pass, on generated pages."""
    rng, rows = random.Random(number), []
    for i in range(3000):
        some = PLAIN_PIECES if i % 3 == 0 else PLAIN_PIECES[:36]
        body = "".join(rng.choice(some) for _ in range(rng.randrange(0, 22)))
        rows.append((i, body if i % 2 else f'<div class="a">{body}<ul><li>{body}</li></ul></div>'))
    rows += [(-1, None), (-2, ""), (-3, "<div>" * 30)]
    df = spark.createDataFrame(rows, "page_id int, html string").repartition(4)
    assert df.filter(plain.is_plain(F.col("html"))).count() > 1500
    one = pages.extract_records(df, CHECKED[number], keep=["page_id"])
    two = pages.extract_records(df, CHECKED[number], keep=["page_id"], jvm=True)
    assert two.schema.simpleString() == one.schema.simpleString()
    want, got = sorted(map(str, one.collect())), sorted(map(str, two.collect()))
    assert len(want) > 150 and got == want


def test_plain_pages_need_no_worker(spark):
    page = REGION.format(before="", after="", cards=card(LINK, NAME)).replace("\n", "")
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    found = products.page_cards(df, ["page_id"], jvm=True)
    assert df.filter(plain.is_plain(F.col("html"))).count() == 1 and found.count() == 1
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # the branch of the others


def test_a_page_that_raises_leaves_the_others(spark):
    good = REGION.format(before="", after="", cards=card(LINK, NAME)).encode()
    rows = [(1, good), (2, b"\xff" + good), (3, None), (4, good)]
    df = spark.createDataFrame(rows, "page_id int, html binary")
    found = {r.page_id: r for r in products.page_cards(df, ["page_id"]).collect()}
    assert sorted(found) == [1, 2, 4] and found[1].name_text == found[4].name_text == "Cat Food"
    assert found[2].malformed and found[2].error.startswith("UnicodeDecodeError") and found[2].pos is None
    assert [r.page_id for r in pages.extract_records(df, pages.LISTING_PAGE, ["page_id"]).collect()] == [1, 4]


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Picky(pages.Rule):
    def read(self, page, scope, root):
        value = super().read(page, scope, root)
        if value == "/dp/2":
            raise ValueError("no such product")
        return value


def test_a_record_that_raises_leaves_the_others(spark):
    cards = "".join(card(f'<a class="a-link-normal" href="/dp/{i}">x</a>', NAME) for i in range(1, 5))
    df = spark.createDataFrame([(1, REGION.format(before="", after="", cards=cards))], "page_id int, html string")
    listing = pages.LISTING_PAGE
    picky = pages.Profile(listing.regions, {**listing.fields, "href": Picky("attr", (Match("a", ("a-link-normal",)),), attr="href")}, listing.record)
    rows = products.page_cards(df, ["page_id"], picky).orderBy("pos").collect()
    assert [(r.pos, r.href, r.error) for r in rows] == [(1, "/dp/1", None), (2, None, "ValueError: no such product"), (3, "/dp/3", None), (4, "/dp/4", None)]
    assert [r.pos for r in rows if r.malformed] == [2]


def test_comment_without_end_hides_the_rest():
    page = Page("<p>a<!-- b <i>c</i> d")
    assert page.tags == ["p"] and page.texts == ["a"]
    assert Page("<p>a<!-->b</p>").texts == ["a", "b"]


def test_ancestors_count_inside_the_region_only():
    page = Page('<div id="a"><section><div><b>x</b></div></section></div>')
    section, path = 1, (Match("div", id="a"), Match("b"))
    assert list(page.matches(path, page.inside(section), root=-1)) == [3]
    assert list(page.matches(path, page.inside(section), root=section)) == []


def test_one_python_pass_per_scan(spark):
    """Filters and projections on extracted fields must not run the page pass again."""
    df = spark.createDataFrame([(1, "x")], "page_id int, html string")
    cards = products.page_cards(df, ["page_id"]).filter("not malformed")
    plan = cards.select("page_id", *[c.alias(n) for n, c in pages.card_columns().items()])
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert text_plan.count("MapInArrow") == 1


@pytest.mark.parametrize(
    "markup, want",
    [
        ("a <b>b</b> c", "abc"), ("<p>x &amp; y</p><!-- no --> z", "x & yz"), ("<script>if (a<b) x()</script>t", "t"),
        ("&amp;lt;", "&lt;"), ("a &amp", "a &"), ("&copy 1", "© 1"), ("<SCRIPT>var a=1</SCRIPT>x", "x"),
        ('<a title="a>b">t</a>', "t"), ("a < b <i>c</i>", "a < bc"), ("<template>hid</template>v", "v"),
        ("&copysr;", "℗"), ("&eacute;&#x27;", "é'"), (None, None), ("", ""),
    ],
)
def test_page_text(spark, markup, want):
    df = spark.createDataFrame([(1, markup)], "page_id int, html string")
    assert [tuple(r) for r in pages.page_text(df, ["page_id"]).collect()] == [(1, want)]


@pytest.mark.parametrize(
    "value, want",
    [
        ("/dp/1?a=1&region=us&copy=2", "/dp/1?a=1&region=us&copy=2"), ("?a=1&amp;b=2", "?a=1&b=2"), ("&copy", "©"),
        ("&copyx", "&copyx"), ("&eacute;", "é"), ("&#39;&#x41", "'A"), ("a&b", "a&b"), ("&nosuch;", "&nosuch;"),
    ],
)
def test_references_in_attributes(value, want):
    assert html.unescape_attribute(value) == want


def test_the_scan_ends_with_its_region():
    page = html.Page("<nav><a href=x>1</a></nav>" + "<p>z</p>" * 50, html.Match("nav"))
    assert page.tags == ["nav", "a"]


def test_malformed_rows_are_counted_with_the_job(spark):
    rows = [(i, REGION.format(before="", after="", cards=card(LINK, NAME if i % 2 else ""))) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id int, html string")
    cards, seen = quality.observe_malformed(products.page_cards(df, ["page_id"]), F.col("malformed"), "cards")
    assert len(cards.collect()) == 6
    assert seen.get == {"read": 6, "malformed": 3}


def test_whole_run(spark):
    markets, offers = catalog.default_catalog(spark)
    listings = catalog.expand_catalog(markets, offers, "amazonae")
    listing = catalog.find_listing(listings, "pet food", "dry food").head()
    root = listing["url"]
    page = REGION.format(
        before="",
        after="",
        cards=card(LINK, IMAGE, NAME, price("AED 12.50"))
        + card('<a class="a-link-normal" href="/dp/2">x</a>', IMAGE, NAME, price("AED 12.50"))
        + card('<a class="a-link-normal" href="/dp/3">x</a>', IMAGE, "<h2><span>No page</span></h2>", price("AED 1")),
    )
    collected = spark.createDataFrame([(listing["page_url"], 1, page)], "page_url string, page_no int, html string")
    found = run.extract(collected, listings, "2025-07-05")
    assert found.count() == 3
    details = spark.createDataFrame(
        [(f"{root}/dp/1", 1, detail_page()), (f"{root}/dp/2", 1, detail_page()), (f"{root}/dp/2", 2, detail_page())],
        "url string, seen int, html string",
    )
    rich = run.transform(found, details, ["seen"], limit=5)
    assert rich.count() == 3 and rich.filter("brand is null").count() == 1
    # The two products differ in their URL only, which is no priority column; the third has no brand.
    rows = run.load(rich).collect()
    assert [r["product_detail_url"] for r in rows] == [f"{root}/dp/1"]
    assert rows[0]["description"] == "one\ntwo\nlong" and rows[0]["date_collected"] == "2025-07-05"
    assert run.transform(found, details, ["seen"], limit=1).count() == 1


def test_attributes_of_repeated_tags_are_read_once(monkeypatch):
    """A bounded number of short ones is kept."""
    read = []
    monkeypatch.setattr(html, "_KNOWN", {})
    monkeypatch.setattr(html, "_MOST_KNOWN", 3)
    attributes = html.attributes
    monkeypatch.setattr(html, "attributes", lambda raw: read.append(raw) or attributes(raw))
    page = html.Page('<p class="a">x</p>' * 5 + f'<p id="{"i" * 300}"></p>' * 2 + "".join(f"<p id={i}></p>" for i in range(9)))
    assert [page.attrs(i) for i in range(5)] == [{"class": "a"}] * 5 and len(read) == 1
    assert [len(page.attrs(i)["id"]) for i in (5, 6)] == [300, 300] and len(read) == 3
    assert [page.attrs(i)["id"] for i in range(7, 16)] == [*"012345678"] and len(html._KNOWN) <= 3


def test_elements_with_text_only():
    """They are read in one step, unless what looks like their end tag ends something else."""
    page = html.Page("<p><b>x</b><br>y</br><i/>z</i></p><p>u</P><template><b>t</b></template><script>s</script>v")
    assert page.tags == ["p", "b", "br", "i", "p", "template", "b", "script"]
    assert page.ends == [4, 2, 3, 4, 5, 7, 7, 8] and page.texts == ["x", "y", "z", "u", "v"]
    assert [page.text(i) for i in range(8)] == ["xyz", "x", "", "", "u", "", "", ""]
    assert html._ELEMENT.findall("<b>x</b>") == [("b", "", "x", "")]


def test_plain_pages_are_told_where_they_are_dealt(spark):
    """Not in the scan of what they are made from, which may have few splits."""
    made = spark.range(50).repartition(7, "id").select("id", F.concat(F.lit("<p>s-latency-cf-section "), F.col("id").cast("string")).alias("html"))
    plan = pages.extract_records(made, pages.LISTING_PAGE, keep=["id"], jvm=True)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[1:]
    assert len(below) == 2 and not any("RLIKE" in part.split("Generate")[0] for part in below)


NEST_STARTS = [
    "div", 'div class="a"', 'div class="a  b" id="z"', 'div id="z"', 'div class=" a-section a-spacing-base "', 'div class="a-section a-spacing-base"', "p", 'p class="b a" class="c"',
    'a href="x?a=1&amp;b=2"', 'a class="w a-link-normal" href="/dp/1" href="/dp/2"', 'a class="c" class="a-link-normal" href="/q"', "h2", "li", "ul", "span", 'span class="b a"',
    'span class="ab"', 'span class="rush-component s-latency-cf-section"', 'span data-component-type="s-product-image"', 'b class="a-price"', 'i class="a-offscreen"', 'b href="y"', "sp", "x1",
    'b class="a-offscreen" title="a class="', "em", "li", "li", "li", "li", "h2", "ul", "span",
]
NEST_VOIDS = ["<br>", "<br/>", "<hr />", '<img src="a b">', '<img class="s-image" src="/i">', '<img class="a-price b" src="s">', '<img class="a-offscreen">', '<input class="a">']
NEST_TEXTS = ["text ", " ", " &amp; ", "&amp;lt;", "&nbsp;", " x\x1c", "é\U0001f600", "&amp;nbsp; ", " a  b\n ", "&quot;&#39;"]


def nested_page(rng, deep):
    """Elements in elements, each with its end tag."""
    some = []
    for _ in range(rng.randrange(0, 4 if deep else 2)):
        kind = rng.random()
        if kind < 0.25 or not deep:
            some.append(rng.choice(NEST_TEXTS))
        elif kind < 0.4:
            some.append(rng.choice(NEST_VOIDS))
        else:
            start = rng.choice(NEST_STARTS)
            some.append(f"<{start}>{nested_page(rng, deep - 1)}</{start.split()[0]}>")
    return "".join(some)


NESTED_CHECKED = [
    *CHECKED,
    pages.LISTING_PAGE,
    pages.Profile((Match("div"),), {"own": pages.Rule("texts", (Match("p"), Match("span"))), "raw": pages.Rule("raw", (Match(classes=("a",)),)), "src": pages.Rule("attr", (Match("img"),), attr="src", outer=True)}, record=Match("div")),
    pages.Profile((), {"any": pages.Rule("texts", (Match(),)), "void": pages.Rule("text", (Match(classes=("a-offscreen",)),)), "br": pages.Rule("raw", (Match("br"),))}, record=Match(classes=("a-price",))),
]


@pytest.mark.parametrize("number", range(len(NESTED_CHECKED)))
def test_nested_pages_are_read_by_patterns(spark, number):
    """The same records as from the Arrow pass, many of them without the fold."""
    rng, profile = random.Random(number), NESTED_CHECKED[number]
    region = '<span class="rush-component s-latency-cf-section">{}</span>'
    rows = [(i, (region if i % 2 else '<div class="a"><div id="z">{}</div></div>').format("".join(nested_page(rng, 7) for _ in range(4)))) for i in range(1500)]
    rows += [(-1, None), (-2, ""), (-3, "<div>" * 30 + "</div>" * 30), (-4, '<div class="a"><li><h2><span> x </span></h2>' + "<p>" * 40 + "y" + "</p>" * 40 + "</li></div>")]
    df = spark.createDataFrame(rows, "page_id int, html string").repartition(4)
    one = pages.extract_records(df, profile, keep=["page_id"])
    two = pages.extract_records(df, profile, keep=["page_id"], jvm=True)
    assert sorted(map(str, two.collect())) == sorted(map(str, one.collect()))
    few = df.filter(plain.is_nested(F.col("html")))
    assert few.count() > 500 and plain._by_patterns(profile)
    found = few.select("page_id", F.expr(plain._by_nesting(profile, "html")).alias("r"))
    read = found.filter("r is not null")
    assert read.count() > 0.2 * few.count() and read.selectExpr("sum(size(r))").head()[0] > 40


def test_nested_pages_are_not_folded(spark, monkeypatch):
    monkeypatch.setattr(plain, "_folded", lambda profile, html: f"cast(raise_error('folded') as array<struct<{', '.join(f'{c}: {r.type}' for c, r in profile.fields.items())}>>)")
    page = REGION.format(before="", after="", cards=card(LINK, NAME)).replace("\n", "")
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert [r.name_text for r in products.page_cards(df, ["page_id"], jvm=True).collect()] == ["Cat Food"]


@pytest.mark.parametrize("body", ['<a title="x href=" id="q" href="/y">z</a>', "<abbr/><b>x</b><abbr/>y", '<b title="class="> u</b>', '<a href="/x?a=">z</a>'])
def test_misleading_attributes(spark, body):
    """A value that ends like the start of an attribute, a short name that closes itself."""
    profile = pages.Profile((Match("div"),), {"href": pages.Rule("attr", (Match("a"),), attr="href"), "own": pages.Rule("text", (Match("abbr"),)), "id": pages.Rule("present", (Match(classes=("u",)),))})
    df = spark.createDataFrame([(1, f"<div>{body}</div>")], "page_id int, html string")
    rows = [pages.extract_records(df, profile, ["page_id"], jvm=jvm).collect() for jvm in (False, True)]
    assert rows[0] == rows[1] and len(rows[0]) == 1
