import datetime
import math
import re
from urllib.parse import urlencode, urljoin

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from marketweave.functions import parse, text, urls

MIXED = [
    "Pet Food  Dry & Wet!",
    "Café\u00a0Crème — ½ x²",
    "  lead_and trail_ ",
    "a\x1cb\u2003c\u3000d\te\n f",
    "collars & leashes",
    "ÄÖÜ ß İ",
    "_",
    "",
    " ",
    "日本語 テスト 42",
    "x\u200by",
    None,
]


def _clean(s):
    return " ".join(re.sub(r"[^\w\s]", "", s).lower().split())


def test_slug_and_query_follow_unicode_words(column):
    expected = [None if s is None else _clean(s) for s in MIXED]
    assert column(MIXED, text.clean_words) == expected
    assert column(MIXED, text.slug) == [None if s is None else s.replace(" ", "_") for s in expected]
    assert column(["collars & leashes"], lambda c: text.normalize_query(text.F.lit("pet accessories"), c)) == [
        "pet accessories collars leashes"
    ]


def test_safe_key(column):
    expected = [None if s is None else re.sub(r"\W+", "_", s) for s in MIXED]
    assert column(MIXED, text.safe_key) == expected


def test_strip(column):
    values = ["\u00a0 a b \u2003\n", "", "  ", "x"]
    assert column(values, text.strip_text) == [v.strip() for v in values]


def test_compose_description(spark):
    rows = [("One\nTwo", "Long"), (None, "Long"), (None, None), ("", ""), ("A", None)]
    df = spark.createDataFrame(rows, "b string, d string")
    got = [r[0] for r in df.select(text.compose_description("b", "d")).collect()]
    assert got == ["one\ntwo\nlong", "long", "", "", "a"]


def test_money_refuses_what_is_too_wide(spark):
    df = spark.createDataFrame([(1.005,), (float("nan"),), (None,)], "v double")
    assert [str(r[0]) for r in df.select(parse.money("v")).collect()] == ["1.01", "None", "None"]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="too wide"):
            spark.createDataFrame([(1e9,)], "v double").select(parse.money("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


PRICES = {
    "AED 12.50": (12.5, "AED"),
    "12.50": (12.5, ""),
    "AED 1,299.00": (None, None),
    "AED12.50": (None, None),
    "From AED 12": (None, None),
    "": (None, None),
    "AED\u00a012.50": (12.5, "AED"),
    "12.50 AED": (None, None),
    "12 a b": (12.0, ""),
    "AED 1e3": (1000.0, "AED"),
    "AED 12.5d": (None, None),
    "AED 0x1p3": (None, None),
    "AED 1_000": (1000.0, "AED"),
    "AED 1__0": (None, None),
    "AED inf": (math.inf, "AED"),
    "د.إ ١٢.٥": (12.5, "د.إ"),
    "  AED   7 ": (7.0, "AED"),
    "+5.": (5.0, ""),
    None: (None, None),
}


def test_parse_price(column):
    got = column(list(PRICES), parse.parse_price)
    assert [(r["price"], r["currency"]) for r in got] == list(PRICES.values())
    nan = column(["AED nan", "-NaN"], parse.parse_price)
    assert all(math.isnan(r["price"]) for r in nan)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-_.eEinfa ٣\u00a0,d", max_size=9), min_size=40, max_size=80))
def test_price_text_reads_like_float(column, texts):
    def expected(s):
        parts = s.split()
        try:
            currency, number = parts if len(parts) == 2 else ("", parts[0])
            return repr(float(number)), currency
        except (ValueError, IndexError):
            return "None", None

    got = column(texts, parse.parse_price)
    assert [(repr(r["price"]), r["currency"]) for r in got] == [expected(s) for s in texts]


def test_reviews_and_score(column):
    assert column(["1,234 ratings", "7", "none", ",", "", None, "(12,5) of 3"], parse.parse_reviews) == [
        1234.0, 7.0, None, None, None, None, 125.0,
    ]
    assert column(["4.5 out of 5", ".", "x", "4.5.", None, "score: 3"], parse.parse_score) == [
        4.5, None, None, None, None, 3.0,
    ]


DATES = {
    "2025-07-05": 1, "2025-7-5": 1, "05/07/2025": 1, "5/7/2025": 1, "2025/07/05": 1,
    "20250705": 0, "2025-07-05 10:00:00": 0, "junk": 0, None: 0, "25-07-05": 0, "2025-13-01": 0,
    "2025-02-30": 0, "0000-01-01": 0, "2025-07-05\n": 0, "31/04/2025": 0, "07/31/2025": 0, "": 0,
}


def test_parse_date(column):
    day = datetime.date(2025, 7, 5)
    assert column(list(DATES), parse.parse_date) == [day if ok else None for ok in DATES.values()]


NUMBERS = [
    "12.5", "n/a", " 12 ", "\t12\n", "1E5", ".5", "5.", "+5", "Infinity", "-inf", "nan", "-nan", "1_000", "12.5d",
    "0x10", "1,000", "", "1e400", "١٢", "1.5f", "12 3", "True-ish", "+.5e-3",
]


def test_coerce_numeric_like_the_dataframe_library(column):
    expected = [float(pd.to_numeric(pd.Series([v, "7"], dtype=object), errors="coerce")[0]) for v in NUMBERS]
    got = column(NUMBERS, parse.coerce_numeric)
    assert got == [None if math.isnan(v) else v for v in expected]
    assert column([1.5, float("nan"), None], parse.coerce_numeric, "double") == [1.5, None, None]


def test_money(column):
    got = column([1.005, 2.675, -0.125, 99999999.99, None, float("nan")], parse.money, "double")
    assert [None if v is None else str(v) for v in got] == ["1.01", "2.68", "-0.13", "99999999.99", None, None]
    with pytest.raises(Exception):
        column([1e9], parse.money, "double")


def test_search_url(column):
    queries = ["pet food dry food", "a*b~c & d", "é ü", "x+y"]
    expected = [f"https://m.example/s?{urlencode({'k': q, 'ref': 'nb_sb_noss'})}" for q in queries]
    assert column(queries, lambda c: urls.search_url(urls.F.lit("https://m.example"), c)) == expected


BASES = [
    "https://m.example",
    "https://m.example/",
    "http://m.example/a/b/c?x=1#f",
    "https://m.example/a/b/",
    "https://M.example:8080/a?q",
    "HTTP://m.example/a",
    "",
]
REFS = [
    "/dp/1", "dp/1", "//cdn.example/i.png", "https://o.example/x", "http://o.example/x", "", "?q=2", "#top",
    "../x", "../../x", "./x", "a/./b/../c", "/a/../../b", "..", ".", "/x/..", "mailto:a@b", "javascript:void(0)",
    "a//b", "/a//b", "x?y=../z", "x#../z", " /lead", "/t\tab", "g;x=1/../y", "/a/b/./", "https:rel", "HTTPS://O.example/Q",
    "/a?b#c", "/a?b", "/a#", "/a?", "/a?#", "/a?#f", "/a b", "/.x", "/a/..b", "https://o.example", "https://o.example/..?",
    "http://o.example/a b", "http://o.example/?#", "https:///x", "é/ü", "data:x", "/", "a/b/c/../../../..",
]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url(column, base):
    got = column(REFS, lambda c: urls.resolve_url(urls.F.lit(base), c))
    assert dict(zip(REFS, got)) == {r: urljoin(base, r) for r in REFS}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(BASES),
            st.lists(st.sampled_from(["a", "b.c", "..", ".", "", "x;p", "é"]), max_size=6),
            st.sampled_from(["", "?q=1", "#f", "?a=../b#c"]),
        ),
        min_size=40,
        max_size=80,
    )
)
def test_resolve_url_property(spark, cases):
    rows = [(i, base, "/".join(parts) + tail) for i, (base, parts, tail) in enumerate(cases)]
    rows = [r for r in rows if not r[2].startswith("//")]
    df = spark.createDataFrame(rows, "i int, base string, ref string")
    got = df.select("base", "ref", urls.resolve_url("base", "ref").alias("u")).collect()
    assert [(r["base"], r["ref"], r["u"]) for r in got] == [(r["base"], r["ref"], urljoin(r["base"], r["ref"])) for r in got]


def test_blocked_requests(spark):
    rows = [
        ("https://x/y.mp4", "document", True),
        ("https://x/y.mp4?y=1", "document", False),
        ("https://x/y", "media", True),
        ("https://x/y", "audio", True),
        ("https://x/y", None, False),
        ("https://a.doubleclick.net/z", "script", True),
        ("https://x/y.MP4", "image", False),
        ("https://x/adsystem.com", None, True),
    ]
    df = spark.createDataFrame(rows, "url string, type string, expected boolean")
    got = df.select(urls.is_blocked("url", "type").alias("b"), "expected").collect()
    assert [r["b"] for r in got] == [r["expected"] for r in got]


def test_a_space_before_a_one_digit_day(column):
    values = [" 5/07/2025", "2025-07- 5", "2025/07/ 5", " 15/07/2025", "  5/07/2025", "5/ 7/2025"]
    found = column(values, parse.parse_date)
    assert found[:3] == [datetime.date(2025, 7, 5)] * 3 and found[3:] == [None] * 3
