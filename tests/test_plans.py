"""Plan shapes of all queries: no pair-wise joins, no row-wise Python, narrow scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from marketweave.functions import urls
from marketweave.operators import quality
from marketweave.plans import run
from marketweave.sources import tables
from workload import inputs as I

SF = "/root/testdata/sf0.001"
PARSE_PAGES = {
    "q_page_region", "q_page_cards", "q_page_detail", "q_product_details", "q_card_project", "q_skip_malformed",
    "q_page_links", "q_resolve_url", "q_block_links", "q_strip_text", "q_run_counts", "q_run_quarantine",
    "q_enrich_pages", "q_enrich_recollected", "q_page_errors", "q_enrich_stored_pages", "q_skip_malformed_jvm", "q_card_project_jvm", "q_product_details_jvm",
}
# Products and cards are staged: what is left to plan parses nothing more.
STAGED = {"q_scan_csv_ranges", "q_listing_run", "q_listing_run_all", "q_run_profile", "q_run_summary", "q_run_quarantine"}
TWO_PASSES = {"q_awkward_markup": 2, "q_enrich_pages": 2, "q_enrich_recollected": 2}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_plan(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan, node
    passes = 0 if name in STAGED else TWO_PASSES.get(name, 1 if name in PARSE_PAGES else 0)
    assert plan.count("MapInArrow") == passes
    # Markup is never moved once it is collected: it may be redistributed before parsing
    # (small test files), but no exchange above the page pass carries it.
    above = plan.split("MapInArrow")[0]
    assert not re.search(r"\bhtml#", above) or name not in PARSE_PAGES or name.endswith("_jvm")
    if name.endswith("_jvm"):  # the branch of expressions: what it generates has left the markup behind
        assert re.search(r"Generate posexplode\(.*?\), \[[^\]]*\]", above) and not re.search(r"Generate posexplode\(.*\), \[[^\]]*\bhtml#[^\]]*\], false", above)


def reads(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)", plan)


def test_scans_read_the_needed_columns(spark):
    plan = plan_of(contract.queries()["q_decimal_cast"](spark, SF))
    assert reads(plan) == ["l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double"]
    plan = plan_of(contract.queries()["q_run_counts"](spark, SF))
    assert reads(plan) == ["page_id:bigint,html:string"]
    plan = plan_of(contract.queries()["q_latest_snapshot_time"](spark, SF))
    assert sorted(set(reads(plan))) in (["o_orderdate:timestamp_ntz"], ["o_orderstatus:string,o_orderdate:timestamp_ntz"],
                                        ["o_orderdate:timestamp_ntz,o_orderstatus:string"])


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("q_parse_price", 0),
        ("q_missing_profile", 1),
        ("q_dropna_subset", 0),
        ("q_select_priority", 0),
        ("q_preview", 0),
        ("q_dedupe_keep_first", 1),
        ("q_first_n", 1),
        ("q_first_n_large", 2),
        ("q_constraint_check", 2),
    ],
)
def test_shuffles(spark, name, exchanges):
    plan = plan_of(contract.queries()[name](spark, SF))
    assert len(re.findall(r"\bExchange\b", plan)) == exchanges


@pytest.mark.parametrize("name", ["q_dedupe_keep_first", "q_first_n", "q_first_n_huge", "q_upsert_insert_only", "q_dedupe_missing_equal"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit.*?Partial", plan, re.S)


def test_predicates_reach_the_scan(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = plan_of(quality.drop_incomplete(lines, ["l_returnflag", "l_tax"]))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_tax)]" in plan
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plan = plan_of(pages.filter(~urls.is_blocked("url", None, [".html"], ["spam-farm"])))
    assert "StringEndsWith(url,.html)" in plan and "StringContains(url,spam-farm)" in plan


def below_exchanges(plan):
    """For each exchange of a plan the text of what is under it."""
    lines = plan.splitlines()
    depth = lambda line: len(re.match(r"[ :|+*-]*", line)[0])
    for i, line in enumerate(lines):
        if re.search(r"[+:]- (\w+ )?Exchange", line) or re.match(r"[ :|+-]*Exchange", line):
            under = []
            for after in lines[i + 1 :]:
                if depth(after) <= depth(line):
                    break
                under.append(after)
            yield "\n".join(under)


def test_stored_pages_stay_where_they_are(spark):
    """Without broadcasts, no exchange stands above a node that carries markup."""
    collected = I.recollected_pages(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stored = tables.save_by_key(collected, "pages_stored_by_url", "url", 8)
    products = spark.range(40).select(F.concat(F.lit(f"{I.SHOP}/dp/"), F.col("id").cast("string")).alias("product_detail_url"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(run.wanted_pages(stored, products))
        moved = plan_of(run.wanted_pages(collected, products))
        found = run.transform(products.withColumn("brand", F.lit("x")), stored, ["collected"], limit=None)
        assert found.filter("review_score is not null").count() > 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "html" in plan
    assert not any("html" in under for under in below_exchanges(plan))
    assert any("html" in under for under in below_exchanges(moved))  # what the test would see


def test_pages_are_made_in_tasks_of_a_bounded_size(spark, monkeypatch):
    """More rows become more tasks, whatever the joins before put together."""
    monkeypatch.setattr(I, "ROWS_A_TASK", 40)
    assert I.order_pages(spark, SF).rdd.getNumPartitions() == -(-I.table(spark, SF, "orders").count() // 40) > 8
    assert I.customer_pages(spark, SF).rdd.getNumPartitions() == max(4, -(-I.table(spark, SF, "customer").count() // 40))
