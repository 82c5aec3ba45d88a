"""The pipeline against its operators applied one after the other, and against brute force."""

import random
import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from marketweave.llm import mixing, quality

from .test_pairs import deduped, linked, roots, shingles
from .test_rows import ODD, junk, prose

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with junk, copies, repeated lines, a leak, and odd rows."""
    rng = random.Random(21)
    root = str(tmp_path_factory.mktemp("tables"))
    texts = [prose(rng, rng.randrange(30, 120)) for _ in range(120)]
    texts += [junk(rng) for _ in range(30)]
    leak = prose(rng, 25)
    texts[3] += " " + leak
    for i in (10, 11, 12):
        texts[i] = texts[9].replace(" ", "  ", 1) + (" more" if i == 12 else "")
    line = "This very line stands in many of the documents here."
    for i in (20, 25, 30):
        texts[i] = texts[i] + "\n" + line.replace("many", "many" if i < 30 else "mani")
    texts[40] = line
    rows = [(i, t, rng.choice(["en", "fr"]), "s", len(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)] + [(None, texts[0] + " x", None, None, None), (7, *rows[7][1:])]
    spark.createDataFrame([(*r, "z") for r in rows], DOCUMENT).write.parquet(f"{root}/documents.parquet")
    marks = [(i, int(i < 120), 0) for i in range(150)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def staged(spark, folder, tmp_path_factory):
    """What each stage was given and gave."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for number, (name, apply) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        apply(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    return staged(spark, folder, tmp_path_factory)


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(steps):
    assert [name for name, *_ in steps] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
    ]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    _, before, after = steps[-1]
    assert set(after.columns) == {*before.columns, "rate", "copies"}


def test_quality_stage(spark, folder, steps):
    _, before, after = steps[0]
    scores = {r.doc_id: r._score for r in quality.score(before, quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"))).collect()}
    kept = [r.doc_id for r in after.collect()]
    assert set(kept) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    assert sum(i is not None and i < 120 for i in set(kept)) > 115 and sum(i is not None and 120 <= i < 150 for i in kept) < 4


def test_line_stage(steps):
    _, before, after = steps[1]
    rows = {r.doc_id: r.text for r in before.collect()}
    want = {}
    for i, kept, removed in deduped(list(rows.items()))[0]:
        if not removed or re.search(r"[^\x20\x09-\x0D]", kept):
            want[i] = kept
    assert texts_of(after) == want and any(t != rows[i] for i, t in want.items())
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.doc_id is not None and r.text is not None and r.doc_id < 150)


def test_copies_stage(steps):
    _, before, after = steps[2]
    rows = texts_of(before.filter("doc_id is not null"))
    sets = {i: shingles(t) for i, t in rows.items()}
    root = roots(sets, [(i, j) for i in sets for j in sets if i < j and linked(sets[i], sets[j])])
    assert sorted(r.doc_id for r in after.filter("doc_id is not null").collect()) == sorted(i for i in sets if root[i] == i)
    assert after.filter("doc_id is null").count() == before.filter("doc_id is null").count()


def test_leak_stage(steps):
    _, before, after = steps[3]
    gone = set(texts_of(before)) - set(texts_of(after))
    assert gone == {3}


def test_mixing_stage(spark, steps):
    _, before, after = steps[4]
    rows = after.collect()
    assert all(r.copies > 0 and r.rate > 0 for r in rows)
    assert {r.doc_id: r.text for r in rows}.items() <= texts_of(before).items()
    assert set(mixing.TARGETS) == {"en", "fr", "de", "es"}


def test_run(spark, folder, steps):
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, steps[-1][2].collect()))
    assert contract.queries()["pipeline"] and set(contract.oracle_sql()) <= set(contract.queries())


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    names = [q for q in contract.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
