"""Line dedup, n-gram Jaccard join, decontamination and components against brute force."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketweave import session
from marketweave.llm import components, decontam, jaccard, lines, thin


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def near_copies(rng, groups=12, shared=None):
    """Texts with copies that differ in some words, and a passage that many of them quote."""
    out = []
    for _ in range(groups):
        base = words(rng, rng.randrange(1, 120), 5000)
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(9999)}"
            if shared and rng.random() < 0.6:
                text = text + shared
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("group", [2, 24])
def test_jaccard_components(documents, monkeypatch, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rng = random.Random(group)
    texts = near_copies(rng, 30, words(rng, 30)) + ["", " \n", None, "One two", "one TWO", "one two three", "É a b c d e", "é a b c d e"]
    rows = list(enumerate(texts)) + [(None, "one two"), (3, texts[3])]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(i, j) for i in sets for j in sets if i < j and linked(sets[i], sets[j])]
    assert len(links) > 40
    want = roots(sets, links)
    got = jaccard.jaccard_components(documents(rows).repartition(5)).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.n_shingles == 1
        else:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), want[row.doc_id])


def test_jaccard_passages_that_everyone_quotes(documents, monkeypatch):
    """Sets that consist of shared passages are compared in blocks, and none of their links is lost."""
    monkeypatch.setattr(jaccard, "GROUP", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(4)
    passages = [words(rng, 12, 9000) for _ in range(6)]
    texts = [" ".join(sum(rng.sample(passages, rng.randrange(1, 5)), [])) for _ in range(60)]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = roots(sets, [(i, j) for i in sets for j in sets if i < j and linked(sets[i], sets[j])])
    got = jaccard.jaccard_components(documents(enumerate(texts)).repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_jaccard_texts_of_one_id(documents):
    """An id links where any of its texts does, however large the others are."""
    rng = random.Random(17)
    small, large = words(rng, 60, 5000), words(rng, 600, 5000)
    rows = [(1, " ".join(large)), (1, " ".join(small)), (2, " ".join([*small, "more"])), (3, " ".join(["less", *large])), (4, " ".join(words(rng, 60, 5000)))]
    got = jaccard.jaccard_components(documents(rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_jaccard_keeps_one(documents):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text), (2, text + " z"), (9, "else where it is"), (None, text), (7, ""), (8, ""), (9, "else where it is")]
    kept = jaccard.keep_one(documents(rows)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([2, 9, None, 7, 8])
    assert kept[0].asDict().keys() == {"doc_id", "text", "score"}


def test_signatures_guarantee():
    """Linked sets share more signatures than the larger one has to spare, in its band."""
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 4, 5, 7, 9, 14, 30, 80, 200):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = rng.integers(0, size // 4 + 1)
            b = np.unique(np.append(a[drop:], rng.integers(0, 2**63, rng.integers(0, max(1, size // 8))).astype(np.uint64)))
            big, small = (a, b) if len(a) >= len(b) else (b, a)
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both):
                continue
            of = jaccard.band(len(big))
            assert of in jaccard.bands(len(small))
            for turn in range(3):
                (one, spare), (two, _) = jaccard.signatures([big, small], [of, of], turn)
                assert spare < 0 or len(np.intersect1d(one, two)) > spare


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        pool = rng.integers(0, 2**64, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(2))
        assert jaccard.apart(jaccard.sketch(a), jaccard.sketch(b)) <= len(np.setxor1d(a, b))


def test_groups_over_batches():
    """Groups of any size are met whole, however their rows are cut into batches."""
    rng = random.Random(3)
    sig = sorted(rng.choice([1, 2, 3, 4, 5, 6, 7]) if rng.random() < 0.7 else rng.randrange(100, 200) for _ in range(400))
    doc = list(range(400))
    members = {s: [d for x, d in zip(sig, doc) if x == s] for s in set(sig)}
    want_hot = {(d, s) for s, m in members.items() if len(m) > jaccard.GROUP for d in m}
    want = Counter()
    for m in members.values():
        if len(m) <= jaccard.GROUP:
            want.update((b, a) for i, a in enumerate(m) for b in m[i + 1 :])
    for step in (1, 7, 30, 400):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(sig[i : i + step], pa.int64()), pa.array(doc[i : i + step], pa.int64()), pa.nulls(len(sig[i : i + step]), pa.int32()), pa.nulls(len(sig[i : i + step]), pa.binary())], ["sig", "doc_id", "spare", "info"])
            for i in range(0, 400, step)
        ]
        rows = [r for b in jaccard._meet(batches) for r in b.to_pylist()]
        hot = [(r["a"], r["b"]) for r in rows if r["kind"] == jaccard.HOT]
        assert Counter(hot) == Counter(want_hot)
        pairs = Counter()
        star = set()
        for r in rows:
            if r["kind"] == jaccard.PAIR and r["n"] < jaccard.MANY:
                pairs[r["a"], r["b"]] += r["n"]
            elif r["kind"] == jaccard.PAIR:
                star |= {r["a"], r["b"]}
        assert pairs == want
        assert star == {d for d, _ in want_hot}


def peak_mb(batches):
    tracemalloc.start()
    for _ in batches:
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_of_signing_and_meeting():
    """What a worker holds does not follow the size of its batch or the number of its pairs."""
    rng = np.random.default_rng(5)
    text = " ".join(f"w{i}" for i in rng.integers(0, 30_000, 400))
    every = pa.RecordBatch.from_arrays([pa.array(range(1400)), pa.array([f"{i} {text}" for i in range(1400)])], ["doc_id", "text"])
    assert every.nbytes > 2_500_000
    assert peak_mb(jaccard._sign([every])) < 60
    sig = np.repeat(np.arange(6000), 20)
    doc = rng.integers(0, 2**40, len(sig))
    part = lambda i: pa.RecordBatch.from_arrays([pa.array(sig[i : i + 10_000]), pa.array(doc[i : i + 10_000]), pa.nulls(10_000, pa.int32()), pa.nulls(10_000, pa.binary())], ["sig", "doc_id", "spare", "info"])
    assert peak_mb(jaccard._meet(part(i) for i in range(0, len(sig), 10_000))) < 110


def test_pairs_are_counted_while_they_are_gathered(monkeypatch):
    """A pair comes once with its count, in batches of a bounded size, however often they are counted."""
    monkeypatch.setattr(jaccard, "GATHER", 7)
    for flush, send in ((1000, 3), (10, 3), (1, 1000)):
        monkeypatch.setattr(jaccard, "FLUSH", flush)
        monkeypatch.setattr(jaccard, "SEND", send)
        sig, doc = np.repeat(np.arange(40), 3), np.tile([1, 2, 3, 4, 2, 9], 20)
        batches = [pa.RecordBatch.from_arrays([pa.array(sig[i : i + 12]), pa.array(doc[i : i + 12]), pa.nulls(12, pa.int32()), pa.nulls(12, pa.binary())], ["sig", "doc_id", "spare", "info"]) for i in range(0, 120, 12)]
        found = list(jaccard._meet(batches))
        assert max(b.num_rows for b in found) <= send
        rows = [r for b in found for r in b.to_pylist()]
        if flush == 1000:
            assert len(rows) == 6
        total = Counter()
        for r in rows:
            assert r["kind"] == jaccard.PAIR
            total[r["a"], r["b"]] += r["n"]
        assert total == {(2, 1): 20, (3, 1): 20, (3, 2): 20, (4, 2): 20, (9, 4): 20, (9, 2): 20}


def test_texts_go_to_workers_in_small_batches(spark, documents, monkeypatch):
    """Texts are signed and compared under the limit of a batch, which is as before afterwards."""
    key, size = session.BATCH
    before, seen = spark.conf.get(key), {}

    def noted(df, name, root=None):
        seen[name] = spark.conf.get(key)
        return session.stage(df, name, root)

    monkeypatch.setattr(jaccard, "stage", noted)
    text = " ".join(f"a{i}" for i in range(40))
    assert jaccard.jaccard_components(documents([(5, text), (2, text + " z")])).count() == 2
    assert {seen[name] for name in ("met", "possible_pairs", "links_pairs")} == {size}
    assert spark.conf.get(key) == before
    wide = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('abcdefgh', 500) AS text")
    with session.small_batches(spark):
        sizes = wide.mapInArrow(lambda batches: (b.select(["id"]).slice(0, 1).set_column(0, "id", pa.array([b.nbytes])) for b in batches), "id long").collect()
    assert len(sizes) > 2 and max(r.id for r in sizes) < 5_000_000


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])
    none = spark.createDataFrame([], "x long, y long")
    assert components.components(none, "x", "y").count() == 0


def test_thin(spark):
    df = spark.range(0, 5000).selectExpr("if(id % 10 = 3, null, id) as doc_id", "id as n")
    ids = spark.createDataFrame([(i,) for i in range(0, 5000, 7)], "doc_id long")
    kept = {r.doc_id for r in thin.thin(df, ids).collect()}
    assert {i for i in range(0, 5000, 7) if i % 10 != 3} <= kept and len(kept) < 700
    some, rest = thin.split_by(df, ids)
    assert some.count() + rest.count() == 5000 and rest.filter("doc_id is null").count() == 500


def test_edit_distance(spark):
    rng = random.Random(8)
    pairs = [("", ""), ("", "ab"), ("", "abc"), ("a", "a")]
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 14)))
        b = list(a)
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(0, len(b) + 1)
            b[at : at + rng.randrange(0, 2)] = rng.choice(["", "a", "x"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", lines.edit_within(F.col("a"), F.col("b")).alias("near")).collect():
        assert row.near == (distance(row.a, row.b) <= lines.TAU), row


def changed(rng, line, edits):
    line = list(line)
    for _ in range(edits):
        at = rng.randrange(0, len(line) + 1)
        line[at : at + rng.randrange(0, 2)] = rng.choice(["", "x", "y"])
    return "".join(line)


def deduped(rows):
    """Text and number of removed lines of each document, all pairs of lines compared."""
    found = [(i, p, x) for i, t in rows if i is not None and t is not None for p, x in enumerate(t.split("\n"))]
    found = [(i, p, x) for i, p, x in found if len(x) >= lines.MIN_CHARS or re.search(r"[^\W_]", x)]
    unique = sorted({x for *_, x in found})
    long = sorted((x for x in unique if len(x) >= lines.MIN_CHARS), key=len)
    near = []
    for i, a in enumerate(long):
        for b in reversed(long[:i]):
            if len(a) - len(b) > lines.TAU:
                break
            if distance(a, b) <= lines.TAU:
                near.append((a, b))
    root, first = roots(unique, near), {}
    for i, p, x in sorted(found):
        first.setdefault(root[x], (i, p))
    kept_places, removable = set(first.values()), {(i, p) for i, p, _ in found}
    want = []
    for i, t in rows:
        if i is None or t is None:
            want.append((i, t, 0))
            continue
        cut = t.split("\n")
        kept = [x for p, x in enumerate(cut) if (i, p) not in removable or (i, p) in kept_places]
        want.append((i, "\n".join(kept), len(cut) - len(kept)))
    return want, near


@pytest.mark.parametrize("pairs, core", [(4, 14), (1024, 12)])
def test_line_dedup(documents, monkeypatch, pairs, core):
    monkeypatch.setattr(lines, "PAIRS", pairs)
    monkeypatch.setattr(lines, "CORE", core)
    rng = random.Random(pairs)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(18, 50))) for _ in range(40)]
    rows = [(i, "\n".join(changed(rng, rng.choice(base[:6] if rng.random() < 0.6 else base), rng.randrange(0, 4)) for _ in range(rng.randrange(0, 9)))) for i in range(80)]
    rows += [(90 + i, rng.choice(["Accept all", "-", "* * *", "", "  ", "1.", base[i], "x" * 30]) + "\nAccept all cookies") for i in range(20)]
    rows += [(None, base[0]), (500, None), (501, ""), (502, "\n\n")]
    want, near = deduped(rows)
    assert len(near) > 20
    got = lines.dedup_lines(documents(rows)).collect()
    assert {r.doc_id: (r.text, r._removed) for r in got} == {i: (t, n) for i, t, n in want} and all(r.score == "x" for r in got)
    assert sum("Accept all cookies" in (r.text or "") for r in got) == 1


def test_lines_of_templates(documents, monkeypatch):
    """Numbers in one, two and odd places of lines, so that members are near by chains only."""
    monkeypatch.setattr(lines, "PAIRS", 1)
    rng = random.Random(6)
    forms = [
        lambda: f"Page {rng.randrange(10000):04d} of the yearly report of this company",
        lambda: f"Order {rng.randrange(300)} was sent to customer {rng.randrange(300)} by post",
        lambda: f"{rng.randrange(100000)} visitors have read this article so far",
        lambda: f"This text was last changed at {rng.randrange(24):02d}:{rng.randrange(60):02d}",
        lambda: "Mixed lines of equal length " + "".join(rng.choice("abcd") for _ in range(6)),
    ]
    rows = [(i, "\n".join(rng.choice(forms)() for _ in range(4))) for i in range(160)]
    want, near = deduped(rows)
    got = {(r.doc_id, r.text, r._removed) for r in lines.dedup_lines(documents(rows)).collect()}
    assert len(near) > 1000 and got == set(want)


def test_variants_link_what_is_within_the_distance(spark):
    """Stars of variants give the components of all pairs of an indexed rest and a probed one."""
    rng = random.Random(13)
    for turn in range(6):
        n = turn if turn < 3 else rng.randrange(3, 8)
        rests = list({"".join(rng.choice("ab1") for _ in range(n + d)) for d in (0, 0, 1, 2) for _ in range(12)})
        rows = [(7, i, 0, 0, r) for i, r in enumerate(rests) if len(r) == n] + [(7, i, 1, len(r) - n, r) for i, r in enumerate(rests)]
        df = spark.createDataFrame(rows, "key long, id long, role int, d int, rest string")
        got = [(r.a, r.b) for r in lines._stars(df).collect()]
        assert all(distance(rests[a], rests[b]) <= lines.TAU for a, b in got)
        want = [(a, b) for _, a, role, _, x in rows if role == 0 for _, b, other, _, y in rows if other == 1 and a != b and distance(x, y) <= lines.TAU]
        ids = [str(i) for i in range(len(rests))]
        text = lambda pairs: [(str(a), str(b)) for a, b in pairs]
        assert roots(ids, text(got)) == roots(ids, text(want))


def test_lines_of_repeated_ids(documents):
    line = "The very same line stands in both of these rows"
    rows = [(1, line), (1, line), (1, "x\n" + line), (2, line), (1, "A short one\nOnly here"), (3, "A short one")]
    got = sorted((r.doc_id, r.text, r._removed) for r in lines.dedup_lines(documents(rows)).collect())
    # Equal lines at equal places of one id stay, others go.
    assert got == sorted([(1, line, 0), (1, line, 0), (1, "x", 1), (2, "", 1), (1, "A short one\nOnly here", 0), (3, "", 1)])


def test_line_dedup_is_native(documents):
    plan = lines.dedup_lines(documents([(1, "a" * 30), (2, "a" * 30)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decontamination(spark, documents):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, rng.randrange(15, 40), 3000)).capitalize() + ".") for i in range(30)] + [(90, "only three words"), (91, ""), (None, "x"), (92, None)]
    common = " ".join(words(rng, 8))
    items += [(100 + i, common + " " + " ".join(words(rng, 12, 3000))) for i in range(5)]
    rows = []
    for i in range(60):
        text = words(rng, rng.randrange(0, 80), 3000)
        if rng.random() < 0.5:
            leak = rng.choice(items[:30])[1].split()
            for _ in range(rng.randrange(0, 3)):
                leak[rng.randrange(len(leak))] = "changed"
            if rng.random() < 0.4:  # parts in another order, at other places than in the item
                half = rng.randrange(len(leak))
                leak = leak[half:] + leak[:half]
            at = rng.randrange(len(text) + 1)
            text[at:at] = leak
        rows.append((i, " ".join(text)))
    for i in range(200, 204):  # long items, their halves swapped amid other words
        long = words(rng, 58, 3000)
        items.append((i, " ".join(long)))
        rows.append((i, " ".join(words(rng, 70, 3000) + long[29:] + long[:29] + words(rng, 70, 3000))))
        rows.append((i + 10, " ".join((long[:50] + ["odd"]) * 40)))
    # Two texts of one id, of which one holds an item; cut short by the text's end.
    rows += [(230, items[4][1]), (230, " ".join(words(rng, 40, 3000))), (231, " ".join(items[5][1].split()[:-1])), (232, " ".join([*words(rng, 30, 3000), *items[6][1].split()[:-2]]))]
    rows += [(70, "well, ONLY three\nwords here"), (71, common), (None, items[0][1]), (72, None), (73, ""), (74, items[3][1].upper())]
    cut = lambda t: [w for w in re.split(r"[^\w]+", (t or "").lower()) if w]
    runs = lambda w, q: [tuple(w[i : i + q]) for i in range(len(w) - q + 1)]
    targets = {i: cut(t) for i, t in items if i is not None and cut(t)}
    df = Counter(s for w in targets.values() for s in set(runs(w, min(5, len(w)))))
    weight = lambda s: round(1000 * float(np.log1p(len(targets) / df.get(s, 1))))
    want = set()
    for d, t in rows:
        text = cut(t)
        for i, w in targets.items():
            q = min(5, len(w))
            mine = set(runs(w, q))
            for at in range(len(text)):
                there = set(runs(text[at : at + len(w)], q))
                both, either = sum(map(weight, mine & there)), sum(map(weight, mine | there))
                if d is not None and both >= decontam.SIMILARITY * either:
                    want.add((d, i))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.leaks(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 15
    kept = {r.doc_id for r in decontam.drop_leaks(documents(rows), benchmark).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}
    assert decontam.leaks(documents([]), benchmark).count() == 0
    assert decontam.leaks(documents(rows), benchmark.limit(0)).count() == 0
    monkey = decontam.BROADCAST_ROWS
    decontam.BROADCAST_ROWS = 0
    try:
        again = decontam.leaks(documents(rows), benchmark).collect()
    finally:
        decontam.BROADCAST_ROWS = monkey
    assert sorted(again) == sorted(got)


def test_blocks_guarantee_the_radius():
    blocks = decontam._blocks()
    assert len(blocks) == decontam.RADIUS + 1 and sum(n for _, n in blocks) == 64
    rng = random.Random(2)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontam.RADIUS):
            b ^= 1 << bit
        assert any((a >> at) % (1 << n) == (b >> at) % (1 << n) for at, n in blocks)
