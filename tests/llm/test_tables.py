"""Packing, the filter audit and whitening against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketweave.llm import filter_audit, packing, queries, whitening

from .test_rows import ODD, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Characters at which a tokenizer may part or join otherwise.
PIECES = [*"aAzZ09'’ \t\n\r\v\f\x1c\x85\xa0 　éÉÀßſİıΣσςǅﬁ한글가中文日😀👍🏽ªº²½<|>.,!?-_​­̧́", "'s", "'t", "'re", "<|endoftext|>", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


# --- packing ---------------------------------------------------------------------------


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [prose(rng), "it's <|endoftext|> we'll", "Straße, ÉTÉ... naïve?!", "x" * 5000, *(t or "" for t in ODD)]
    for special in (True, False):
        tokenizer.encode_special_tokens = not special
        ids = packing.Ids(tokenizer.to_str(), special)
        for text in texts:
            assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    tokenizer.encode_special_tokens = False


def test_words_are_forgotten_and_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 5)
    ids, rng = packing.Ids(tokenizer.to_str()), random.Random(4)
    for _ in range(30):
        text = prose(rng, 20)
        assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_patterns_hold_every_length_once():
    rng = random.Random(8)
    for _ in range(50):
        size = rng.choice([1, 7, 64, 2048])
        histogram = {rng.randrange(1, size + 1): rng.choice([1, 2, 3, 1000]) for _ in range(rng.randrange(0, 40))}
        found = packing.patterns(histogram, size)
        held = {}
        for lengths, count in found:
            assert 0 < sum(lengths) <= size and count > 0 and list(lengths) == sorted(lengths, reverse=True)
            for n in lengths:
                held[n] = held.get(n, 0) + count
        assert held == histogram
        # No two packs would fit into one.
        totals = sorted(sum(lengths) for lengths, count in found for _ in range(min(2, count)))
        assert len(totals) < 2 or totals[0] + totals[1] > size


def checked(rows, docs, tokenizer, size, waste):
    """Every id of every document once, sequences without gap or overlap."""
    want = sorted((str(i), t) for i, t in docs)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs}
    pieces = {}
    for r in rows:
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
    left = {}
    for i, t in want:
        left.setdefault((i, len(ids[t])), []).append(t)
    assert set(left) == set(pieces)
    for key, texts in left.items():
        expected = sorted(zlib.crc32(np.array(ids[t][r.start : r.start + r.length], "<u4").tobytes()) for t in texts for r in {(p.start, p.length): p for p in pieces[key]}.values())
        assert sorted(r.ids_crc32 for r in pieces[key]) == expected
        assert sum(r.length for r in pieces[key]) == key[1] * len(texts)
    packs = {}
    for r in rows:
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(packs) == list(range(len(packs)))
    filled = 0
    for held in packs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= size
        filled += at
    assert size * len(packs) - filled <= max(size, waste * size * len(packs))


@pytest.mark.parametrize("size", [2048, 64, 1])
def test_pack(documents, tokenizer, size):
    rng = random.Random(size)
    docs = [(i, prose(rng, rng.randrange(0, 40 if size < 2048 else 900))) for i in range(60 if size > 1 else 8)]
    docs += [(100 + i, t) for i, t in enumerate(ODD) if size > 1 or len(t or "") < 100] + [(None, "no id"), (None, "no id"), (3, docs[3][1]), (4, "another text")]
    docs += [(200 + i, docs[0][1]) for i in range(20)]
    got = packing.pack(documents(docs), VOCABULARY, size)
    assert got.columns == list(packing._COLUMNS)
    checked(got.collect(), docs, tokenizer, size, packing.WASTE)


def test_long_texts_are_read_in_segments(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing.tokens, "CHUNK", 500)
    rng = random.Random(5)
    docs = [(1, prose(rng, 3000)), (2, "é" * 2000), (3, "short")]
    rows = []
    for batch in packing._cut([__import__("pyarrow").table({"doc_id": [1, 2, 3], "text": [t for _, t in docs]}).to_batches()[0]], tokenizer.to_str(), 128, 128, True):
        rows += batch.to_pylist()
    for i, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        mine = [r for r in rows if r["doc_id"] == i]
        assert sum(r["length"] for r in mine) == len(ids) == mine[0]["doc_tokens"]
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())


def test_rests_are_cut_where_they_fit_badly(documents, tokenizer):
    docs = [(i, " ".join(["a"] * 39)) for i in range(300)]  # 40 ids with the end
    rows = packing.pack(documents(docs), VOCABULARY, 64).collect()
    checked(rows, docs, tokenizer, 64, packing.WASTE)
    assert max(r.sequence_id for r in rows) < 300 * 40 / 64 * 1.02 + 1


def test_pack_empty(documents):
    assert packing.pack(documents([]), VOCABULARY).count() == 0


# --- filter audit ----------------------------------------------------------------------


def audited(rows, labels):
    """Counts by the definition: each order applied to all documents, one filter after the other."""
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    docs = []
    for i, text, lang in rows:
        t = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t],
        }
        docs.append((i, lang or "", fails))
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(i, f) for i, p, f in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            there, gone = mine, []
            for step, name in enumerate(order, 1):
                removed = [(i, f) for i, f in there if f[name]]
                there = [(i, f) for i, f in there if not f[name]]
                shapley[name] += len(removed)
                out[part, "".join(order), step] = [
                    len(there), len(removed), sum(f[name] for _, f in gone), sum(f[name] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed),
                ]
                gone = gone + removed
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def audit_rows():
    rng = random.Random(12)
    texts = [prose(rng, rng.choice([20, 220, 400])) for _ in range(60)]
    texts += [t + " $5" for t in texts[:10]] + [t.upper() for t in texts[10:20]] + ["same word " * 150, *texts[:25], *texts[:5]]
    rows = [(i, t, rng.choice(["en", "fr", "", None])) for i, t in enumerate(texts)]
    rows += [(1000 + i, t, "en") for i, t in enumerate([*ODD, *ODD])] + [(None, texts[0], "en"), (None, texts[0], None), (0, texts[0], "fr"), (2000, "É" * 300, "is")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 120, 2)] + [(None, 1, 1), (4, 1, None), (4, None, 0)]
    return rows, [(i, q, None if x is None else int(x)) for i, q, x in labels]


def audit_tables(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, lang string, mask int, part string")
    return docs, spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, text string")


def test_audit(spark):
    rows, labels = audit_rows()
    got = filter_audit.audit(*audit_tables(spark, rows, labels))
    assert dict(got.dtypes)["step"] == "int" and {t for c, t in got.dtypes[3:]} == {"bigint"}
    found = {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()}
    want = audited(rows, labels)
    assert len(found) == 600 * 4 and found == want


@pytest.mark.parametrize("cells", [1, 64])
def test_audit_with_a_full_sketch(spark, monkeypatch, cells):
    monkeypatch.setattr(filter_audit, "MOST", cells)
    rows, labels = audit_rows()
    found = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(*audit_tables(spark, rows, labels)).collect()}
    assert found == audited(rows, labels)


def test_audit_hashes_anew_where_texts_collide(spark, monkeypatch):
    plain = filter_audit._hashed
    monkeypatch.setattr(filter_audit, "_hashed", lambda docs, seed: plain(docs, seed) if seed else plain(docs, seed).withColumns({"h1": F.lit(1).cast("long"), "h2": F.lit(2).cast("long")}))
    rows, labels = audit_rows()
    found = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(*audit_tables(spark, rows, labels)).collect()}
    assert found == audited(rows, labels)


def test_sketch_clears_unique_texts_only(spark):
    rows = spark.range(3000).select((F.col("id") % 2500).alias("v")).select(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v")
    marked = filter_audit._marked(rows, filter_audit.sketch(rows, 2**15), 2**15).groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.max("unique").alias("u")).collect()
    assert not any(r.u for r in marked if r.n > 1) and sum(r.u for r in marked if r.n == 1) > 1900


def test_audit_empty(spark):
    docs, labels = audit_tables(spark, [], [])
    assert filter_audit.audit(docs, labels).count() == 0


# --- whitening -------------------------------------------------------------------------


def whitened(spark, rows, **more):
    table = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, component int, _x string")
    return whitening.whiten(table, **more).collect()


def brute(rows, k=16):
    """n, deviations, eigenvalues and whitened rows by a dense eigenvalue solver."""
    usable = [(i, v) for i, v in rows if v is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in usable])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    a = (n * fit - sums) / n
    value, vector = np.linalg.eigh(a.T @ a / n)
    value, vector = value[::-1], vector[:, ::-1]
    kept = min(k, int((value > 1e-9 * value[0]).sum()))
    return usable, n, ((n * x - sums) ** 2).sum(axis=1), value, ((n * x - sums) / n) @ vector[:, :kept] / np.sqrt(value[:kept])


@pytest.mark.parametrize("size, rank", [(24, 24), (5, 5), (20, 7)])
def test_whiten(spark, size, rank):
    rng = np.random.default_rng(size)
    base = rng.normal(size=(300, rank)) * np.linspace(1, 4, rank)
    mix = np.eye(size) if rank == size else rng.integers(-2, 3, size=(rank, size))
    made = np.floor(64 * base) / 64 @ mix + 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(made)]
    rows += [(i, rows[0][1]) for i in range(400, 600)] + [(None, rows[1][1]), (1, rows[1][1]), (7, None), (8, [None] + [1.0] * (size - 1))]
    rows += [(9, [float("nan")] * size), (10, [float("inf")] * size), (11, []), (12, [1.0] * (size + 1)), (13, [3e38] * size)]
    got = whitened(spark, rows)
    usable, n, deviation, value, white = brute([r for r in rows if r[0] not in (12, 13) or r[1] is rows[0][1] or len(r[1]) == size and r[1][0] < 1e30])
    k = white.shape[1]
    assert k == min(16, rank) and len(got) == k * len(usable) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    mine = {}
    for r in got:
        mine.setdefault(r.vec_id, {})[r.component] = r
    sign = None
    for (i, _), d, w in zip(usable, deviation, white):
        rows_of = [mine[i][c] for c in range(1, k + 1)]
        assert all(r.deviation == d for r in rows_of)
        seen = np.array([r.whitened for r in rows_of])
        if sign is None:
            sign = np.sign(seen * w)
        assert np.allclose(seen, w * sign, atol=1e-7)
        assert np.allclose([r.explained for r in rows_of], value[:k] / value.sum(), rtol=1e-8)


def test_whiten_without_components(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, None), (2, [])]) == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert len(whitened(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0])])) == 2
    assert len(whitened(spark, [(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [0.0, 0.0])], components=1)) == 3


def test_factors_stay_right_where_a_gram_matrix_is_singular_in_doubles(spark):
    """Dimensions that nearly agree: one pass over the Gram matrix would lose the small direction."""
    rng = np.random.default_rng(3)
    big, small = rng.integers(-(2**30), 2**30, 400), rng.integers(-1, 2, 400)
    table = spark.createDataFrame([(i, [float(a), float(a) + float(b)]) for i, (a, b) in enumerate(zip(big.tolist(), small.tolist()))], "vec_id long, embedding array<double>")
    got = whitening.whiten(table).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-4
    gap = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == 2])
    # What the large direction tells of the small one is not in the second component.
    large, rest = big - big.mean(), small - small.mean()
    rest = rest - large * (large @ rest) / (large @ large)
    assert abs(np.corrcoef(gap, rest)[0, 1]) > 1 - 1e-9


def test_gram_is_summed_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(50, 4)))]
    *_, white = brute(rows)
    got = np.zeros((50, 4))
    for r in whitened(spark, rows):
        got[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(np.abs(got), np.abs(white), atol=1e-8)


def test_queries_apply_the_operators(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op13_embedding_whitening(spark, sf).count() == 16 * 500
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.op11_packing(spark, sf)
    assert found.select("doc_id").distinct().count() == docs.count()
