"""Licence scans by a positional rare-token index, in DataFrame functions only.

The places of three fixed phrases are the base.  The method looks for licence notices by their
templates.  Each template is indexed by its RARE words of highest inverse document frequency,
counted over all texts, with their positions in the template.  All words of a file that are in
the index vote for (template, offset), the offset being their place less the template's; postings
are intersected by grouping on it.  Only words of templates whose key phrase's words the file
holds, and LEAST_SHARE of whose weight, are looked up: no other template can be verified.
An offset that gathers LEAST_SHARE of the template's indexed weight is a candidate, and its
mandatory key phrase must stand where the template has it.  The score is the largest share of a
verified template, or of the template of a base label.

Defined results: a null text is empty; without words all counts are 0, places null, labels
empty and the score 0.  A null doc_id keeps its row.  Repeated rows have equal results.  An
empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from marketweave.llm.decontam import _let
from marketweave.session import shared_dir, stage

RARE = 6  # and three fifths of the template's words at most
LEAST_SHARE = 0.5

# Phrases of the base and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# A notice of each licence, and the phrase it must hold.
TEMPLATES = {
    "apache-2": ("licensed under the apache license version 2 0", "apache license version 2"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "cc by sa"),
    "gpl-3": ("licensed under the gnu general public license version 3", "gnu general public license version 3"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    "mit": ("released under the mit license", "mit license"),
    "mpl-2": ("subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    "unlicense": ("free and unencumbered software released into the public domain", "released into the public domain"),
}
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, _GAP), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _places(found: Column, phrase: str) -> Column:
    """Where a phrase's words stand in a row, from 0."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        hit = F.get(found, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(found, i + j) == part, F.lit(False))
        return hit

    rarest = max(parts, key=len)
    every = F.sequence(F.lit(0), F.size(found) - 1)
    return F.when(F.array_contains(found, rarest), F.filter(every, here)).otherwise(F.array().cast("array<int>"))


def _base(found: Column) -> Column:
    places = [_places(found, p) for p in PHRASES]
    return F.struct(
        F.size(found).cast("long").alias("n_words"),
        F.sort_array(F.concat(*places)).alias("at"),
        F.filter(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(places, PHRASES.values())]), lambda x: x.isNotNull()).alias("labels"),
    )


def index(docs: DataFrame) -> list[tuple[str, str, int, float]]:
    """`word, label, position, weight` of the templates' rarest words, as many as the templates allow."""
    vocabulary = sorted({w for text, _ in TEMPLATES.values() for w in text.split()})
    seen = docs.select(F.explode(F.array_intersect(words("text"), _strings(vocabulary))).alias("w")).groupBy("w").count()
    frequency = dict(seen.collect())  # one row per word of the templates at most
    total = docs.count()
    weight = {w: math.log1p(total / max(1, frequency.get(w, 0))) for w in vocabulary}
    out = []
    for label, (text, _) in sorted(TEMPLATES.items()):
        parts = text.split()
        best = sorted(set(parts), key=lambda w: (-weight[w], w))[: min(RARE, -(-3 * len(set(parts)) // 5))]
        out += [(w, label, i, weight[w]) for i, w in enumerate(parts) if w in best]
    return out


def _looked_up(found: Column, entries: list[tuple[str, str, int, float]]) -> Column:
    """The index's words of every template that may be verified in a row of these words."""
    keys = {w for _, key in TEMPLATES.values() for w in key.split()}

    def wanted(held: Column) -> Column:
        parts = []
        for label, (_, key) in sorted(TEMPLATES.items()):
            mine = [(w, weight) for w, of, _, weight in entries if of == label]
            holds = F.lit(True)
            for w in sorted(set(key.split())):
                holds = holds & F.array_contains(held, w)
            weight = sum((F.when(F.array_contains(held, w), x).otherwise(0.0) for w, x in mine), F.lit(0.0))
            # Shares are rounded before they are compared.
            enough = weight >= (LEAST_SHARE - 1e-5) * sum(x for _, x in mine)
            parts.append(F.when(holds & enough, _strings(sorted({w for w, _ in mine}))).otherwise(F.array().cast("array<string>")))
        return F.array_distinct(F.concat(*parts))

    return _let(F.array_intersect(_strings(sorted(keys | {w for w, *_ in entries})), found), wanted)


def scan(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score` of each row."""
    spark = docs.sparkSession
    root = shared_dir(spark)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    entries = index(docs)
    postings = spark.createDataFrame(entries, "word string, label string, position int, weight double")
    whole: dict[str, float] = {}
    for _, label, _, weight in entries:
        whole[label] = whole.get(label, 0.0) + weight

    # The index's words of each file, with their places.
    held = _looked_up(words("text"), entries)
    gated = docs.select("doc_id", "_h", "text", held.alias("_held")).filter(F.size("_held") > 0)
    places = _let(words("text"), lambda ws: F.filter(F.transform(ws, lambda w, i: F.struct(w.alias("word"), i.alias("place"))), lambda x: F.array_contains("_held", x["word"])))
    votes = gated.select("doc_id", "_h", F.explode(places).alias("_p")).select("doc_id", "_h", "_p.*")
    votes = votes.join(F.broadcast(postings), "word").withColumn("offset", F.col("place") - F.col("position"))
    # A place votes once for an offset, so repeated rows do not add up.
    votes = votes.groupBy("doc_id", "_h", "label", "offset", "position").agg(F.max("weight").alias("weight"))
    share = F.col("weight") / F.element_at(F.create_map(*[F.lit(x) for pair in sorted(whole.items()) for x in pair]), F.col("label"))
    cast = votes.groupBy("doc_id", "_h", "label", "offset").agg(F.round(F.sum(share), 6).alias("share")).filter(F.col("share") >= LEAST_SHARE)
    cast = cast.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("label", "offset", "share")).alias("_c"))
    cast = stage(cast, "candidates", root)

    def verified(ws: Column) -> Column:
        def holds(c: Column) -> Column:
            hit = F.lit(False)
            for label, (text, key) in TEMPLATES.items():
                at = text.split().index(key.split()[0]) if text.startswith(key) else len(text[: text.index(" " + key)].split())
                phrase = key.split()
                there = F.lit(True)
                for j, part in enumerate(phrase):
                    there = there & F.coalesce(F.get(ws, c["offset"] + at + j) == part, F.lit(False))
                hit = hit | ((c["label"] == label) & there)
            return hit

        return F.filter("_c", holds)

    on = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_h"] == b["_h"])
    checked = gated.drop("_held").dropDuplicates(["doc_id", "_h"])
    checked = checked.join(cast, on(checked, cast)).select(checked["doc_id"], checked["_h"], _let(words("text"), verified).alias("_v"))
    checked = checked.select("doc_id", "_h", F.transform("_v", lambda c: c["label"]).alias("_found"), F.array_max(F.transform("_v", lambda c: c["share"])).alias("_score"))
    base = docs.select("doc_id", "_h", _let(words("text"), _base).alias("_b"))
    out = base.join(checked, on(base, checked), "left")
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    at = F.col("_b.at")
    return out.select(
        base["doc_id"],
        F.col("_b.n_words").alias("n_words"),
        F.size(at).cast("long").alias("n_base"),
        F.get(at, F.lit(0)).cast("long").alias("first_word"),
        F.get(at, F.size(at) - 1).cast("long").alias("last_word"),
        joined(F.col("_b.labels")).alias("base_labels"),
        joined(F.concat("_b.labels", F.coalesce("_found", F.array().cast("array<string>")))).alias("labels"),
        F.least(F.lit(1.0), F.coalesce("_score", F.lit(0.0))).alias("score"),
    )
