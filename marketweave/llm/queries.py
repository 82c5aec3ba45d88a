"""One query per operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketweave.llm import (
    decontam, filter_audit, jaccard, labelled, licenses, lines, mainhtml, mixing, packing, pii, quality, rules, toxicity, whitening,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each document with its repeated lines cut."""
    found = lines.dedup_lines(_table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op2_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Each document and benchmark item it holds."""
    return decontam.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of each document."""
    return quality.scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`text, domain` of a bounded sample of the documents in the labelled table; a document's
    domain is its language."""
    ids = labels.filter("doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    ids = labelled.smallest(ids, "_id", mixing.LABELLED_ROWS)
    return docs.join(F.broadcast(ids), docs["doc_id"] == F.col("_id")).select("text", F.col("lang").alias("domain"))


def op4_mixing_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Rate and copies of each document."""
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    marked = labelled_domains(docs, _table(spark, sf, "labels"))
    found = mixing.mix(docs.select("doc_id", "text"), marked, mixing.TARGETS)
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(sorted(mixing.TARGETS))]
    return found.select("doc_id", "n_tokens", *shares, "rate", mixing.copies(F.col("rate")).alias("copies"))


def op5_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf, "documents"))


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of each document; the trusted texts are those labelled as good."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    good = _table(spark, sf, "labels").filter("quality = 1")
    return rules.judge(docs, rules.weights(docs, rules.trusted(docs, good)))


def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licence phrases and labels of each document."""
    return licenses.scan(_table(spark, sf, "documents"))


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of personal data in each document."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return pii.scan(docs, pii.train(docs))


def op9_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of each page."""
    pages = _table(spark, sf, "pages")
    return mainhtml.extract(pages, mainhtml.train(pages))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of each document."""
    return toxicity.scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of each document's tokens with their places in sequences."""
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What each filter does in each order of the five."""
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Whitened components of each embedding."""
    return whitening.whiten(_table(spark, sf, "embeddings"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_mixing_weights": op4_mixing_weights,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_html_extraction": op9_html_extraction,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_embedding_whitening": op13_embedding_whitening,
}

#: The other operators train a model or verify by hashes; tests compare them with brute force.
ORACLE: dict[str, str] = {
    "op5_ngram_jaccard_join": r"""
      WITH RECURSIVE
      w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
      s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS g FROM w),
      n AS (SELECT doc_id, len(g) AS n FROM s),
      u AS (SELECT doc_id, unnest(g) AS h FROM s),
      both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      e AS (SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
      r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
      SELECT n.doc_id, n.n AS n_shingles, c.component_id
      FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON n.doc_id = c.a""",
    "op12_filter_audit": r"""
      WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        e AS (SELECT t, min(doc_id) AS first FROM w GROUP BY t),
        l AS (SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
            len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
            coalesce(w.doc_id > first, false)] AS fails
          FROM w JOIN e USING (t) LEFT JOIN l ON w.doc_id = l.doc_id),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
        x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
        o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
          WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        s AS (SELECT o, i AS step, o[i] AS own, o[1:i - 1] AS before FROM o, x),
        r AS (SELECT part, o, step, own, n, good, toxic, fails[own] AS failed,
            len(list_filter(before, lambda b: fails[b])) > 0 AS gone, len(list_filter(fails, lambda b: b)) AS k FROM c, s)
      SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::int AS step,
        coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0)::bigint AS kept,
        coalesce(sum(n) FILTER (failed AND NOT gone), 0)::bigint AS removed,
        coalesce(sum(n) FILTER (failed AND gone), 0)::bigint AS redundant,
        coalesce(sum(n) FILTER (failed AND k = 1), 0)::bigint AS unique_fails,
        coalesce(sum(good) FILTER (failed AND NOT gone), 0)::bigint AS good_lost,
        coalesce(sum(toxic) FILTER (failed AND NOT gone), 0)::bigint AS toxic_lost,
        sum(sum(n) FILTER (failed AND NOT gone)) OVER (PARTITION BY part, own)::bigint AS shapley
      FROM r GROUP BY part, o, step, own""",
}
