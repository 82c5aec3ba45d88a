"""Mixing to target token weights with soft domain membership.

A multinomial classifier over hashed words, counted on the executors from a labelled table
(text and domain), gives every document posteriors over the domains.  Each document gets a
rate, the number of copies to draw of it on average, 0 or more.  Rates minimise the squared
distance between the expected domain tokens, sum of rate * tokens * posterior, and the targets,
as shares of the whole, starting from rate 1.  The gradient with respect to a rate only needs
the residual of each domain, so a step is one small aggregate over the (tokens, posterior)
table; rates are recomputed from the residuals so far and never stored between steps.  The
token-weighted metric makes the steps' size independent of the documents' lengths.

Defined results: a document without words has no tokens, posteriors equal to the domains'
shares, and rate 1.  A null domain or text is no training row.  Without training rows
posteriors are even.  A target domain without labelled rows keeps its share of the prior only.
Repeated rows have equal rates; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from marketweave.llm import tokens
from marketweave.session import shared_dir, stage

BUCKETS = 4096  # hashed words of the classifier
LABELLED_ROWS = 20000  # labelled documents that train the classifier, by hashed id
STEPS = 60
CLOSE = 1e-5  # largest residual, as a share of all tokens, at which fitting ends
#: Tokens of the longest text that count as evidence; more would not move a posterior.
CERTAIN = 30.0
#: Shares of the expected tokens for the domains of the test tables.
TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def _bucketed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each word."""
    found = tokens.words(column)
    return found.doc, (tokens.hashes(found) >> np.uint64(20)).astype(np.int64) % BUCKETS


def _counted(batches, domains: list[str]):
    """Counts of (domain, bucket) of one task's rows, as one row each."""
    total = np.zeros((len(domains), BUCKETS), np.int64)
    at = {d: i for i, d in enumerate(domains)}
    for batch in batches:
        for part in tokens.chunks(batch):
            doc, bucket = _bucketed(part.column("text"))
            mine = np.array([at.get(d, -1) for d in part.column("domain").to_pylist()], np.int64)[doc]
            np.add.at(total, (mine[mine >= 0], bucket[mine >= 0]), 1)
    d, b = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(d.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[d, b])], ["domain", "bucket", "n"])


def train(labelled: DataFrame, domains: list[str]) -> np.ndarray:
    """Log probabilities of buckets by domain, and the log prior as last column.

    `labelled` has `text` and `domain`; all of it counts.  At most domains * BUCKETS sums reach
    the driver.
    """
    rows = labelled.filter("text is not null and domain is not null").select("text", F.col("domain").cast("string").alias("domain"))
    counts = rows.mapInArrow(partial(_counted, domains=domains), "domain int, bucket int, n long")
    counts = counts.groupBy("domain", "bucket").agg(F.sum("n").alias("n")).collect()
    table = np.full((len(domains), BUCKETS), 0.5)
    for r in counts:
        table[r["domain"], r["bucket"]] += r["n"]
    prior = table.sum(axis=1) / table.sum()
    return np.c_[np.log(table / table.sum(axis=1, keepdims=True)), np.log(prior)]


def _posterior(batches, model: np.ndarray, keep: list[str]):
    for batch in batches:
        for part in tokens.chunks(batch):
            doc, bucket = _bucketed(part.column("text"))
            n = np.bincount(doc, minlength=part.num_rows)
            logit = np.stack([np.bincount(doc, weights=row[bucket], minlength=part.num_rows) for row in model[:, :-1]], axis=1)
            logit = logit / np.maximum(1, n / CERTAIN)[:, None] + model[:, -1]
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            # Rounded, so that sums do not depend on the order of tasks.
            p = np.round(p, 9)
            out = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(n.astype(np.int64)), out], [*keep, "_tokens", "_p"])


def posteriors(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """All columns of `docs`, with `_tokens` and the domains' posteriors `_p`."""
    fields = [T.StructField("_tokens", T.LongType()), T.StructField("_p", T.ArrayType(T.DoubleType()))]
    return docs.mapInArrow(partial(_posterior, model=model, keep=docs.columns), T.StructType([*docs.schema.fields, *fields]))


def _rate(p: str, pulls: list[list[float]]):
    """The rate after the steps so far: each adds its pull along the posterior and stops at 0."""
    if not pulls:
        return F.lit(1.0)
    rows = "array(" + ", ".join("array(" + ", ".join(f"{v!r}D" for v in pull) + ")" for pull in pulls) + ")"
    dot = " + ".join(f"{p}[{i}] * g[{i}]" for i in range(len(pulls[0])))
    return F.expr(f"aggregate({rows}, 1.0D, (r, g) -> greatest(0.0D, r + {dot}))")


def fit(members: DataFrame, targets: list[float]) -> list[list[float]]:
    """Pulls of the projected-gradient steps. `members` has `_tokens` and `_p`."""
    k = len(targets)
    cells = [F.sum(F.col("_tokens") * F.col("_p")[i] * F.col("_p")[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(k)]
    first = members.agg(F.sum("_tokens").alias("n"), *cells).first()
    if not first["n"]:
        return []
    whole = float(first["n"])
    curve = np.array([first[f"c{i}_{j}"] for i in range(k) for j in range(k)]).reshape(k, k) / whole
    size = 1 / max(1e-9, float(np.linalg.eigvalsh(curve)[-1]))
    goal = np.array(targets) / sum(targets)
    pulls: list[list[float]] = []
    momentum, before = 1.0, None
    for _ in range(STEPS):
        rate = _rate("_p", pulls)
        sums = members.select("_tokens", "_p", rate.alias("_r")).agg(*[F.sum(F.col("_tokens") * F.col("_r") * F.col("_p")[i]).alias(f"s{i}") for i in range(k)]).first()
        left = goal - np.array([float(sums[f"s{i}"]) for i in range(k)]) / whole
        if np.abs(left).max() < CLOSE:
            break
        # A plain step; rare domains have a flat gradient, so it grows while the residual falls.
        error = float(np.abs(left).max())
        momentum = min(64.0, momentum * 1.5) if before is not None and error < before else 1.0
        before = error
        pulls.append([round(float(v), 12) for v in size * momentum * left])
    return pulls


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """All columns of `docs`, with `n_tokens`, `posterior` (in order of the targets' names) and `rate`."""
    domains = sorted(targets)
    root = shared_dir(docs.sparkSession)
    found = posteriors(docs.select(*[F.col(c) for c in docs.columns]), train(labelled, domains))
    slim = stage(found.select("_tokens", "_p"), "members", root)
    pulls = fit(slim, [targets[d] for d in domains])
    rate = F.when(F.col("_tokens") == 0, F.lit(1.0)).otherwise(_rate("_p", pulls))
    return found.select(*docs.columns, F.col("_tokens").alias("n_tokens"), F.col("_p").alias("posterior"), rate.alias("rate"))


def copies(rate, key: str = "doc_id"):
    """Whole copies to draw: the rate rounded up or down by a hash of the id, right on average."""
    share = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return (F.floor(rate) + F.when(share < rate - F.floor(rate), 1).otherwise(0)).cast("long")
