"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words.  A passage's features say how it is written
(character classes, word lengths, repetition, symbols); it is encoded by one tanh layer.  Gated
attention, learned from document labels only, weighs the encoded passages, and the weighted
sum gives the score.  Trained with numpy on a bounded sample of labelled documents, of which
at most TRAIN_PASSAGES passages each; scoring reads every passage of every document.

Defined results: null, empty and white texts are one passage without words.  Without labels of
both kinds every score is the share of label 1, or 0.5 without labels.  Repeated rows score
alike; a null doc_id is scored and not held out.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from marketweave.llm import tokens
from marketweave.llm.labelled import fold, sample

PASSAGE = 48
SAMPLE_ROWS = 6000
TRAIN_PASSAGES = 64
THRESHOLD = 0.3
HIDDEN, GATE, EPOCHS, BATCH = 16, 8, 24, 128

#: Character classes counted in a passage.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"#*$%&", b"|<>=~^_{}[]@\\/+", b"\"'()-", bytes(range(0xC0, 0x100)))
FEATURES = len(CLASSES) + 9


def _counts(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bits) + 1, np.int32)
    np.cumsum(bits, out=total[1:])
    return (total[b] - total[a]).astype(np.float32)


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of each text, and the passage where each text begins."""
    found = tokens.words(column, lower=False)
    first = found.bounds()
    n_words = np.diff(first)
    n_parts = np.maximum(1, -(-n_words // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(n_parts)])
    doc = np.repeat(np.arange(len(n_words)), n_parts)
    a = first[doc] + (np.arange(len(doc)) - begin[doc]) * PASSAGE
    b = np.minimum(a + PASSAGE, first[doc + 1])
    out = np.zeros((len(doc), FEATURES), np.float32)
    full = np.flatnonzero(b > a)
    if len(full):
        a, b = a[full], b[full]
        n = (b - a).astype(np.float32)
        size = (found.end - found.start).astype(np.float32)
        chars = np.add.reduceat(size, a)
        for j, members in enumerate(CLASSES):
            table = np.zeros(256, bool)
            table[list(members)] = True
            out[full, j] = _counts(table[found.data], found.start[a], found.end[b - 1]) / chars
        at = len(CLASSES)
        values = tokens.hashes(found)
        part = np.repeat(np.arange(len(full)), b - a)
        with np.errstate(over="ignore"):
            keyed = np.sort(tokens.mix(values + tokens.mix(part.astype(np.uint64))) >> np.uint64(24) | (part.astype(np.uint64) << np.uint64(40)))
        fresh = np.append(True, keyed[1:] != keyed[:-1])
        out[full, at] = np.add.reduceat(fresh, a).astype(np.float32) / n
        for lag in (1, 2):
            same = np.zeros(len(values), np.float32)
            same[lag:] = (values[lag:] == values[:-lag]) & (found.doc[lag:] == found.doc[:-lag])
            out[full, at + lag] = np.add.reduceat(same, a) / n
        mean = chars / n
        out[full, at + 3] = mean / 10
        out[full, at + 4] = np.sqrt(np.maximum(0, np.add.reduceat(size**2, a) / n - mean**2)) / 10
        last = found.data[found.end - 1]
        table = np.zeros(256, bool)
        table[list(b"#*$%&|!")] = True
        out[full, at + 5] = np.add.reduceat(table[last].astype(np.float32), a) / n
        out[full, at + 6] = np.add.reduceat((size == 1).astype(np.float32), a) / n
        out[full, at + 7] = n / PASSAGE
        gap = np.zeros(len(found.data) + 1, bool)
        gap[:-1] = found.data == 10
        out[full, at + 8] = np.minimum(1, _counts(gap[:-1], found.start[a], found.end[b - 1]) / n * 4)
    return out, begin


def encode(model: dict, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Scores of the bags, and what the gradient needs."""
    h = np.tanh(((x - model["mean"]) / model["scale"]) @ model["w"] + model["b"])
    v, u = np.tanh(h @ model["v"]), 1 / (1 + np.exp(-(h @ model["u"])))
    s = (v * u) @ model["a"]
    at, size = begin[:-1], np.diff(begin)
    e = np.exp(s - np.repeat(np.maximum.reduceat(s, at), size))
    attention = e / np.repeat(np.add.reduceat(e, at), size)
    z = np.add.reduceat(attention[:, None] * h, at)
    score = 1 / (1 + np.exp(-np.clip(z @ model["c"] + model["d"], -30, 30)))
    return score, z, attention, h, v, u


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> dict:
    """Attention network of bags of passage features and their labels."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    share = float(y.mean()) if len(y) else 0.5
    model = {
        "mean": every.mean(axis=0), "scale": every.std(axis=0) + 1e-3,
        "w": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
        "v": rng.normal(0, 0.3, (HIDDEN, GATE)), "u": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE),
        "c": np.zeros(HIDDEN), "d": np.array(np.log((share + 1e-3) / (1 - share + 1e-3))),
    }
    if len(set(y.tolist())) < 2:
        return model
    names = ("w", "b", "v", "u", "a", "c", "d")
    moment = {k: [np.zeros_like(model[k]), np.zeros_like(model[k])] for k in names}
    step = 0
    # The rarer label counts as much as half of the other in all.
    weight = np.where(y == 1, 1.0, max(1.0, 0.5 * share / max(1e-3, 1 - share)))
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            take = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in take])
            begin = np.concatenate([[0], np.cumsum([len(bags[i]) for i in take])])
            score, z, attention, h, v, u = encode(model, x, begin)
            size = np.diff(begin)
            d_out = (score - y[take]) * weight[take] / len(take)
            d_z = np.repeat(d_out[:, None] * model["c"], size, axis=0)
            d_att = (d_z * h).sum(axis=1)
            inner = np.add.reduceat(attention * d_att, begin[:-1])
            d_s = attention * (d_att - np.repeat(inner, size))
            d_gate = d_s[:, None] * model["a"]
            d_v, d_u = d_gate * u * (1 - v**2), d_gate * v * u * (1 - u)
            d_h = (attention[:, None] * d_z + d_v @ model["v"].T + d_u @ model["u"].T) * (1 - h**2)
            x = (x - model["mean"]) / model["scale"]
            grads = {"w": x.T @ d_h, "b": d_h.sum(axis=0), "v": h.T @ d_v, "u": h.T @ d_u, "a": (v * u).T @ d_s, "c": z.T @ d_out, "d": d_out.sum()}
            step += 1
            for k in names:
                g = grads[k] + 1e-4 * model[k]
                m, s = moment[k]
                m[...] = 0.9 * m + 0.1 * g
                s[...] = 0.99 * s + 0.01 * g * g
                model[k] = model[k] - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def _bags(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("bag", pa.binary())])
    for batch in batches:
        for part in tokens.chunks(batch):
            x, begin = passages(part.column("text"))
            bags = []
            for i in range(part.num_rows):
                take = x[begin[i] : begin[i + 1]]
                if len(take) > TRAIN_PASSAGES:
                    take = take[np.linspace(0, len(take) - 1, TRAIN_PASSAGES).astype(int)]
                bags.append(take.tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(bags, pa.binary())], schema=schema)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """The network, from labelled rows outside the held-out fold."""
    marked = sample(docs, labels, "quality", rows, fold("doc_id", 5) != 0)
    found = marked.select("doc_id", "text", "y").mapInArrow(_bags, "doc_id long, y int, bag binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["bag"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in found]
    return fit(bags, np.array([r["y"] for r in found], np.float64))


def _score(batches, model: dict, keep: list[str]):
    for batch in batches:
        for part in tokens.chunks(batch):
            x, begin = passages(part.column("text"))
            score = encode(model, x.astype(np.float64), begin)[0]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(score)], [*keep, "_score"])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of `docs` and `_score`, 0 to 1."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
    return docs.mapInArrow(partial(_score, model=model, keep=docs.columns), schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted` of each document."""
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
