"""Personal data by a character-level bidirectional LSTM with CRF transitions, and fixed patterns.

The patterns are the base and stay.  The network labels characters: outside, or first or later
character of one of the four kinds.  It is trained with numpy on spans that the patterns find
in a bounded sample of texts, with variations of their form (no plus sign, no separators, other
separators), so that it finds forms the patterns do not know.

A text is read in windows of WINDOW characters, each STRIDE after the last.  A span holds a
digit or an at sign by definition, so windows around these are read and others are not.  Where
windows overlap, a character's label scores are averaged, weighted by the distance from the
window's edge, and each run of overlapping windows is decoded as one sequence by Viterbi; so
spans across windows are whole.  A decoded span is added if it does not touch a base span and
holds what its kind needs.

Defined results: a null text is empty; without spans the list is empty.  A null doc_id keeps its
row.  Repeated rows have equal results.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketweave.llm import tokens
from marketweave.llm.labelled import smallest

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
SAMPLE_ROWS = 1500  # texts with digits or at signs, by hashed id
TRAIN_WINDOWS = 3000
HIDDEN, INPUT, STEPS, BATCH = 12, 10, 260, 64
TAGS = 1 + 2 * len(KINDS)  # outside, then first and later of each kind

_LEFT = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# The patterns of the base. A run of digits is entered at its first one only.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GATE = re.compile(r"[0-9@]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """`kind, start, end` of the patterns, by kind, then start."""
    out, after = [], 0
    at = text.find("@")
    while at >= 0:
        run = text[after:at]
        start = after + len(run.rstrip(_LEFT))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
        after = found.end() if found else at + 1
        at = text.find("@", after)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def plausible(kind: int, piece: str) -> bool:
    """What an added span must hold."""
    digits = sum("0" <= c <= "9" for c in piece)
    if kind == 0:
        return "@" in piece[1:-1]
    if kind == 1:
        return digits >= 4 and len(re.findall("[0-9]+", piece)) == 4
    if kind == 2:
        return 13 <= digits <= 19
    return 7 <= digits <= 15


_CLASS = np.full(256, 7, np.int64)  # other
for _c, _members in enumerate((b"0123456789", bytes(range(97, 123)), bytes(range(65, 91)), b" \t\r", b"\n", b".", b"-")):
    _CLASS[list(_members)] = _c
for _c, _member in enumerate(b"@+()_%/,:", 8):
    _CLASS[_member] = _c
CLASSES = 17


def codes(text: str) -> np.ndarray:
    """Class of each character."""
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 255)]


def spots(code: np.ndarray) -> list[tuple[int, int]]:
    """Stretches around digits and at signs, as multiples of STRIDE, merged where they touch."""
    cell = np.unique(np.flatnonzero((code == 0) | (code == 8)) // STRIDE)
    out: list[tuple[int, int]] = []
    for c in cell.tolist():
        a, b = max(0, (c - 1) * STRIDE), (c + 2) * STRIDE
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(model: dict, side: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """One direction over `x` (time, batch): hidden states, and what the gradient needs."""
    n = x.shape[1]
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out, trace = np.empty((len(x), n, HIDDEN)), []
    table = model["embed"] @ model["wx" + side] + model["b" + side]
    for t in range(len(x)):
        z = table[x[t]] + h @ model["wh" + side]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c_before = h, c
        c = f * c + i * g
        s = np.tanh(c)
        h = o * s
        out[t] = h
        trace.append((i, f, o, g, s, before, c_before))
    return out, trace


def emissions(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of the tags of windows `x` (time, batch)."""
    forth, _ = _run(model, "f", x)
    back, _ = _run(model, "r", x[::-1])
    return forth @ model["of"] + back[::-1] @ model["or"] + model["bias"]


def _back(model: dict, side: str, x: np.ndarray, trace: list, d_out: np.ndarray, grads: dict) -> None:
    d_h, d_c = np.zeros_like(trace[0][5]), np.zeros_like(trace[0][5])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, s, before, c_before = trace[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - s**2)
        d_z = np.concatenate([d_c * g * i * (1 - i), d_c * c_before * f * (1 - f), d_h * s * o * (1 - o), d_c * i * (1 - g**2)], axis=1)
        e = model["embed"][x[t]]
        grads["wx" + side] += e.T @ d_z
        grads["wh" + side] += before.T @ d_z
        grads["b" + side] += d_z.sum(axis=0)
        np.add.at(grads["embed"], x[t], d_z @ model["wx" + side].T)
        d_h, d_c = d_z @ model["wh" + side].T, d_c * f


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _crf(model: dict, e: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood, and its gradients for emissions and transitions."""
    n_t, n_b, _ = e.shape
    trans = model["trans"]
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, n_t):
        alpha[t] = e[t] + _logsum(alpha[t - 1][:, :, None] + trans, 1)
    for t in range(n_t - 2, -1, -1):
        beta[t] = _logsum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    whole = _logsum(alpha[-1], 1)
    d_e = np.exp(alpha + beta - whole[None, :, None])
    d_t = np.zeros_like(trans)
    batch = np.arange(n_b)
    gold = np.zeros(n_b)
    for t in range(n_t):
        gold += e[t, batch, y[t]]
        d_e[t, batch, y[t]] -= 1
        if t:
            pair = alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - whole[:, None, None]
            d_t += np.exp(pair).sum(axis=0)
            gold += trans[y[t - 1], y[t]]
            np.add.at(d_t, (y[t - 1], y[t]), -1)
    return float((whole - gold).mean()), d_e / n_b, d_t / n_b


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    """The network, of windows of character classes and tags (window, time)."""
    rng = np.random.default_rng(seed)
    model = {"embed": rng.normal(0, 0.5, (CLASSES, INPUT)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
    for side in "fr":
        model["wx" + side] = rng.normal(0, 0.3, (INPUT, 4 * HIDDEN))
        model["wh" + side] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        model["b" + side] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        model["o" + side] = rng.normal(0, 0.3, (HIDDEN, TAGS))
    model["bias"][0] = 2.0
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    for step in range(1, STEPS + 1 if len(x) else 1):
        take = rng.integers(0, len(x), BATCH)
        xs, ys = x[take].T, y[take].T
        forth, trace_f = _run(model, "f", xs)
        back, trace_r = _run(model, "r", xs[::-1])
        e = forth @ model["of"] + back[::-1] @ model["or"] + model["bias"]
        _, d_e, d_t = _crf(model, e, ys)
        grads = {k: np.zeros_like(v) for k, v in model.items()}
        grads["trans"], grads["bias"] = d_t, d_e.sum(axis=(0, 1))
        grads["of"], grads["or"] = np.einsum("tbh,tbk->hk", forth, d_e), np.einsum("tbh,tbk->hk", back[::-1], d_e)
        _back(model, "f", xs, trace_f, d_e @ model["of"].T, grads)
        _back(model, "r", xs[::-1], trace_r, (d_e @ model["or"].T)[::-1], grads)
        norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
        for k, (m, s) in moment.items():
            g = grads[k] * min(1.0, 5 / (norm + 1e-9))
            m[...] = 0.9 * m + 0.1 * g
            s[...] = 0.99 * s + 0.01 * g * g
            model[k] = model[k] - 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    # A later character only follows the first or a later one of its kind.
    for kind in range(len(KINDS)):
        wrong = np.ones(TAGS, bool)
        wrong[[1 + 2 * kind, 2 + 2 * kind]] = False
        model["trans"][wrong, 2 + 2 * kind] = -1e4
    return model


def _viterbi(e: np.ndarray, trans: np.ndarray) -> list[int]:
    score, back = e[0].copy(), np.empty(e.shape, np.int64)
    score[2::2] = -1e4
    for t in range(1, len(e)):
        step = score[:, None] + trans
        back[t] = step.argmax(axis=0)
        score = step.max(axis=0) + e[t]
    path = [int(score.argmax())]
    for t in range(len(e) - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


#: Weight of a window's character: least at the edges, where context lacks.
_EDGE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def tag_texts(model: dict, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """`kind, start, end` that the network finds in each text."""
    stretches, windows = [], []
    for n, text in enumerate(texts):
        if not _GATE.search(text):
            continue
        code = codes(text)
        for a, b in spots(code):
            part = np.full(b - a, 4, np.int64)
            cut = code[a:b]
            part[: len(cut)] = cut
            at = range(0, max(1, len(part) - WINDOW + 1), STRIDE)
            stretches.append((n, a, len(part), len(windows), len(cut)))
            windows += [np.pad(part[i : i + WINDOW], (0, max(0, WINDOW - len(part) + i)), constant_values=4) for i in at]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    scores: list[np.ndarray] = []
    for i in range(0, len(windows), 2048):
        scores.extend(emissions(model, np.stack(windows[i : i + 2048], axis=1)).transpose(1, 0, 2))
    for n, a, length, first, real in stretches:
        total, weight = np.zeros((length, TAGS)), np.zeros((length, 1))
        for j, i in enumerate(range(0, max(1, length - WINDOW + 1), STRIDE)):
            total[i : i + WINDOW] += (_EDGE[:, None] * scores[first + j])[: length - i]
            weight[i : i + WINDOW, 0] += _EDGE[: length - i]
        path = _viterbi(total / weight, model["trans"])[:real]
        start = kind = None
        for t, tag in enumerate([*path, 0]):
            if start is not None and (tag == 0 or tag % 2 == 1):
                out[n].append((kind, a + start, a + t))
                start = None
            if tag % 2 == 1:
                start, kind = t, tag // 2
    return out


def spans(model: dict, texts: list[str]) -> tuple[list, list]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    every = []
    for text, fixed, found in zip(texts, base, tag_texts(model, texts)):
        mine = []
        taken = sorted((s, e) for _, s, e in fixed)
        starts = np.array([s for s, _ in taken])
        reach = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
        for kind, start, end in found:
            piece = text[start:end]
            start, end = start + len(piece) - len(piece.lstrip()), end - (len(piece) - len(piece.rstrip()))
            before = int(np.searchsorted(starts, end)) if taken else 0
            if start < end and not (before and reach[before - 1] > start) and plausible(kind, text[start:end]):
                mine.append((kind, start, end))
        every.append(sorted(fixed + mine))
    return base, every


def _said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(found))


def _varied(text: str, found: list[tuple[int, int, int]], rng) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with the forms of some of its spans changed, and where they are then."""
    parts, out, at, size = [], [], 0, 0
    for kind, start, end in sorted(found, key=lambda x: x[1]):
        if start < at:
            continue
        piece = text[start:end]
        turn = rng.integers(0, 4)
        if kind == 3 and turn == 0:
            piece = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", piece)
        elif kind == 3 and turn == 1:
            piece = re.sub(r"[() ]+", "-", piece).strip("-")
        elif kind == 2 and turn == 0:
            piece = "".join(c + ("." if i % 4 == 3 else "") for i, c in enumerate(re.sub("[ -]", "", piece))).strip(".")
        parts += [text[at:start], piece]
        size += start - at
        out.append((kind, size, size + len(piece)))
        size += len(piece)
        at = end
    return "".join([*parts, text[at:]]), out


def _around(batches):
    """Character classes and tags of the windows around spans and digits of training texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.binary()), ("y", pa.binary())])
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            rng = np.random.default_rng(doc % 2**32)
            text, found = _varied(text, base_spans(text), rng)
            code, tag = codes(text), np.zeros(len(text), np.int8)
            for kind, start, end in found:
                tag[start:end] = 2 + 2 * kind
                tag[start] = 1 + 2 * kind
            for a, b in spots(code)[:8]:
                a = max(0, min(a + int(rng.integers(0, STRIDE)), len(text) - WINDOW))
                x, y = np.full(WINDOW, 4, np.int8), np.zeros(WINDOW, np.int8)
                x[: len(code[a : a + WINDOW])], y[: len(tag[a : a + WINDOW])] = code[a : a + WINDOW], tag[a : a + WINDOW]
                rows.append((doc, x.tobytes(), y.tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """The network, from a bounded sample of the texts that hold a digit or an at sign."""
    some = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").rlike("[0-9@]"))
    ids = smallest(some.select("doc_id").distinct(), "doc_id", rows)
    found = some.join(F.broadcast(ids), "doc_id").mapInArrow(_around, "doc_id long, x binary, y binary")
    found = found.orderBy(F.xxhash64("x", "doc_id"), "x").limit(TRAIN_WINDOWS).collect()
    x, y = (np.array([np.frombuffer(r[c], np.int8) for r in found]).reshape(-1, WINDOW).astype(np.int64) for c in "xy")
    return fit(x, y)


def _scan(batches, model: dict):
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
    for batch in batches:
        for part in tokens.chunks(batch):
            texts = [t or "" for t in part.column("text").to_pylist()]
            base, every = spans(model, texts)
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, sha, pa.array([_said(e) for e in every], pa.string())], schema=schema)


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans` of each row."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(partial(_scan, model=model), f"doc_id long, {counts}, base_sha256 string, spans string")
