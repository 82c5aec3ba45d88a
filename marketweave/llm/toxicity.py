"""Toxicity by a weighted finite-state pattern grammar.

The lexicon (words and stems with weights) is learned from labelled rows: log-odds of being in
a toxic text.  A clause that holds an entry becomes a sequence of symbols, which a cascade of
transducers reads: insult, threat, target, negation, reported speech.  Each passes the symbol
on and changes the clause's weight: a target near an insult raises it, a threat against a
target adds one, a negation before an insult lowers it, and so does a verb of reporting at the
head of the clause.  The cascade is composed into one table before any text is read.  A
document's score is a logistic function of its clauses' weights, fitted on the same rows.

The lexicon keeps the LEXICON entries of most evidence; SAMPLE_ROWS bounds the labelled rows.

Defined results: null, empty and white texts have no clause and get the score of texts without
any match.  Without labels of both kinds the lexicon is empty and every score is the share of
label 1, or 0 without labels.  A null doc_id is scored and not held out.  Repeated rows score
alike.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketweave.llm import tokens
from marketweave.llm.labelled import fold, sample

SAMPLE_ROWS = 20000
LEXICON = 4000  # entries kept, by evidence
STEMS = (4, 5, 6)  # leading characters that may be an entry
THREATENED = 3.0  # weight of a threat against a target, about that of a learned entry
LEAST = 3  # toxic texts an entry must be in
THRESHOLD = 0.3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Words of the grammar's closed classes in English, French, German and Spanish.
CLOSED = {
    THREAT: "kill hurt destroy hunt punch tuer frapper töten schlagen vernichten matar golpear",
    TARGET: "you your yours u they them tu toi vous ton votre du dich dir sie ihr tú usted vosotros te",
    NEGATION: "not no never isn't aren't wasn't don't pas jamais nicht kein keine nie nunca jamás",
    REPORT: "said says say called calls wrote reported claims quoted dit appelé sagte nannte schrieb dijo llamó escribió",
}
TAGS = {word: tag for tag, words in CLOSED.items() for word in words.split()}
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
GAP = re.compile(r"[\W_]+")

# A transducer maps (state, symbol) to (state, symbol, factor of the symbol's weight, weight added).


def insults(state: int, symbol: int):
    """An insult right after an insult counts a little more: name-calling in a row."""
    if symbol == INSULT:
        return 1, symbol, 1.2 if state else 1.0, 0.0
    return 0, symbol, 1.0, 0.0


def threats(state: int, symbol: int):
    """A threat word adds weight once a target or an insult follows within three words."""
    if symbol == THREAT:
        return 3, symbol, 1.0, 0.0
    if state and symbol in (TARGET, INSULT):
        return 0, symbol, 1.0, THREATENED
    return max(0, state - 1), symbol, 1.0, 0.0


def targets(state: int, symbol: int):
    """State 1-3: words left after a target; 4-6: after an insult without one."""
    if symbol == TARGET:
        return 3, symbol, 1.0, 0.3 if state > 3 else 0.0
    if symbol == INSULT:
        return (0, symbol, 1.3, 0.0) if 0 < state < 4 else (6, symbol, 1.0, 0.0)
    return (0 if state in (0, 1, 4) else state - 1), symbol, 1.0, 0.0


def negations(state: int, symbol: int):
    """An insult at most two words after a negation counts less."""
    if symbol == NEGATION:
        return 3, symbol, 1.0, 0.0
    if symbol == INSULT and state:
        return 0, symbol, 0.5, 0.0
    return max(0, state - 1), symbol, 1.0, 0.0


def reports(state: int, symbol: int):
    """After a verb of reporting the rest of the clause is somebody else's."""
    if symbol == REPORT:
        return 1, symbol, 1.0, 0.0
    return state, symbol, 0.6 if state and symbol == INSULT else 1.0, 0.0


def compose(*machines) -> list[list[tuple[int, float, float]]]:
    """One table of the cascade: for each reachable state and symbol the next state, factor and addition."""
    states, table = {(0,) * len(machines): 0}, []
    queue = list(states)
    for now in queue:
        row = []
        for symbol in range(6):
            after, factor, added = [], 1.0, 0.0
            for machine, state in zip(machines, now):
                state, symbol, times, plus = machine(state, symbol)
                after.append(state)
                factor, added = factor * times, added + plus
            after = tuple(after)
            if after not in states:
                states[after] = len(states)
                queue.append(after)
            row.append((states[after], factor, added))
        table.append(row)
    return table


def grammar() -> list[list[tuple[int, float, float]]]:
    return compose(insults, threats, targets, negations, reports)


def automaton(lexicon: dict[str, float]) -> ahocorasick.Automaton:
    """Finds lexicon entries and threats in a text whose words are parted by one space. Stems end in `*`."""
    found = ahocorasick.Automaton()
    for entry in [*lexicon, *CLOSED[THREAT].split()]:
        found.add_word(" " + entry[:-1] if entry.endswith("*") else f" {entry} ", entry)
    found.make_automaton()
    return found


def _weight(word: str, lexicon: dict[str, float]) -> float:
    return max([lexicon.get(word, 0.0), *(lexicon.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n)])


def features(text: str | None, lexicon: dict[str, float], found, table) -> tuple[float, ...]:
    """Sum and largest of the weights of matched clauses, matches, and matches per hundred words."""
    text = (text or "").lower()
    if next(found.iter(" " + GAP.sub(" ", text) + " "), None) is None:
        return 0.0, 0.0, 0.0, 0.0
    total = most = 0.0
    matches = n_words = 0
    for clause in CLAUSE.split(text):
        state, weight, hit = 0, 0.0, False
        for word in WORD.findall(clause):
            n_words += 1
            own = _weight(word, lexicon)
            symbol = INSULT if own else TAGS.get(word, OTHER)
            state, factor, added = table[state][symbol]
            weight += own * factor + added
            matched = own > 0 or added >= THREATENED
            hit |= matched
            matches += matched
        if hit:
            total += weight
            most = max(most, weight)
    return np.log1p(total), most, np.log1p(matches), min(1.0, 20 * matches / max(1, n_words))


def learn(marked: DataFrame) -> dict[str, float]:
    """Weights of words and stems of `marked` (`text`, `y`), counted on the executors."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1))
    stems = [F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substr(w, F.lit(1), F.lit(n)), F.lit("*"))) for n in STEMS]  # noqa: B023
    entries = marked.select("y", F.explode(F.array_distinct(F.concat(words, *stems))).alias("entry"))
    sizes = dict(marked.groupBy("y").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = entries.groupBy("entry").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).filter(F.col("t") >= LEAST)
    odds = F.log((F.col("t") + 0.1) / (toxic + 0.2)) - F.log((F.col("c") + 0.5) / (clean + 1))
    # Chance coincidences of frequent pieces have low odds; rare ones lack evidence.
    counts = counts.withColumn("odds", odds).filter((F.col("odds") > 2.5) & (F.col("t") * 2 > F.col("c")))
    best = counts.orderBy(F.desc(F.col("odds") * F.sqrt("t")), "entry").limit(LEXICON)
    return {r["entry"]: round(float(r["odds"]), 6) for r in best.collect()}


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights and intercept by Newton steps, the rarer label weighted up to half."""
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return np.array([0.0] * x.shape[1] + [30.0 if share else -30.0])
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y == 1, max(1.0, 0.5 * (1 - share) / share), 1.0)
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        beta = beta - np.linalg.solve(curve, slope)
    return beta


def _features(batches, lexicon: dict[str, float]):
    found, table = automaton(lexicon), grammar()
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))])
    for batch in batches:
        x = [[float(v) for v in features(t.as_py(), lexicon, found, table)] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], schema=schema)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and logistic weights. The rows that fit the score are not those that chose the lexicon."""
    marked = sample(docs, labels, "toxic", rows, fold("doc_id", 4) != 2)
    half = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3))
    lexicon = learn(marked.filter(half != 0).select("text", "y"))
    found = marked.filter(half == 0).select("doc_id", "text", "y").mapInArrow(partial(_features, lexicon=lexicon), "doc_id long, y int, x array<double>").collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in found]).reshape(-1, 4)
    return lexicon, fit(x, np.array([r["y"] for r in found], np.float64))


def _score(batches, lexicon: dict[str, float], beta: np.ndarray):
    found, table = automaton(lexicon), grammar()
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_matches", pa.int64())])
    for batch in batches:
        for part in tokens.chunks(batch):
            x = np.array([features(t.as_py(), lexicon, found, table) for t in part.column("text")]).reshape(-1, 4)
            score = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(np.rint(np.expm1(x[:, 2])).astype(np.int64))], schema=schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted, n_matches` of each document."""
    lexicon, beta = train(docs, labels)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(partial(_score, lexicon=lexicon, beta=beta), "doc_id long, score double, n_matches long")
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_matches")
