"""A quality classifier from weak labels.

Heuristics vote good, bad or nothing on each text. Expectation-maximisation over the counts of
vote patterns (their number is bounded by the number of heuristics) estimates how often each
heuristic is right, without any given label. The posterior of a text's pattern is its label; a
linear scorer over hashed features is fitted to the labels of a bounded sample and scores all.
"""

import math
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.quality_rules import STOP_WORDS, SYMBOLS
from tallyloom.session import written

#: Hashed features; texts that the scorer is fitted to at most (those of the smallest hashes).
DIMENSION = 1 << 12
TRAINING_ROWS = 20_000
ROUNDS, STEPS = 50, 60

_STOPS = frozenset(w.encode() for w in STOP_WORDS)
_SYMBOLS = SYMBOLS.encode()
_MARKS = b".,;:!?"

#: Shares of fewer words say nothing; only symbols are judged in such texts.
SHORT = 12
#: Heuristics: a measure of a text, and the bounds below which and above which it votes
#: ((bound, vote) each, None for no vote). Votes: 1 good, -1 bad.
HEURISTICS = [
    ("stop_share", (0.05, -1), (0.12, 1)),
    ("symbol_share", (0.01, 1), (0.1, -1)),
    ("repeat_share", (0.02, 1), (0.3, -1)),
    ("capital_share", (0.3, 1), (0.6, -1)),
    ("shout_share", (0.02, 1), (0.2, -1)),
    ("sentence_share", (0.005, -1), (0.02, 1)),
    ("distinct_share", (0.15, -1), (0.4, 1)),
]


def measures(text: str | None) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """Measures of a whole text, and its hashed features: numbers and weights of unit length.

    Features are shapes of words, marks and measures in steps rather than words, so what the
    scorer learns doesn't depend on the subject.
    """
    raw = (text or "").encode("utf-8")
    words = raw.split()
    n = max(1, len(words))
    plain = Counter(words)
    low = Counter({w.lower().strip(_MARKS): 0 for w in plain})
    for w, k in plain.items():
        low[w.lower().strip(_MARKS)] += k
    found = {
        "stop_share": sum(k for w, k in low.items() if w in _STOPS) / n,
        "symbol_share": (len(raw) - len(raw.translate(None, _SYMBOLS))) / n,
        "repeat_share": sum(a == b for a, b in pairwise(words)) / n,
        "capital_share": sum(k for w, k in plain.items() if w[:1].isupper()) / n,
        "shout_share": sum(k for w, k in plain.items() if w.endswith(b"!!") or (len(w) > 3 and w.isupper())) / n,
        "sentence_share": sum(k for w, k in plain.items() if w[-1:] in (b".", b"!", b"?")) / n,
        "distinct_share": len(low) / n if n >= 50 else 1.0,
        "words": float(len(words)),
    }
    features: Counter = Counter()
    for w, k in plain.items():
        features[b"first " + w[:1] if not w[:1].isalnum() else b"alpha"] += k
        features[b"last " + w[-1:] if not w[-1:].isalnum() else b"plain"] += k
        features[b"size %d" % min(len(w), 20)] += k
        if w in _STOPS:
            features[b"stop"] += k
    for name, value in found.items():
        if len(words) < SHORT and name != "symbol_share":
            continue
        features[f"{name} {round(8 * math.log1p(10 * value))}".encode()] += n
    numbers = np.array([xxhash.xxh3_64_intdigest(f) % DIMENSION for f in features], np.int64)
    weights = np.sqrt(np.array(list(features.values()), float) / n)
    return found, numbers, weights / max(1e-9, float(np.sqrt((weights**2).sum())))


def votes(found: dict[str, float]) -> list[int]:
    out = []
    for name, below, above in HEURISTICS:
        value = found[name]
        if found["words"] < SHORT and name != "symbol_share":
            out.append(0)
            continue
        vote = below[1] if below and value < below[0] else above[1] if above and value > above[0] else 0
        out.append(vote)
    return out


def estimated(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS):
    """(share of good texts, vote rates, posterior of patterns).

    Rates [truth, heuristic, vote] are how often a heuristic, where it votes, votes bad (0) or
    good (2) on bad and on good texts: its accuracies. Not voting (1) is no evidence. Heuristics err independently given the
    truth. The first guess, which settles what good means, calls a text bad where more than one
    in five of its votes say so; a smoothing count keeps rates above 0.
    """
    names = range(len(HEURISTICS))
    table = np.array(list(patterns), int).reshape(-1, len(names)) + 1
    times = np.array(list(patterns.values()), float)
    bad_votes, all_votes = (table == 0).sum(axis=1), (table != 1).sum(axis=1)
    good = np.where(5 * bad_votes > all_votes, 0.1, np.where(bad_votes > 0, 0.4, 0.95))

    def maximised(good: np.ndarray) -> tuple[float, np.ndarray]:
        rates = np.full((2, len(names), 3), 1.0)
        for h in names:
            rates[1, h] += np.bincount(table[:, h], times * good, 3)
            rates[0, h] += np.bincount(table[:, h], times * (1 - good), 3)
        prior = (times @ good + 1) / (times.sum() + 2)
        cast = rates[:, :, [0, 2]].sum(axis=2, keepdims=True)
        return float(prior), np.where([False, True, False], 1.0, rates / cast)  # no vote tells nothing

    def posterior(rows: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
        logs = np.log(rates)
        odds = math.log(prior / (1 - prior)) + sum(logs[1, h, rows[:, h]] - logs[0, h, rows[:, h]] for h in names)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    prior, rates = maximised(good)
    for _ in range(rounds if len(table) else 0):
        prior, rates = maximised(posterior(table, prior, rates))
    return prior, rates, lambda rows: posterior(np.array(rows, int) + 1, prior, rates)


def fitted(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, steps: int = STEPS):
    """Weights and bias of a logistic scorer for soft labels, by full gradients with momentum."""
    weights, bias, n = np.zeros(DIMENSION), 0.0, max(1, len(labels))
    speed, lift = np.zeros(DIMENSION), 0.0
    for _ in range(steps):
        raw = np.bincount(rows, values * weights[columns], len(labels)) + bias
        error = 1 / (1 + np.exp(-raw)) - labels
        slope = np.bincount(columns, values * error[rows], DIMENSION) / n + 1e-5 * weights
        speed, lift = 0.9 * speed - 8 * slope, 0.9 * lift - 2 * float(error.mean() if len(error) else 0)
        weights, bias = weights + speed, bias + lift
    return weights, bias


_MADE = "doc_id long, votes array<int>, numbers array<int>, weights array<float>"


def classified(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row (doc_id, votes, label, score, kept) for each row of ``documents``.

    ``label`` is the posterior probability that a text of these votes is good, ``score`` the
    linear scorer's, kept where the score is ``threshold`` or more. A null or empty text has no
    words and is judged like any other. Null doc_ids and repeated rows stay.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def measure(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                docs, texts = (c.to_pylist() for c in batch.slice(at, 250).columns)
                made = [measures(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array([votes(m[0]) for m in made], pa.list_(pa.int32())),
                        pa.array([m[1].astype(np.int32) for m in made], pa.list_(pa.int32())),
                        pa.array([m[2].astype(np.float32) for m in made], pa.list_(pa.float32())),
                    ],
                    ["doc_id", "votes", "numbers", "weights"],
                )

    made = written(rows.mapInArrow(measure, _MADE), "votes")
    # 3 ** len(HEURISTICS) patterns at most.
    patterns = {tuple(r.votes): r.n for r in made.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    _, _, posterior = estimated(patterns)
    label = {p: float(posterior([p])[0]) for p in patterns}
    sample = (
        made.orderBy(F.xxhash64("doc_id", "votes"), "doc_id").limit(TRAINING_ROWS)
        .select("votes", "numbers", "weights").toArrow()
    )
    columns = [np.array(x, np.int64) for x in sample.column("numbers").to_pylist()]
    values = [np.array(x) for x in sample.column("weights").to_pylist()]
    places = np.repeat(np.arange(len(columns)), [len(c) for c in columns]).astype(np.int64)
    labels = np.array([label[tuple(v)] for v in sample.column("votes").to_pylist()])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    weights, bias = fitted(places, join(columns, np.int64), join(values, float), labels)
    shared = documents.sparkSession.sparkContext.broadcast((weights, bias, label))

    def score(batches):
        weights, bias, label = shared.value
        for batch in batches:
            given, numbers, values = (batch.column(i).to_pylist() for i in (1, 2, 3))
            raw = [bias + float(np.dot(weights[n], v)) for n, v in zip(numbers, values, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([label[tuple(v)] for v in given], pa.float64()),
                    pa.array([1 / (1 + math.exp(-min(max(x, -50), 50))) for x in raw], pa.float64()),
                ],
                ["doc_id", "votes", "label", "score"],
            )

    got = made.mapInArrow(score, "doc_id long, votes array<int>, label double, score double")
    return got.withColumn("kept", F.col("score") >= threshold)
