"""Toxicity by class-conditional Kneser-Ney models.

Two models of word pairs, one of toxic and one of ordinary texts, give a text two
log-likelihoods; their difference a token tells the classes apart. Each model backs off from
pairs to the class's own continuation counts (in how many distinct pairs of the class a word
comes second) and from these to continuation counts that both classes share. Words and pairs
whose counts don't tell the classes apart have the shared estimate in both, so that an
expression which one class has hardly seen isn't taken for evidence.

The classes are counted by Spark over labelled texts. A model keeps at most ``WORDS`` words,
the most frequent ones, and the ``PAIRS`` pairs whose share of toxic uses is least like that
of their second word; all else backs off. So what is broadcast has a fixed bound.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tallyloom.llm.rows import with_columns
from tallyloom.llm.terms import terms
from tallyloom.session import written

#: Labelled texts that the models are fitted to, at most; more are thinned by a hash of doc_id.
LABELLED = 50_000
#: Words and pairs of the models, at most.
WORDS = 131_072
PAIRS = 262_144
#: Evidence a word or pair must have: the chi-square value that chance passes once in a thousand.
EVIDENCE = 10.8
#: How many times the expected toxic uses a telling word or pair has, or how few of them.
FACTOR = 3.0
#: One labelled text of so many is kept from the counts, to fit the score's scale.
SCALE_SHARE = 4
#: Predicted as toxic from this score on.
TOXIC_FROM = 0.3

#: Word numbers: 0 for all words outside the model, 1 for a text's edge.
_OTHER, _EDGE = 0, 1
_FIRST = 2

_PAIR = StructType(
    [StructField("pair", LongType()), StructField("toxic", LongType()), StructField("plain", LongType())]
)
_RATIO = StructType([StructField("ratio", DoubleType()), StructField("n_tokens", LongType())])


def hashes(text: str | None) -> np.ndarray:
    found = terms((text or "").lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)


def numbered(found: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Word numbers of a text, between two edges; ``words`` holds the model's sorted hashes."""
    ids = np.full(len(found) + 2, _EDGE, np.int64)
    places = np.searchsorted(words, found)
    places[places == len(words)] = 0
    known = words[places] == found if len(words) else np.zeros(len(found), bool)
    ids[1:-1] = np.where(known, places + _FIRST, _OTHER)
    return ids


class Counter:
    """Sums two counts by a 64-bit key, in blocks of bounded size."""

    def __init__(self, limit: int = 2_000_000):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, keys: np.ndarray, toxic: bool):
        self.parts.append((keys, np.full(len(keys), toxic)))
        self.held += len(keys)
        return self.full() if self.held >= self.limit else None

    def full(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        keys, toxic = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        found, places = np.unique(keys, return_inverse=True)
        all_, bad = np.bincount(places), np.bincount(places, toxic).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(bad), pa.array(all_ - bad)], schema=to_arrow_schema(_PAIR)
        )


def _counted(texts: DataFrame, keys) -> DataFrame:
    """(pair, toxic, plain): in how many texts of each class a key occurs. Repeats within a
    text don't count, so that one text full of a word is no evidence."""

    def run(batches):
        counter, make = Counter(), keys()
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = counter.add(np.unique(make(text)), toxic)
                if block:
                    yield block
        block = counter.full()
        if block:
            yield block

    found = texts.select("text", "toxic").mapInArrow(run, _PAIR)
    return found.groupBy("pair").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def _cut(values: DataFrame, most: int, least: float) -> float:
    """A bound of the column ``v`` that at most ``most`` rows reach, ``least`` or more."""
    steps = values.where(F.col("v") >= least).select(F.floor(F.log2("v") * 64).alias("s"))
    cut = math.log2(least) * 64
    for step, _ in _falling(steps.groupBy("s").count().collect(), most):
        cut = step
        break
    return max(least, 2 ** (cut / 64))


def _falling(rows, most):
    """The lowest step at which the rows from the top down still fit."""
    total, last = 0, None
    for step, n in sorted(((r[0], r[1]) for r in rows), reverse=True):
        if total + n > most:
            yield (step + 1 if last is None else last), total
            return
        total, last = total + n, step


class Model:
    """What scoring needs: hashes of words, logs of the class ratio of words and backoff weights,
    and of the kept pairs."""

    def __init__(self, words, ratio, backoff, pairs, pair_ratio):
        self.words, self.ratio, self.backoff = words, ratio, backoff
        self.pairs, self.pair_ratio = pairs, pair_ratio

    def mean_ratio(self, text: str | None) -> tuple[float, int]:
        """Log-likelihood ratio a token, toxic to ordinary, and the number of tokens."""
        ids = numbered(hashes(text), self.words)
        ahead, word = ids[:-1], ids[1:]
        found = self.backoff[ahead] + self.ratio[word]
        if len(self.pairs):
            codes = ahead * (len(self.words) + _FIRST) + word
            places = np.searchsorted(self.pairs, codes)
            places[places == len(self.pairs)] = 0
            kept = self.pairs[places] == codes
            found[kept] = self.pair_ratio[places[kept]]
        return float(found.sum() / len(found)), len(found) - 1


def discount(ones: int, twos: int) -> float:
    """Kneser-Ney's absolute discount from the counts of counts."""
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def evidence(toxic, uses, share):
    """How far toxic uses lie from their expected share, as a chi-square value; 0 where they
    are neither ``FACTOR`` times as many nor as few."""
    expected = uses * share
    ratio = (toxic + 0.5) / (expected + 0.5)
    far = (ratio >= FACTOR) | (ratio <= 1 / FACTOR)
    return np.where(far, (toxic - expected) ** 2 / (expected * (1 - share) + 0.5), 0.0)


def class_models(words, after, uses, heads, pairs, discounts) -> Model:
    """Both classes' models from counts.

    ``after``: for each word the number of distinct pairs it ends: toxic, ordinary, either.
    ``heads``: for each word how often it begins a pair, by class. ``pairs``: code, toxic and
    ordinary uses of the kept pairs, each counted once a text. ``discounts``: by class, of pairs and of continuations.
    """
    size = len(words) + _FIRST
    shared = (after[2] + 1) / (after[2].sum() + size)
    codes, *counts = pairs
    ahead, word = codes // size, codes % size
    either = after[0] + after[1]
    telling = evidence(after[0], either, after[0].sum() / max(either.sum(), 1)) >= EVIDENCE
    logs, weights, known = [], [], []
    for c in (0, 1):
        pair_discount, word_discount = discounts[c]
        total = max(after[c].sum(), 1)
        spared = word_discount * np.minimum(after[c], 1).sum() / total if after[c].any() else 1.0
        own = np.maximum(after[c] - word_discount, 0) / total + spared * shared
        rest = (1 - own[telling].sum()) / max(1 - shared[telling].sum(), 1e-9)
        single = np.where(telling, own, rest * shared)
        seen = counts[c] > 0
        share = np.where(seen, (counts[c] - pair_discount) / np.maximum(heads[c][ahead], 1), 0.0)
        left = 1 - np.bincount(ahead, share, size)
        rest = 1 - np.bincount(ahead, np.where(seen, single[word], 0.0), size)
        backoff = np.maximum(left, 1e-9) / np.maximum(rest, 1e-9)
        logs.append(np.log(single))
        weights.append(np.log(backoff))
        known.append(np.where(seen, np.log(np.maximum(share, 1e-300)), np.log(backoff[ahead] * single[word])))
    return Model(words, logs[0] - logs[1], weights[0] - weights[1], codes, known[0] - known[1])


def fitted(texts: DataFrame, most_words: int = WORDS, most_pairs: int = PAIRS) -> Model:
    """The models of ``texts`` (text, toxic boolean), which is read twice."""
    counts = written(_counted(texts, lambda: hashes), "toxicity-words")
    uses = counts.withColumn("v", (F.col("toxic") + F.col("plain")).cast("double"))
    kept = uses.where(F.col("v") >= _cut(uses, most_words, 2.0)).select("pair").toArrow()
    words = np.sort(kept.column(0).to_numpy())
    size = len(words) + _FIRST
    known = texts.sparkSession.sparkContext.broadcast(words)

    def codes():
        mine = known.value

        def make(text):
            ids = numbered(hashes(text), mine)
            return ids[:-1] * size + ids[1:]

        return make

    pairs = written(_counted(texts, codes), "toxicity-pairs")
    some = [F.col(c) > 0 for c in ("toxic", "plain")]
    second, first = F.col("pair") % size, F.expr(f"pair DIV {size}")
    sums = [F.sum(c).alias(f"{c}_uses") for c in ("toxic", "plain")]
    ends = pairs.groupBy(second.alias("w")).agg(
        *[F.count_if(s).alias(f"pairs{i}") for i, s in enumerate(some)], F.count("*").alias("pairs2"), *sums
    )
    starts = pairs.groupBy(first.alias("w")).agg(*sums)
    after, uses, heads = np.zeros((3, size)), np.zeros((2, size)), np.zeros((2, size))
    for frame, tables in ((ends, [*after, *uses]), (starts, [*heads])):
        found = frame.toArrow()
        places = found.column(0).to_numpy()
        for table, column in zip(tables, found.columns[1:], strict=True):
            table[places] = column.to_numpy()
    few = pairs.agg(*[F.count_if(F.col(c) == n) for c in ("toxic", "plain") for n in (1, 2)]).first()
    discounts = [
        (discount(*few[2 * c : 2 * c + 2]), discount(int((after[c] == 1).sum()), int((after[c] == 2).sum())))
        for c in (0, 1)
    ]
    return class_models(words, after, uses, heads, _telling(pairs, uses, size, most_pairs), discounts)


def _telling(pairs: DataFrame, uses: np.ndarray, size: int, most: int) -> list[np.ndarray]:
    """The pairs whose share of toxic uses differs most from that of their second word."""
    share = uses[0] / np.maximum(uses.sum(axis=0), 1)
    known = pairs.sparkSession.sparkContext.broadcast(share)
    out = StructType([*_PAIR.fields, StructField("v", DoubleType())])
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            pair, toxic, plain = (c.to_numpy() for c in batch.columns)
            n = toxic + plain
            q = known.value[pair % size]
            value = evidence(toxic, n, q)
            strong = value >= EVIDENCE
            yield pa.RecordBatch.from_arrays(
                [*(c.filter(pa.array(strong)) for c in batch.columns), pa.array(value[strong])], schema=arrow
            )

    strong = pairs.select("pair", "toxic", "plain").mapInArrow(run, out)
    found = strong.where(F.col("v") >= _cut(strong, most, EVIDENCE)).toArrow()
    order = np.argsort(found.column(0).to_numpy())
    return [found.column(i).to_numpy()[order] for i in range(3)]


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of columns ``x`` and a constant, with a slight pull towards 0."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-3 * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return w


def _features(ratio, tokens):
    """The ratio a token, and the same weighted by how sure a text's length makes it."""
    return np.column_stack([ratio, ratio * np.sqrt(np.minimum(tokens, 400))])


def held_out() -> F.Column:
    """Whether a row's label is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, toxic: at most about ``most`` labelled rows that may be learned from.

    Labels that are null, or of rows without a doc_id, are none; a doc_id that is labelled
    both ways is toxic.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    usable = usable.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    share = min(1.0, most / max(usable.count(), 1))
    return usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def scored(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted, ratio, n_tokens for each row of ``docs``.

    ``labels`` has doc_id and toxic. Only texts count: a null text is empty, and an empty one
    has the score of its bare edge. Texts are scored whole; repeated rows stay, other columns
    are left out. Without labels of both classes all scores are the share of toxic labels, or
    0; an empty table gives an empty one. ``most`` bounds the labelled texts that are fitted.
    """
    docs = docs.select("doc_id", "text")
    # At most ``most`` ids, so every executor can hold them.
    chosen = F.broadcast(training_labels(labels.select("doc_id", "toxic"), most))
    scale = F.pmod(F.xxhash64("doc_id", F.lit("scale")), F.lit(SCALE_SHARE)) == 0
    training = written(docs.join(chosen, "doc_id").select("text", "toxic", scale.alias("scale")), "toxicity-texts")
    kinds = {(r[0], r[1]): r[2] for r in training.groupBy("scale", "toxic").count().collect()}
    if len(kinds) < 4:
        toxic, total = sum(n for (_, t), n in kinds.items() if t), max(sum(kinds.values()), 1)
        scored_rows = docs.select(
            "doc_id", F.lit(0.0).alias("ratio"), F.lit(0).cast("long").alias("n_tokens"), F.lit(toxic / total).alias("score")
        )
    else:
        known = docs.sparkSession.sparkContext.broadcast(fitted(training.where("NOT scale")))

        def ratios():
            return lambda texts: map(known.value.mean_ratio, texts)

        seen = with_columns(training.where("scale"), "text", _RATIO, ratios, keep=["toxic"]).toArrow()
        ratio, tokens = (seen.column(c).to_numpy() for c in ("ratio", "n_tokens"))
        order = np.lexsort((tokens, ratio))  # sums don't depend on the order of rows
        labelled = seen.column("toxic").to_numpy(zero_copy_only=False).astype(float)
        a, b, c = logistic(_features(ratio, tokens)[order], labelled[order]).tolist()
        slope = F.lit(a) + F.lit(b) * F.sqrt(F.least("n_tokens", F.lit(400)))
        scored_rows = with_columns(docs, "text", _RATIO, ratios, keep=["doc_id"]).withColumn(
            "score", 1 / (1 + F.exp(-(slope * F.col("ratio") + c)))
        )
    return scored_rows.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
        "ratio",
        "n_tokens",
    )
