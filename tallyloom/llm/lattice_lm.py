"""Text likelihood over all segmentations into subwords.

A vocabulary of pieces stays as it is; only the pieces' probabilities are learned. They start
from the vocabulary's own scores (which are ranks) and follow from expected counts over all
segmentations of all training words, as expectation-maximisation gives them. A text's
probability is the sum over all its segmentations: words are scored by a forward recursion in
log space, each begun by the word mark, and one end token closes the text. A word's lattice also
has one arc over the whole word, with its share of the training tokens; arcs of pieces hold the
mass that training words seen once have (Good-Turing), so words never seen are scored too.
"""

import functools
import math
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import written

MARK = "▁"
ROUNDS = 1
#: Of the corpus's words the most frequent ones, whose counts every task gets; others are joined.
HEAD_WORDS = 50_000
#: Words that are ordered to find these: no more than so many times as many can hold their share
#: of all tokens or more.
HEAD_ROOM = 16
#: Words of a task's partial counts and memos.
HELD = 300_000
#: Weight of the vocabulary's order among the learned counts.
PRIOR = 0.1
#: Characters of a word up to which probabilities are first summed as they are.
DIRECT = 24
#: A plain sum under this is made again in log space.
LEAST = 1e-280


def word_list(text: str | None) -> list[bytes]:
    """Words parted by space, tab, LF, VT, FF, CR, with A-Z lowered."""
    return (text or "").encode("utf-8").lower().split()


class Lattice:
    """Pieces with probabilities, as a trie over characters; bytes stand in for other characters.

    A node is [children, probability or 0, number of the piece]. Words of up to ``DIRECT``
    characters are summed as they are; longer ones, and sums under ``LEAST``, in log space.
    """

    def __init__(self, pieces: Sequence[str], logs: Sequence[float]):
        self.root: list = [{}, 0.0, -1]
        self.logs = logs
        for number, piece in enumerate(pieces):
            node = self.root
            for char in piece:
                node = node[0].setdefault(char, [{}, 0.0, -1])
            node[1:] = [math.exp(logs[number]), number]
        number = {p: i for i, p in enumerate(pieces)}
        self.bytes = [number[f"<0x{b:02X}>"] for b in range(256)]

    def spelled(self, char: str) -> float:
        """The log probability of a character as bytes."""
        return sum(self.logs[self.bytes[b]] for b in char.encode())

    def arcs(self, text: str) -> list[list[tuple[int, int, float]]]:
        """For each place, the pieces that begin there: (end, number, probability). A character
        that is no piece is its bytes, of number -1."""
        found, n = [], len(text)
        for i in range(n):
            here, node, j = [], self.root, i
            while j < n:
                node = node[0].get(text[j])
                if node is None:
                    break
                j += 1
                if node[1]:
                    here.append((j, node[2], node[1]))
            if not here or here[0][0] > i + 1:
                here.append((i + 1, -1, math.exp(self.spelled(text[i]))))
            found.append(here)
        return found

    def score(self, word: bytes) -> float:
        """log10 of the probability of a word, over all its segmentations."""
        text = MARK + word.decode("utf-8")
        n = len(text)
        if n > DIRECT:
            return self.forward(self.arcs(text))[-1] / math.log(10)
        sums = [1.0] + [0.0] * n
        for i in range(n):
            base, node, j, first = sums[i], self.root, i, 0.0
            while j < n:
                node = node[0].get(text[j])
                if node is None:
                    break
                j += 1
                if node[1]:
                    sums[j] += base * node[1]
                    if j == i + 1:
                        first = node[1]
            if not first:
                sums[i + 1] += base * math.exp(self.spelled(text[i]))
        return math.log10(sums[n]) if sums[n] >= LEAST else self.forward(self.arcs(text))[-1] / math.log(10)

    def forward(self, arcs) -> list[float]:
        """The log of the summed probability of all segmentations up to each place."""
        sums = [0.0] + [-math.inf] * len(arcs)
        for i, here in enumerate(arcs):
            for j, _, p in here:
                x, y = sums[i] + math.log(p), sums[j]
                sums[j] = max(x, y) + math.log1p(math.exp(-abs(x - y)))
        return sums

    def expected(self, word: bytes, times: float, counts: list[float]) -> None:
        """Adds the expected count of each piece in ``times`` occurrences of the word."""
        text = MARK + word.decode("utf-8")
        arcs = self.arcs(text)
        n = len(arcs)
        if n > DIRECT:
            self._expected(text, arcs, times, counts)
            return
        ahead = [1.0] + [0.0] * n
        for i, here in enumerate(arcs):
            base = ahead[i]
            for j, _, p in here:
                ahead[j] += base * p
        if ahead[n] < LEAST:
            self._expected(text, arcs, times, counts)
            return
        back = [0.0] * n + [times / ahead[n]]
        for i in range(n - 1, -1, -1):
            base, total = ahead[i], 0.0
            for j, number, p in arcs[i]:
                share = p * back[j]
                total += share
                if number >= 0:
                    counts[number] += base * share
                else:
                    for b in text[i].encode():
                        counts[self.bytes[b]] += base * share
            back[i] = total

    def _expected(self, text, arcs, times, counts) -> None:
        ahead = self.forward(arcs)
        back = [-math.inf] * len(arcs) + [0.0]
        for i in range(len(arcs) - 1, -1, -1):
            logs = [math.log(p) + back[j] for j, _, p in arcs[i]]
            top = max(logs)
            back[i] = top + math.log(sum(math.exp(x - top) for x in logs))
            for (_, number, _), x in zip(arcs[i], logs, strict=True):
                share = times * math.exp(ahead[i] + x - ahead[-1])
                for k in [number] if number >= 0 else [self.bytes[b] for b in text[i].encode()]:
                    counts[k] += share


@functools.lru_cache(1)
def _lattice(pieces: tuple, logs: tuple) -> Lattice:
    return Lattice(pieces, logs)


def vocabulary(path: str) -> list[str]:
    """Pieces by falling score, as the file gives them; control pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    ids.sort(key=lambda i: (model.is_byte(i), -model.get_score(i), i))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [p if model.is_byte(i) else p.translate(lower) for i in ids for p in [model.id_to_piece(i)]]


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, learned, seen): each word's count in training texts and in all texts."""

    def run(batches):
        learned, seen = Counter(), Counter()

        def out():
            words = list(seen)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    pa.array([learned[w] for w in words], pa.int64()),
                    pa.array([seen[w] for w in words], pa.int64()),
                ],
                ["word", "learned", "seen"],
            )

        for batch in batches:
            for held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_list(text)
                seen.update(words)
                if not held:
                    learned.update(words)
                if len(seen) > HELD:
                    yield out()
                    learned.clear()
                    seen.clear()
        yield out()

    partial = documents.select("held_out", "text").mapInArrow(run, "word binary, learned long, seen long")
    return partial.groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("seen").alias("seen"))


def learned_pieces(words: DataFrame, ending: float, pieces: list[str], rounds: int = ROUNDS):
    """The log of each piece's probability, from words (word, learned), and of the end's, which
    is ``ending``. Each training word counts once: pieces are there for words never seen, and
    those are like the list of words rather than like the running text."""
    order = {p: 1 / (i + 10) for i, p in reversed(list(enumerate(pieces)))}
    weights = dict(order)
    spark = words.sparkSession
    for _ in range(rounds):
        total = sum(weights.values())
        shared = spark.sparkContext.broadcast(
            (tuple(weights), tuple(math.log(w / total) for w in weights.values()))
        )

        def run(batches, shared=shared):
            lattice = _lattice(*shared.value)
            counts = [0.0] * len(shared.value[0])
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    lattice.expected(word, 1.0, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.value[0], pa.string()), pa.array(counts, pa.float64())], ["piece", "n"]
            )

        found = (
            words.where("learned > 0").select("word").mapInArrow(run, "piece string, n double")
            .groupBy("piece").agg(F.sum("n").alias("n"))
        )
        counts = {r.piece: r.n for r in found.collect()}  # the vocabulary's pieces at most
        prior = PRIOR * max(1.0, sum(counts.values())) / sum(order.values()) / len(order)
        weights = {p: counts.get(p, 0.0) + prior * w for p, w in order.items()}
    total = sum(weights.values())
    return {p: math.log(w / total * (1 - ending)) for p, w in weights.items()}, math.log(ending)


def scored_words(words: DataFrame, logs: dict[str, float]) -> DataFrame:
    """``words`` (word, learned, seen) with the log10 of each word's lattice: a distinct word is scored once."""
    shared = words.sparkSession.sparkContext.broadcast((tuple(logs), tuple(logs.values())))

    def run(batches):
        lattice = _lattice(*shared.value)
        for batch in batches:
            found = pa.array([lattice.score(w) for w in batch.column(0).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "log"])

    return words.select("word", "learned", "seen").mapInArrow(run, "word binary, learned long, seen long, log double")


def scored(documents: DataFrame, path: str, every: int = 7, held_out: int = 2) -> DataFrame:
    """One row for each row of ``documents``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text.

    Learns from the rows whose crc32(doc_id as text) modulo ``every`` isn't ``held_out`` (rows
    with a null doc_id are learned from). Words are lowered A-Z, an end token closes each text
    and counts as a token; a null or empty text is the end alone. Repeated rows count as often as
    they occur. An empty table gives an empty one; texts of any length are whole; other columns
    are ignored, whatever their names.
    """
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % every
    held = F.col("doc_id").isNotNull() & (remainder == held_out)
    rows = documents.select("doc_id", held.alias("held_out"), "text")
    words = written(word_counts(rows), "words")
    spark = documents.sparkSession
    texts = rows.where("NOT held_out").count()
    sums = words.agg(
        F.sum("learned").alias("n"),
        F.count_if(F.col("learned") > 0).alias("v"),
        F.count_if(F.col("learned") == 1).alias("once"),
        F.sum("seen").alias("seen"),
    ).first()
    n = int(sums.n or 0) + texts
    v = int(sums.v or 0) + (texts > 0)
    logs, end = learned_pieces(words, (texts + 1) / (n + 2), vocabulary(path))
    floor = math.log10(n + v + 1)
    spelled = (int(sums.once) + 1) / (n + 2)  # what pieces hold; the rest is for whole words
    whole = (1 - spelled) / max(n, 1)
    end10, end_base = math.log10(whole * texts + spelled * math.exp(end)), math.log10(texts + 1) - floor
    known_end = int(texts > 0)

    words = written(scored_words(words, logs), "scored-words")
    frequent = words.where(F.col("seen") >= (sums.seen or 0) / (HEAD_WORDS * HEAD_ROOM))
    head = frequent.orderBy(F.desc("seen"), "word").limit(HEAD_WORDS).select("word", "learned", "log").toArrow()

    def terms(count: int, log: float) -> tuple[int, float, float]:
        """Whether a word is known, and its share of the base and of the score."""
        score = math.log10(whole * count + spelled * 10**log) if count else log + math.log10(spelled)
        return int(count > 0), math.log10(count + 1) - floor, score

    shared = spark.sparkContext.broadcast(
        {word: terms(count, log) for word, count, log in zip(*(c.to_pylist() for c in head.columns), strict=True)}
    )

    def run(batches):
        head = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                docs, flags, texts = (c.to_pylist() for c in batch.slice(at, 200).columns)
                made = []
                for text in texts:
                    tokens, known, base, score, tail = 1, known_end, end_base, end10, []
                    for word, times in Counter(word_list(text)).items():
                        tokens += times
                        found = head.get(word)
                        if found is None:
                            tail.append({"word": word, "times": times})
                        else:
                            known += times * found[0]
                            base += times * found[1]
                            score += times * found[2]
                    made.append((tokens, known, base, score, tail))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), _TAIL)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(flags, pa.bool_())]
                    + [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "score", "tail"],
                )

    parts = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
        "tail array<struct<word: binary, times: long>>",
    )
    # The written rows' numbers stay the same however often they are read.
    parts = written(parts.withColumn("row", F.monotonically_increasing_id()), "scored")
    mixed = F.when(
        F.col("learned") > 0, F.log10(F.col("learned") * F.lit(whole) + F.lit(spelled) * F.pow(F.lit(10.0), "log"))
    ).otherwise(F.col("log") + F.lit(math.log10(spelled)))
    rare = (
        parts.select("row", F.explode("tail").alias("t")).select("row", "t.*")
        .join(words.select("word", "learned", "log"), "word").groupBy("row")
        .agg(
            F.sum(F.when(F.col("learned") > 0, F.col("times")).otherwise(0)).alias("more"),
            F.sum(F.col("times") * (F.log10(F.col("learned") + 1) - F.lit(floor))).alias("rest"),
            F.sum(F.col("times") * mixed).alias("marginal"),
        )
    )
    return parts.drop("tail").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("marginal", F.lit(0.0))).alias("score"),
    )


_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
