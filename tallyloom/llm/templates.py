"""Benchmark decontamination through templates with typed slots.

Words become a template: numbers, names and units of measure turn into typed placeholders, runs
of one kind into a single one. The hashes of all windows of ``WINDOW`` template tokens of
documents and benchmark items are joined. Windows at the same distance between document and item
form one reading of the item, and so do windows at nearby distances, as inserted words make them;
within a reading each slot value of the item must stand for one value of the document, or the
windows that disagree don't count. A document is contaminated by an item if enough of the item's
windows are found in one reading. The same is done without regard to case, with names as words.
Items without a window contaminate the documents whose whole template is theirs.
"""

import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shingles import windows
from tallyloom.session import written

#: Template tokens of a window; literal words that a window has at least.
WINDOW, LITERALS = 5, 3
#: Share of an item's windows that contaminates.
SHARE = 0.5
#: Distances that differ by no more than this, or a quarter of the item's windows, are nearby.
NEAR = 16
#: Bits of the filter that spares windows of documents the join; its size is fixed, and windows
#: that it lets through in error are lost in the join.
FILTER_BITS = 1 << 23

#: Units of measure and numbers in words.
UNITS = """mm cm m km in ft yd mi mg g kg t oz lb ml l s min h ms hz khz mhz ghz w kw v a k c f
second seconds minute minutes hour hours day days week weeks month months year years
meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches
gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres
dollar dollars euro euros cent cents percent degree degrees""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety
hundred thousand million""".split()

_MARKS = ".,;:!?\"'()[]{}#*$%&|<>«»“”„…-"
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
_WITH_UNIT = re.compile(rf"([+-]?\d[\d.,]*)({'|'.join(sorted(UNITS, key=len, reverse=True))})", re.IGNORECASE)
_SPLIT_UNIT = re.compile(r"(\d)([A-Za-z])")
_ENDS = (".", "!", "?", ":", "|", "•")

_LITERAL, _NUM, _UNIT, _NAME = range(4)
_SLOTS = np.array([0, *(xxhash.xxh3_64_intdigest(f"slot {k}") for k in (_NUM, _UNIT, _NAME))], np.uint64)

_HITS = "id long, place int, hash long, kinds array<byte>, values array<long>, way byte"
#: Ways to read a text, which set their hashes apart: names as slots, names as words, as a whole.
_SLOTTED, _CASELESS, _WHOLE = range(3)
_APART = [np.uint64(xxhash.xxh3_64_intdigest(f"way {k}")) for k in range(3)]


#: Words a Python worker knows at a time; many are met once, and those that all go are looked up again.
KNOWN = 300_000


#: Kinds of the words that are fixed.
_FIXED = dict.fromkeys(UNITS, _UNIT) | dict.fromkeys(NUMBER_WORDS, _NUM)
#: What is known of a word but its hash: its kind plus one, and a bit each for the rest.
_KIND, _CAPITAL, _END, _GLUED = 7, 8, 16, 32


class _Words(dict):
    """Numbers of words met, and by number: hash of the plain word; its kind but for names, whether
    it has a capital first, ends a sentence, or is a number glued to its unit. Forgotten when there
    are too many."""

    def __init__(self):
        # Setting one element costs less than in an array of numpy; numpy reads the same memory.
        self._values, self._marks = array("Q", bytes(8 * (KNOWN + 1))), bytearray(KNOWN + 1)
        self.values, self.marks = np.frombuffer(self._values, np.uint64), np.frombuffer(self._marks, np.uint8)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        if word.isalpha():
            low = word.lower()
            marks = _FIXED.get(low, _LITERAL) + 1
            if word[0].isupper():
                marks |= _CAPITAL
        else:
            plain = word.strip(_MARKS)
            low = plain.lower()
            if plain.isalpha():  # no number in it
                marks = _FIXED.get(low, _LITERAL) + 1
            else:
                marks = (_NUM if _NUMBER.fullmatch(plain) else _FIXED.get(low, _LITERAL)) + 1 if plain else 0
                if plain and _WITH_UNIT.search(word):
                    marks |= _GLUED
            if plain[:1].isupper():
                marks |= _CAPITAL
            if not plain or word.endswith(_ENDS):
                marks |= _END
        self._values[n] = xxhash.xxh3_64_intdigest(low)
        self._marks[n] = marks
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_MET = _Words()


def _looked_up(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a text's lines begin among its words; the hashes and marks of the words."""
    lines = [line.split() for line in text.split("\n")]
    starts = np.cumsum([0, *map(len, lines)])
    words = list(chain.from_iterable(lines))
    values, marks = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for at in range(0, len(words), KNOWN // 4):  # a very long text in parts
        n = _MET.numbers(words[at : at + KNOWN // 4])
        values.append(_MET.values[n])
        marks.append(_MET.marks[n])
    return starts, np.concatenate(values), np.concatenate(marks)


def read(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a text's words, their kinds, and which of them are names.

    A unit counts as one behind a number only. A name is a word with a capital that doesn't
    begin a line or a sentence. Marks at words' edges and case are dropped.
    """
    starts, values, marks = _looked_up(text or "")
    if (marks & _GLUED).any():
        starts, values, marks = _looked_up(_SPLIT_UNIT.sub(r"\1 \2", text))
    if not len(values):
        none = np.zeros(0, np.uint64)
        return none, none.astype(np.int8), none.astype(bool)
    kinds = (marks & _KIND).astype(np.int8) - np.int8(1)
    capitals, ends = (marks & _CAPITAL).astype(bool), (marks & _END).astype(bool)
    begins = np.r_[True, ends[:-1]]
    begins[starts[starts < len(begins)]] = True
    real = kinds >= 0
    values, kinds, capitals, begins = values[real], kinds[real], capitals[real], begins[real]
    behind = np.r_[False, kinds[:-1] == _NUM] if len(kinds) else np.zeros(0, bool)
    kinds = np.where((kinds == _UNIT) & ~behind, _LITERAL, kinds)
    return values, kinds.astype(np.int8), (kinds == _LITERAL) & capitals & ~begins


def template(
    values: np.ndarray, kinds: np.ndarray, named: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of template tokens, their kinds, and hashes of the words they stand for.

    The words ``named`` are slots; with None names are words as others. A run of one kind of
    slot is one token.
    """
    if named is not None:
        kinds = np.where(named, np.int8(_NAME), kinds)
    if len(kinds):
        first = np.flatnonzero(np.r_[True, (kinds[1:] == _LITERAL) | (kinds[1:] != kinds[:-1])])
        within = np.arange(len(kinds)) - np.repeat(first, np.diff(np.r_[first, len(kinds)]))
        values = np.add.reduceat(values * (2 * within + 1).astype(np.uint64), first)
        kinds = kinds[first]
    return np.where(kinds == _LITERAL, values, _SLOTS[kinds]), kinds, values


def _windows(made: tuple, way: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of a template's windows with enough literal words; kinds and values of
    its tokens. As a whole it is one window at place 0, by its words if they are all slots."""
    tokens, kinds, values = made
    none = np.zeros(0, np.int64)
    if way == _WHOLE and len(tokens):
        seen = tokens if (kinds == _LITERAL).any() else values
        whole = np.array([xxhash.xxh3_64_intdigest(seen.tobytes())], np.uint64)
        return np.zeros(1, np.int64), whole ^ _APART[way], kinds, values
    if len(tokens) < WINDOW:
        return none, none.astype(np.uint64), kinds, values
    literal = np.convolve(kinds == _LITERAL, np.ones(WINDOW, int), "valid")
    places = np.flatnonzero(literal >= LITERALS)
    return places, windows(tokens, WINDOW)[places] ^ _APART[way], kinds, values


def _ways(text: str, item: bool) -> list[tuple[int, tuple]]:
    """Each way with its windows: an item is compared as a whole only if it has no others."""
    values, kinds, named = read(text)
    slotted = template(values, kinds, named)
    caseless = template(values, kinds, None) if named.any() else slotted
    made = [(_SLOTTED, _windows(slotted, _SLOTTED)), (_CASELESS, _windows(caseless, _CASELESS))]
    if not item or not any(len(w[0]) for _, w in made):
        made.append((_WHOLE, _windows(slotted, _WHOLE)))
    return made


def _rows(df: DataFrame, key: str, passed=None) -> DataFrame:
    """A row for each window (of those whose hash is in the filter ``passed``)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                rows = []
                for i, text in zip(ids, texts, strict=True):
                    for way, (places, hashes, kinds, values) in _ways(text, passed is None):
                        if passed is not None and len(hashes):
                            met = passed.value[hashes % np.uint64(FILTER_BITS)]
                            places, hashes = places[met], hashes[met]
                        for p, h in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
                            rows.append((i, p, h, kinds[p : p + WINDOW], values[p : p + WINDOW].view(np.int64), way))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[k] for r in rows], t)
                        for k, t in enumerate(
                            (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int8()), pa.list_(pa.int64()), pa.int8())
                        )
                    ],
                    ["id", "place", "hash", "kinds", "values", "way"],
                )

    return df.where(f"`{key}` IS NOT NULL AND text IS NOT NULL").select(
        F.col(f"`{key}`").cast("long").alias("id"), "text"
    ).mapInArrow(run, _HITS)


def _filter(items: DataFrame):
    """The bits that benchmark windows set, gathered as distinct bit numbers: no more than
    ``FILTER_BITS``, whatever the benchmark's size."""
    bits = items.select(F.expr(f"pmod(hash, {FILTER_BITS})").cast("int").alias("bit")).distinct()
    found = np.zeros(FILTER_BITS, bool)
    found[bits.toArrow().column(0).to_numpy()] = True
    return items.sparkSession.sparkContext.broadcast(found)


def contaminated(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """Rows (doc_id, item_id, n_windows, n_found, share, offset) of contaminated documents, one
    for each document and item with its best reading.

    Items with fewer than ``WINDOW`` template tokens, or without a window of enough literal
    words, are found in documents that are nothing else. Null ids and null texts match nothing; repeated rows count once.
    """
    items = _rows(benchmark.select("item_id", "text"), "item_id").dropDuplicates(["id", "place", "hash"])
    sizes = items.groupBy("id", "way").agg(F.countDistinct("place").alias("n_windows"))
    hits = _rows(documents.select("doc_id", "text"), "doc_id", _filter(items)).drop("way")
    met = (
        hits.alias("d").join(items.join(sizes, ["id", "way"]).alias("i"), "hash")
        .select(
            F.col("d.id").alias("doc_id"), F.col("i.id").alias("item_id"), "i.way", "i.n_windows",
            (F.col("d.place") - F.col("i.place")).alias("offset"), F.col("i.place").alias("place"),
            F.expr(
                "filter(transform(d.kinds, (k, n) -> named_struct('kind', k, 'theirs', i.values[n], "
                "'ours', d.values[n])), x -> x.kind <> 0)"
            ).alias("slots"),
        )
    )
    # A window is in the reading of its own distance and in two of nearby ones that overlap by half.
    met = written(met, "met").withColumn("near", F.expr(f"greatest({NEAR}, n_windows DIV 4)")).withColumn(
        "at",
        F.explode(
            F.expr(
                "array(struct(0 AS kind, CAST(offset AS BIGINT) AS n), "
                "struct(1 AS kind, CAST(floor(offset / (2 * near)) AS BIGINT) AS n), "
                "struct(2 AS kind, CAST(floor((offset + near) / (2 * near)) AS BIGINT) AS n))"
            )
        ),
    )
    reading = ["doc_id", "item_id", "way", "n_windows", "at"]
    # In a reading an item's value stands for its most usual value of the document.
    bound = (
        met.select(*reading, F.explode("slots").alias("s"))
        .groupBy(*reading, "s.kind", "s.theirs", "s.ours")
        .count().groupBy(*reading, "kind", "theirs")
        .agg(F.max(F.struct("count", "ours"))["ours"].alias("ours"))
        .groupBy(*reading).agg(F.collect_set(F.struct("kind", "theirs", "ours")).alias("bound"))
    )
    fits = met.join(bound, reading, "left").where(
        "bound IS NULL OR forall(slots, s -> array_contains(bound, s))"
    )
    best = fits.groupBy(*reading).agg(F.countDistinct("place").alias("n_found"), F.min("offset").alias("offset"))
    best = best.withColumn("share", F.col("n_found") / F.col("n_windows"))
    order = F.struct("share", "n_found", (-F.col("offset")).alias("back"), "n_windows")
    best = best.groupBy("doc_id", "item_id").agg(F.max(order).alias("b"))
    return best.select(
        "doc_id", "item_id", "b.n_windows", "b.n_found", (-F.col("b.back")).alias("offset"), "b.share"
    ).where(F.col("share") >= share)


def decontaminated(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``documents`` that no benchmark item contaminates; null doc_ids stay."""
    found = contaminated(documents, benchmark, share).select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
