"""Duplicate lines, and passages inside lines, by hashing normalised units.

A unit is a line, or a piece of one: a line is also cut behind each word at which a hash of it
and the next word says so. Such cuts depend on the words around them alone, so a passage that is
pasted into the middle of lines is made of the same units wherever it stands, all but its edges.
Digests of units are grouped globally and the earliest occurrence stays. Whole lines that recur
go at any length. Runs of pieces under ``least_words`` words are left alone: they recur by chance.

Passages don't depend on the cuts: of each ``SEEDS`` neighbouring windows of ``LEAST_WORDS`` words
the one of the least hash is a seed, so any ``SEEDS + LEAST_WORDS - 1`` words that recur hold one.
A seed is grown word by word, both ways, against its first occurrence.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.rows import is_document, told_apart
from tallyloom.llm.shingles import windows
from tallyloom.session import written

#: One word in so many ends a unit, besides those that end a line.
UNIT_WORDS = 8
#: A run of removed units has so many words at least.
LEAST_WORDS = 25
#: Neighbouring windows of which one is a seed.
SEEDS = 26

_EDGE = ".,;:!?\"'()[]{}#*$%&|<>"
#: Code points cut into units at once.
_BLOCK = 500_000
_BLANK = np.zeros(33, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: A unit is one number, by which the units of a text are in order: place, kind, number of words.
_KIND_BITS, _WORDS_BITS = 2, 30
_UNIT = "doc_id long, variant long, high long, low long, unit long, back int, chars long"
_LATER = (
    "doc_id long, variant long, kind byte, reach int, place int, after int, start int, stop int, "
    "first_doc_id long, first_variant long, first_place int"
)
_PIECE, _LINE, _SEED = range(3)


class _Words(dict):
    """A hash of a word without the marks at its edges in lower case; met ones are kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        plain = word.decode().lower().strip(_EDGE)
        self[word] = found = xxhash.xxh3_64_intdigest(plain)
        return found


_KNOWN = _Words()
#: The hash of a word of marks alone.
_MARKS = np.uint64(xxhash.xxh3_64_intdigest(""))


class Words(NamedTuple):
    """Where the words of a text start and stop in code points, their hashes when normalised (lower
    case, marks at edges dropped), and whether a line ends behind each."""

    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    ends: np.ndarray

    @property
    def real(self) -> np.ndarray:
        """Numbers of the words that aren't marks alone."""
        return np.flatnonzero(self.hashes != _MARKS)


def words(text: str) -> Words:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    solid = np.ones(len(points) + 2, bool)
    solid[0] = solid[-1] = False
    solid[1:-1] = ~_BLANK[np.minimum(points, 32)] | (points > 32)
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, stops = edges[::2], edges[1::2]
    found = text.encode().split()
    hashes = np.fromiter(map(_KNOWN.__getitem__, found), np.uint64, len(found))
    lines = np.searchsorted(np.flatnonzero(points == 10), starts)
    ends = np.ones(len(starts), bool)
    ends[:-1] = lines[1:] > lines[:-1]
    return Words(starts, stops, hashes, ends)


class Units(NamedTuple):
    """Pieces, lines and seeds of texts: the text's number, kind, the words they reach back to, begin
    at and end before, start and stop in code points, and two halves of a digest of their words."""

    text: np.ndarray
    kind: np.ndarray
    reach: np.ndarray
    place: np.ndarray
    after: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    digest: np.ndarray


def units(texts: list[str], every: int = UNIT_WORDS) -> Units:
    """The units of each text. A unit reaches back over words of marks alone, which don't count."""
    found = words("\n".join(texts))
    points = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(found.starts, points)  # words of each text
    known = (found.hashes % np.uint64(1_000_003)).astype(np.int64)
    cut = found.ends.copy()
    cut[:-1] |= (known[:-1] * 31 + known[1:]) % 8191 % every == 0
    real = found.real
    hashes = found.hashes[real]
    body = hashes.tobytes()
    parts, digests = [], []
    for kind, last in ((_PIECE, cut), (_LINE, found.ends)):
        after = np.flatnonzero(last) + 1
        place = np.append(0, after)[:-1]
        first, end = np.searchsorted(real, place), np.searchsorted(real, after)
        some = end > first
        place, after = place[some], after[some]
        text = np.searchsorted(bounds, place, "right") - 1
        reach = np.maximum(np.append(0, after)[:-1], bounds[text]) - bounds[text]
        parts.append((text, np.full(len(place), kind), reach, place - bounds[text], after - bounds[text],
                      found.starts[place] - points[text], found.stops[after - 1] - points[text]))
        ends = zip((first[some] * 8).tolist(), (end[some] * 8).tolist(), strict=True)
        digests += [xxhash.xxh3_128_digest(body[a:b], kind) for a, b in ends]
    limits = np.searchsorted(real, bounds).tolist()
    made = windows(hashes, LEAST_WORDS) if len(hashes) >= LEAST_WORDS else hashes[:0]
    places = [seeds(made[a : max(a, b - LEAST_WORDS + 1)]) for a, b in zip(limits, limits[1:], strict=False)]
    text = np.repeat(np.arange(len(texts)), [len(x) for x in places])
    place = np.concatenate([*places, np.zeros(0, np.int64)])
    none = np.zeros(len(place), np.int64)
    parts.append((text, none + _SEED, place, place, place + LEAST_WORDS, none, none))
    starts = (8 * (place + np.array(limits)[text])).tolist()
    digests += [xxhash.xxh3_128_digest(body[a : a + 8 * LEAST_WORDS], _SEED) for a in starts]
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
    return Units(*columns, np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2))


def seeds(made: np.ndarray) -> np.ndarray:
    """Places of the windows' hashes that are least among ``SEEDS`` neighbours (or all, if fewer)."""
    if not len(made):
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(made, min(SEEDS, len(made)))
    least = views.argmin(axis=1) + np.arange(len(views))
    return least[np.append(True, least[1:] != least[:-1])]


def blocks(texts: list[str]) -> Iterator[slice]:
    """Texts of about ``_BLOCK`` code points together, or one longer one."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > _BLOCK:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def grown(mine: np.ndarray, theirs: np.ndarray, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches (start, stop) of ``mine`` that equal ``theirs`` around the seeds at ``places``."""
    found: list[tuple[int, int]] = []
    for p, q in sorted(places):
        if not np.array_equal(mine[p : p + LEAST_WORDS], theirs[q : q + LEAST_WORDS]):
            continue  # another text of the same doc_id
        if found and found[-1][0] <= p and p + LEAST_WORDS <= found[-1][1]:
            a, b = found[-1]
            ends = a - 1, b  # words just outside; a seed that can't pass them adds nothing
            if not any(0 <= k < len(mine) and 0 <= k - p + q < len(theirs) and mine[k] == theirs[k - p + q] for k in ends):
                continue
        n = min(p, q)
        other = np.flatnonzero(mine[p - n : p][::-1] != theirs[q - n : q][::-1])
        start = p - (int(other[0]) if len(other) else n)
        n = min(len(mine) - p, len(theirs) - q)
        other = np.flatnonzero(mine[p : p + n] != theirs[q : q + n])
        found.append((start, p + (int(other[0]) if len(other) else n)))
    return found


def hashed(documents: DataFrame) -> DataFrame:
    """One row for each unit: doc_id, variant, the digest's halves and what ``units`` gives, packed."""
    names = [c.split()[0] for c in _UNIT.split(", ")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                doc, variant = (c.to_numpy() for c in part.columns[:2])
                texts = part.column(2).to_pylist()
                for some in blocks(texts):
                    found = units(texts[some])
                    unit = (found.place << (_KIND_BITS + _WORDS_BITS)) | (found.kind << _WORDS_BITS) | (found.after - found.place)
                    back = (found.place - found.reach).astype(np.int32)
                    columns = [doc[some][found.text], variant[some][found.text], *found.digest.T, unit, back, (found.start << 32) | found.stop]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    return documents.select("doc_id", "variant", "text").mapInArrow(run, _UNIT)


def later_units(found: DataFrame) -> DataFrame:
    """The units of ``hashed`` whose digest occurs at an earlier (doc_id, variant, place), each once,
    with the earliest.

    Units are sorted by digest and place, so the first of a digest comes first and no group is held.
    """
    names = [c.split()[0] for c in _LATER.split(", ")]

    def run(batches):
        last, first = None, None  # the digest and place before, and the first of that digest
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, variant, high, low, unit, back, chars = (c.to_numpy() for c in batch.columns)
            keys = np.stack([high, low, doc, variant, unit])
            before = np.concatenate([keys[:, :1] if last is None else last, keys[:, :-1]], axis=1)
            new = (keys[:2] != before[:2]).any(axis=0)
            again = ~new & (keys == before).all(axis=0)
            if last is None:
                new[0], again[0], first = True, False, keys[2:, :1]
            firsts = np.concatenate([first, keys[2:, new]], axis=1)
            firsts = firsts[:, np.cumsum(new)]
            last, first = keys[:, -1:], firsts[:, -1:]
            on = ~new & ~again & (keys[2:] != firsts).any(axis=0)
            place = unit[on] >> (_KIND_BITS + _WORDS_BITS)
            kind = (unit[on] >> _WORDS_BITS) & ((1 << _KIND_BITS) - 1)
            size, chars = unit[on] & ((1 << _WORDS_BITS) - 1), chars[on]
            numbers = [kind, place - back[on], place, place + size, chars >> 32, chars & 0xFFFFFFFF]
            columns = [doc[on], variant[on], numbers[0].astype(np.int8), *[c.astype(np.int32) for c in numbers[1:]],
                       firsts[0, on], firsts[1, on], (firsts[2, on] >> (_KIND_BITS + _WORDS_BITS)).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    order = ["high", "low", "doc_id", "variant", "unit"]
    return found.repartition("high").sortWithinPartitions(*order).mapInArrow(run, _LATER)


def _dealt(documents: DataFrame) -> DataFrame:
    """The rows that may have spans, dealt out by doc_id. All uses in one query share one shuffle of the texts."""
    return documents.where("doc_id IS NOT NULL AND text IS NOT NULL").repartition("doc_id")


def _grown(seeds: DataFrame, documents: DataFrame) -> DataFrame:
    """The stretches around repeated seeds, grown against the documents of their first occurrence."""
    mine, firsts = ["doc_id", "variant"], ["first_doc_id", "first_variant"]
    pairs = seeds.groupBy(*mine, *firsts).agg(F.collect_list(F.struct("place", "first_place")).alias("places"))
    dealt = _dealt(documents)
    own = dealt.select(F.col("doc_id").alias("doc"), "text")
    theirs = dealt.select(F.col("doc_id").alias("first_doc"), F.col("text").alias("theirs"))
    sides = (
        pairs.join(own, is_document(F.col("doc"), F.col("text"), F.col("doc_id"), F.col("variant")))
        .join(theirs, is_document(F.col("first_doc"), F.col("theirs"), F.col("first_doc_id"), F.col("first_variant")))
        .select(*mine, "first_doc_id", "places", "text", "theirs")
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                rows = []
                for doc, variant, first, places, text, theirs in zip(*(c.to_pylist() for c in batch.slice(at, 100).columns), strict=True):
                    found, other = words(text), words(theirs)
                    real = found.real
                    places = [(x["place"], x["first_place"]) for x in places]
                    for a, b in grown(found.hashes[real], other.hashes[other.real], places):
                        place, after = int(real[a]), int(real[b - 1]) + 1
                        rows.append((doc, variant, first, place, after, int(found.starts[place]), int(found.stops[after - 1])))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 7
                names = ["doc_id", "variant", "first_doc_id", "place", "after", "start", "stop"]
                types = [pa.int64()] * 3 + [pa.int32()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return sides.mapInArrow(run, "doc_id long, variant long, first_doc_id long, place int, after int, start int, stop int")


def repeated_spans(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row (doc_id, variant, start, stop, n_words, first_doc_ids) for each run of repeated units.

    A unit is repeated where the same digest occurs at an earlier (doc_id, variant, place); a run
    is of units next to each other, or over each other. Offsets are those of the original text.
    Rows with a null doc_id or a null text have no spans, an empty text has no units, and texts
    are cut whole. Rows that repeat a doc_id and its text are one document; different texts of
    one doc_id are documents of their own, told apart by ``variant``. Columns but doc_id and
    text aren't looked at; an empty table gives an empty one.
    """
    later = written(later_units(hashed(told_apart(documents))), "units")
    stretches = _grown(later.where(f"kind = {_SEED}"), documents)
    parts = later.where(f"kind <> {_SEED}").drop("first_variant", "first_place").unionByName(
        stretches.withColumns({"kind": F.lit(_SEED).cast("byte"), "reach": F.col("place")})
    )
    order = Window.partitionBy("doc_id", "variant").orderBy("place", "after", "kind")  # one document's units
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("new", F.coalesce(F.col("reach") > F.max("after").over(before), F.lit(True)))
    parts = parts.withColumn("run", F.sum(F.col("new").cast("int")).over(order))
    run = Window.partitionBy("doc_id", "variant", "run")
    parts = parts.withColumn("long", F.max("after").over(run) - F.min("place").over(run) >= least_words)
    return (
        parts.where(f"long OR kind = {_LINE}")
        .groupBy("doc_id", "variant", "run", F.when(~F.col("long"), F.col("place")).alias("line"))
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            (F.max("after") - F.min("place")).cast("long").alias("n_words"),
            F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"),
        )
        .drop("run", "line")
    )


def without_spans(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of ``documents`` that have spans, with ``kept_text``, and ``spans`` as an array of
    (start, stop) in the original text, in order."""
    removed = spans.groupBy("doc_id", "variant").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.sum("n_words").alias("n_words_removed"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_doc_ids")))).alias("first_doc_ids"),
    )
    own = {c: f"_own{i}" for i, c in enumerate(documents.columns)}
    text = own["text"]
    kept = f"""concat_ws('', transform(sequence(0, size(spans)), i -> substring({text},
        IF(i = 0, 0, get(spans, i - 1).stop) + 1,
        IF(i = size(spans), length({text}), get(spans, i).start) - IF(i = 0, 0, get(spans, i - 1).stop))))"""
    rows = _dealt(documents).select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    same = is_document(F.col(own["doc_id"]), F.col(text), F.col("doc_id"), F.col("variant"))
    taken = ["spans", "n_words_removed", "first_doc_ids", "kept_text"]
    return rows.join(removed, same).withColumn("kept_text", F.expr(kept)).select(
        *[F.col(n).alias(c) for c, n in own.items() if c not in taken], *taken
    )
