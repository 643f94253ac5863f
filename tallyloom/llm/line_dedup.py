"""Lines that a later document shares with an earlier one, found by aligning the two.

Documents are paired through hashes of runs of neighbouring lines: from each line on, and back
from each line, as many lines as make ``LEAST_WORDS`` words. Every line of a shared block of so
many words lies in such a run inside the block, so the first holder of each run is partner enough,
however popular the run. Each pair is aligned as patience diff does: lines that occur once on
either side and in the same order are anchors, again between anchors; where there are none, the
k-th copy of a line goes with the k-th. Blocks of enough words go from the later document, and so
do runs that the alignment leaves over, as surplus copies and moved lines, wherever they stand.
"""

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.rows import is_document, told_apart
from tallyloom.session import written

#: Words of an aligned block that is deleted.
LEAST_WORDS = 8

_LINES = "doc_id long, variant long, hashes array<long>, words array<int>, runs array<long>"


def lines(text: str) -> tuple[list[int], list[int]]:
    """The hash of each line (0 without a word) and its words; blanks count as one, cases differ."""
    hashes, words = [], []
    for line in text.encode("utf-8").split(b"\n"):
        found = line.split()
        hashes.append(int.from_bytes(xxhash.xxh3_64_digest(b" ".join(found)), "big", signed=True) or 1 if found else 0)
        words.append(len(found))
    return hashes, words


def runs(words: Sequence[int | None], least: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of the shortest runs of at least ``least`` words that begin at each line with
    a word, and of those that end there; no run holds a line of None."""
    places: list[int] = []
    at = ahead = total = 0
    for stop, n in enumerate(words, 1):
        if n is None:
            places, at, ahead, total = [], 0, 0, 0
        elif n:
            places.append(stop - 1)
            total += n
            while total - words[places[at]] >= max(1, least):
                if at >= ahead:
                    yield places[at], stop
                total -= words[places[at]]
                at += 1
            if total >= least:
                yield places[at], stop
                ahead = at + 1


def hashed(documents: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, variant, hashes and words of a document's lines, and the distinct hashes of its runs."""

    def keys(hashes: list[int], words: list[int]) -> list[int]:
        raw = np.array(hashes, np.int64).tobytes()
        found = {xxhash.xxh3_64_intdigest(raw[8 * i : 8 * j]) for i, j in runs(words, least)}
        return np.fromiter(found, np.uint64, len(found)).view(np.int64).tolist()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [lines(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array([m[0] for m in made], pa.list_(pa.int64())),
                        pa.array([m[1] for m in made], pa.list_(pa.int32())),
                        pa.array([keys(*m) for m in made], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "variant", "hashes", "words", "runs"],
                )

    return documents.select("doc_id", "variant", "text").mapInArrow(run, _LINES)


def partners(sequences: DataFrame) -> DataFrame:
    """Pairs (later, earlier): a document and the first holder of each of its runs."""
    held = sequences.select("doc", F.explode("runs").alias("run"))
    known = held.groupBy("run").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    return (
        held.join(known.drop("n"), "run").where("doc > first")
        .select(F.col("doc").alias("later"), F.col("first").alias("earlier")).distinct()
    )


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places (i, j) of equal lines, rising on both sides: equal ends and anchors of a range, and
    the same again between them."""
    found: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        i, m, j, n = ranges.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i == m or j == n:
            continue
        here, there = _copies(a, i, m), _copies(b, j, n)
        once = [(p[0], there[h][0]) for h, p in here.items() if len(p) == 1 == len(there.get(h, ()))]
        anchors = once or [x for h, p in here.items() for x in zip(p, there.get(h, ()))]
        kept = _rising(sorted(anchors))
        found += kept
        for x, y in [*kept, (m, n)] if kept else []:
            ranges.append((i, x, j, y))
            i, j = x + 1, y + 1
    return sorted(found)


def _copies(hashes: list[int], start: int, stop: int) -> dict[int, list[int]]:
    """The places of each line with a word."""
    places: dict[int, list[int]] = {}
    for i in range(start, stop):
        if hashes[i]:
            places.setdefault(hashes[i], []).append(i)
    return places


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``pairs`` whose second places rise too."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        tops[k : k + 1] = [j]
        ends[k : k + 1] = [n]
        before[n] = ends[k - 1] if k else -1
    found, n = [], ends[-1] if ends else -1
    while n >= 0:
        found.append(pairs[n])
        n = before[n]
    return found[::-1]


def blocks(later: list[int], words: list[int], earlier: list[int], least: int) -> list[int]:
    """Line numbers of the later document in aligned blocks of at least ``least`` words, and in
    runs of so many words that stand anywhere in the earlier one."""
    found: set[int] = set()
    block: list[tuple[int, int]] = []
    for place in [*aligned(later, earlier), (-9, -9)]:
        if block and place != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(words[i] for i, _ in block) >= least:
                found.update(i for i, _ in block)
            block = []
        block.append(place)
    left = [(i, j) for i, j in runs(words, least) if not found.issuperset(range(i, j))]
    if left:
        known = dict(zip(later, words, strict=True))
        theirs = {tuple(earlier[i:j]) for i, j in runs([known.get(h) for h in earlier], least)}
        for i, j in left:
            if tuple(later[i:j]) in theirs:
                found.update(range(i, j))
    return sorted(i for i in found if later[i])


def shared_lines(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows (doc_id, variant, lines, earlier): the line numbers that each document loses, sorted,
    and the doc_ids of the documents it was aligned with.

    A pair's earlier document is the one of the smaller doc_id; it is aligned as it was given,
    whatever it loses itself. Rows with a null doc_id or text lose nothing, an empty text has
    no lines, and texts are aligned whole. Rows that repeat a doc_id and its text are one
    document; different texts of one doc_id are documents of their own, told apart by
    ``variant`` and ordered by it. Columns but doc_id and text aren't looked at; an empty table
    gives an empty one.
    """
    sequences = hashed(told_apart(documents), least_words)
    one = sequences.groupBy(F.struct("doc_id", "variant").alias("doc")).agg(
        F.min(F.struct("hashes", "words", "runs")).alias("s")
    )
    one = written(one.select("doc", "s.*"), "lines")
    sides = (
        partners(one).join(one.select(F.col("doc").alias("later"), "hashes", "words"), "later")
        .join(one.select(F.col("doc").alias("earlier"), F.col("hashes").alias("theirs")), "earlier")
        .select("later.doc_id", "later.variant", F.col("earlier.doc_id").alias("earlier"), "hashes", "words", "theirs")
    )

    def align(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True)
                made = [(x, v, e, found) for x, v, e, h, w, t in rows if (found := blocks(h, w, t, least_words))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([m[0] for m in made], pa.int64()),
                        pa.array([m[1] for m in made], pa.int64()),
                        pa.array([m[2] for m in made], pa.int64()),
                        pa.array([m[3] for m in made], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "variant", "earlier", "lines"],
                )

    found = sides.mapInArrow(align, "doc_id long, variant long, earlier long, lines array<int>")
    # A document's partners are no more than its runs.
    return found.groupBy("doc_id", "variant").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"),
        F.array_sort(F.collect_set("earlier")).alias("earlier"),
    )


def _cut(documents: DataFrame, shared: DataFrame, how: str) -> tuple[DataFrame, dict[str, str], str]:
    """Rows with the lines they lose, their columns' own names for the time being, and what is
    left of the text as an expression."""
    own = {c: f"_own{i}" for i, c in enumerate(documents.columns)}
    rows = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    lost = shared.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "variant", "lines", "earlier")])
    same = is_document(F.col(own["doc_id"]), F.col(own["text"]), F.col("_doc_id"), F.col("_variant"))
    rest = f"filter(split({own['text']}, '\\n'), (x, i) -> NOT array_contains(_lines, i))"
    return rows.join(lost, same, how), own, f"array_join({rest}, '\\n')"


def changed_texts(documents: DataFrame, shared: DataFrame) -> DataFrame:
    """doc_id, lines, earlier and kept_text of each row that loses lines."""
    rows, own, left = _cut(documents, shared, "inner")
    return rows.select(
        F.col(own["doc_id"]).alias("doc_id"), F.col("_lines").alias("lines"),
        F.col("_earlier").alias("earlier"), F.expr(left).alias("kept_text"),
    )


def without_lines(documents: DataFrame, shared: DataFrame, emptied: bool = True) -> DataFrame:
    """``documents`` with the lines in ``shared`` cut out of their texts; other rows as they are.

    Whole lines go, with their line feeds; all columns stay, whatever their names, and
    ``n_chars``, where it is there, is the new length of a changed text. A row that has lost its
    last word stays only if ``emptied``.
    """
    rows, own, left = _cut(documents, shared, "left")
    text = own["text"]
    rows = rows.withColumn(text, F.expr(f"IF(_lines IS NULL, {text}, {left})"))
    if "n_chars" in own:
        count = own["n_chars"]
        length = F.expr(f"IF(_lines IS NULL, {count}, length({text}))")
        rows = rows.withColumn(count, length.cast(documents.schema["n_chars"].dataType))
    if not emptied:
        rows = rows.where(F.col("_lines").isNull() | F.col(text).rlike("[^\\x20\\x09-\\x0D]"))
    return rows.select(*[F.col(n).alias(c) for c, n in own.items()])
