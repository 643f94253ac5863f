"""Phrases that occur more often than their parts let expect.

Suffixes are the up to ``LONGEST`` words from each place of a piece of text. They are routed by
their leading words, so that all suffixes which begin with a phrase meet in one task, which
sorts pointers to them by three-way quicksort, one word a level: the part that equals the pivot
is a phrase and its size the phrase's count, and parts below the least count are left unsorted.

Words come first: a word that is rare in its language ends every suffix, since no frequent
phrase holds it. Suffixes that begin with a very common pair are routed by three words, then
four, then five, so no route grows with the commonest phrase; the shorter phrases of such
suffixes are summed up in each task and routed on their own. On the way suffixes of one route,
out of one block of text, are one row, and the ``CODED`` most frequent words are short codes.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyloom.session import written

#: Words of a phrase, at most.
LONGEST = 5
#: Occurrences a phrase needs.
LEAST = 100
#: A phrase goes if a longer one that holds it has at least so many per cent of its occurrences.
COVERED = 100
#: Phrases reported for each language.
BEST = 2000

#: Frequent words that have codes, at most.
CODED = 1 << 18

#: Bits of the filter of frequent words; its size is fixed, more words let more rare ones pass.
_FILTER_BITS = 1 << 22
#: Hashed counters of phrases, for each number of words; a hot one has so many suffixes, and so
#: many times its even share.
_BUCKETS = 4096
HOT_ROWS = 50_000
_HOT_SHARE = 4
#: Words known to a task, suffixes summed up at once, bytes of suffixes sorted at once.
_WORDS = 300_000
_SUFFIXES = 700_000
_SORTED = 6_000_000
#: Words of text for each route; suffixes of one route travel and are sorted together.
_ROUTED = 100_000
#: Bytes of text cut into words at once.
_CHUNK = 1 << 20

_END = 0xFF  # a byte that UTF-8 doesn't have, for the ends of pieces
_TABLE = bytes(
    _END if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)

_COUNT = StructType(
    [
        StructField("size", IntegerType()),
        StructField("lang", StringType()),
        StructField("word", StringType()),
        StructField("bucket", IntegerType()),
        StructField("n", LongType()),
    ]
)
_SUFFIX = StructType(
    [
        StructField("route", LongType()),
        StructField("lang", StringType()),
        #: Groups of suffixes, parted by VT. A group is lines: the words by which its suffixes are
        #: routed (shorter phrases aren't counted with them), then for each suffix with this head
        #: its occurrences and further words.
        StructField("groups", StringType()),
    ]
)
_PHRASE = StructType(
    [
        StructField("lang", StringType()),
        StructField("phrase", StringType()),
        StructField("size", IntegerType()),
        StructField("f", LongType()),
    ]
)


def code(rank: int) -> bytes:
    """A short name for a word; no word begins with a full stop, since these end pieces."""
    digits = b""
    while rank or not digits:
        rank, digit = divmod(rank, 94)
        digits += bytes([33 + digit])
    return b"." + digits


def word_hash(lang: str, word: bytes) -> int:
    """As Spark's xxhash64 of the string "lang word", unsigned."""
    return xxhash.xxh64_intdigest(lang.encode() + b" " + word, 42)


def cut(texts: list[str | None]):
    """Lists of words of the texts, in bounded blocks; b"\\xff" parts pieces."""
    body = b"\n".join((t or "").encode("utf-8") for t in texts).translate(_TABLE)
    mark, at = bytes([_END]), 0
    while at < len(body):
        end = body.find(mark, at + _CHUNK)
        end = len(body) if end < 0 else end
        yield body[at:end].replace(mark, b" \xff ").split()
        at = end


class Words(dict):
    """Numbers of a language's words as a task meets them; 0 for ends and words left out."""

    def __init__(self, lang: str, frequent: np.ndarray | None = None):
        super().__init__()
        self.lang, self.frequent = lang, frequent
        self.clear()

    def clear(self):
        super().clear()
        self[bytes([_END])] = 0
        self.words, self.hashes, self.held = [b""], [0], 0

    def __missing__(self, word: bytes) -> int:
        found, number = word_hash(self.lang, word), 0
        if self.frequent is None or self.frequent[found % _FILTER_BITS]:
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(found)
        self.held += len(word) + 100
        self[word] = number
        return number

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))

    def full(self) -> bool:
        return len(self) > _WORDS or self.held > 100 * _WORDS

    def strings(self, codes: dict[bytes, bytes] | None = None) -> pa.Array:
        words = self.words if codes is None else [codes.get(w, w) for w in self.words]
        return pa.array(words, pa.binary()).cast(pa.string())


def mixed(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of word numbers."""
    found = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        found = (found ^ hashes[column]) * _STEP
        found ^= found >> np.uint64(29)
    return found


def buckets(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    return (mixed(hashes, columns) % np.uint64(_BUCKETS)).astype(np.int64)


def runs(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Columns of word numbers of all places where ``size`` words follow each other."""
    columns = [ids[k : len(ids) - size + 1 + k] for k in range(size)]
    whole = np.logical_and.reduce([c > 0 for c in columns]) if len(ids) >= size else np.zeros(0, bool)
    return [c[: len(whole)][whole] for c in columns]


def _by_language(batch: pa.RecordBatch):
    """(language, some of its texts) of a batch of lang and text."""
    for at in range(0, batch.num_rows, 256):
        found: dict[str, list] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
            found.setdefault(lang, []).append(text)
        yield from found.items()


def _count_words(batches):
    """Rows of ``_COUNT``: uses of words (size 1) and of all words (size 0) by language, and
    numbers of suffixes by hash of their first 2 to 4 words."""
    arrow = to_arrow_schema(_COUNT)
    known: dict[str, Words] = {}
    sums: dict[str, np.ndarray] = {}
    met = {size: np.zeros(_BUCKETS, np.int64) for size in range(2, LONGEST)}

    def rows(size, lang, words, bucket, n):
        count = len(n)
        columns = [[size] * count, [lang] * count, words, bucket, n]
        made = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
        return pa.RecordBatch.from_arrays(made, schema=arrow)

    def emptied(lang):
        words, counts = known[lang], sums.pop(lang)
        if counts[1:].any():
            yield rows(1, lang, words.strings()[1:], [None] * (len(counts) - 1), counts[1:])
            yield rows(0, lang, [None], [None], [int(counts[1:].sum())])
        words.clear()

    for batch in batches:
        for lang, texts in _by_language(batch):
            words = known.setdefault(lang, Words(lang))
            for tokens in cut(texts):
                ids = words.numbers(tokens)
                counts = np.bincount(ids, minlength=len(words.words))
                before = sums.get(lang)
                if before is not None:
                    counts[: len(before)] += before
                sums[lang] = counts
                hashes = np.array(words.hashes, np.uint64)
                for size, bucket in met.items():
                    bucket += np.bincount(buckets(hashes, runs(ids, size)), minlength=_BUCKETS)
                if words.full():
                    yield from emptied(lang)
    for lang in list(sums):
        yield from emptied(lang)
    for size, bucket in met.items():
        full = np.flatnonzero(bucket)
        if len(full):
            yield rows(size, None, [None] * len(full), full.astype(np.int32), bucket[full])


def suffixes(ids: np.ndarray) -> np.ndarray:
    """One column for each place where two words follow each other: the words from there on, 0
    after the last."""
    padded = np.concatenate([ids, np.zeros(LONGEST - 1, np.int32)])
    starts = np.flatnonzero((ids > 0) & (padded[1 : len(ids) + 1] > 0))
    found = padded[starts + np.arange(LONGEST)[:, None]]
    for k in range(2, LONGEST):
        found[k][found[k - 1] == 0] = 0
    return found


def summed(found: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of ``found``, sorted, and how often each occurs."""
    order = np.lexsort(found[::-1])
    found = found[:, order]
    starts = np.flatnonzero(np.concatenate([[True], (found[:, 1:] != found[:, :-1]).any(axis=0)]))
    n = np.ones(found.shape[1], np.int64) if n is None else n[order]
    return found[:, starts], np.add.reduceat(n, starts)


def routed(found: np.ndarray, n: np.ndarray, hashes: np.ndarray, hot: dict[int, np.ndarray]):
    """(least size, suffixes, counts): suffixes are cut short, or sent on by more words."""
    for size in range(2, LONGEST + 1):
        on = np.zeros(len(n), bool)
        if size < LONGEST and hot[size].any():
            on = hot[size][buckets(hashes, list(found[:size]))] & (found[size] > 0)
        yield size, found[:, ~on], n[~on]
        if not on.any():
            return
        short, total = found[:, on].copy(), n[on]
        short[size:] = 0
        yield size, *summed(short, total)
        found, n = found[:, on], n[on]


def _route_suffixes(frequent, hot, coded, routes: int):
    arrow = to_arrow_schema(_SUFFIX)

    def headed(lang, strings, hashes, size, suffix, n):
        """Suffixes, which come sorted, grouped by head, as one row for each route."""
        words = [strings.take(pa.array(c, mask=c == 0)) for c in suffix]
        tails = pc.binary_join_element_wise(pa.array(n).cast(pa.string()), *words[size:], " ", null_handling="skip")
        new = (suffix[:size, 1:] != suffix[:size, :-1]).any(axis=0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        offsets = pa.array(np.append(starts, len(n)), pa.int32())
        heads = pc.binary_join_element_wise(*(w.take(pa.array(starts)) for w in words[:size]), " ")
        groups = pc.binary_join_element_wise(heads, pc.binary_join(pa.ListArray.from_arrays(offsets, tails), "\n"), "\n")
        route = (mixed(hashes, list(suffix[:size, starts])) % np.uint64(routes)).astype(np.int64)
        order = np.argsort(route, kind="stable")
        route = route[order]
        starts = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
        offsets = pa.array(np.append(starts, len(route)), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, groups.take(pa.array(order))), "\v")
        langs = pa.array([lang] * len(starts), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(route[starts]), langs, joined], schema=arrow)

    def run(batches):
        known: dict[str, Words] = {}
        held: dict[str, list] = {}
        passing = np.unpackbits(frequent.value)
        codes = {word: code(rank) for rank, word in enumerate(coded.value)}

        def emptied(lang):
            words, parts = known[lang], held.pop(lang, [])
            found = np.concatenate(parts, axis=1) if parts else np.zeros((LONGEST, 0), np.int32)
            if found.shape[1]:
                strings, hashes = words.strings(codes), np.array(words.hashes, np.uint64)
                for size, suffix, n in routed(*summed(found), hashes, hot.value):
                    if len(n):
                        yield headed(lang, strings, hashes, size, suffix, n)
            words.clear()

        for batch in batches:
            for lang, texts in _by_language(batch):
                words = known.setdefault(lang, Words(lang, passing))
                for tokens in cut(texts):
                    held.setdefault(lang, []).append(suffixes(words.numbers(tokens)))
                    if words.full() or sum(p.shape[1] for p in held[lang]) >= _SUFFIXES:
                        yield from emptied(lang)
        for lang in list(held):
            yield from emptied(lang)

    return run


def quicksorted(columns: np.ndarray, n: np.ndarray, least_size: np.ndarray, least: int):
    """(pointer, number of words, count) of each run of equal leading words with ``least`` or
    more occurrences, by three-way quicksort of pointers.

    The first column is the language, the others are words, -1 after the last.
    """
    stack = [(np.arange(len(n)), 0)]
    while stack:
        pointers, depth = stack.pop()
        if n[pointers].sum() < least:
            continue  # nothing in here is frequent, so nothing needs sorting
        keys = columns[depth][pointers]
        some = np.sort(keys[:: len(keys) // 9 + 1])
        pivot = some[len(some) // 2]
        stack.append((pointers[keys < pivot], depth))
        stack.append((pointers[keys > pivot], depth))
        same = pointers[keys == pivot]
        if pivot < 0:
            continue
        if depth >= 2:
            count = int(n[same][least_size[same] <= depth].sum())
            if count >= least:
                yield same[0], depth, count
        if depth + 1 < len(columns):
            stack.append((same, depth + 1))


def _extents(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list starts in the flattened array, and its size."""
    offsets = lists.offsets.to_numpy()
    return offsets[:-1] - offsets[0], np.diff(offsets)


def _count_suffixes(least: int, coded):
    arrow = to_arrow_schema(_PHRASE)

    def counted(table: pa.Table, texts: dict[str, str]) -> pa.RecordBatch:
        groups = pc.split_pattern(table.column("groups").combine_chunks(), "\v")
        lang = table.column("lang").combine_chunks().dictionary_encode().take(pc.list_parent_indices(groups))
        lines = pc.split_pattern(groups.flatten(), "\n", max_splits=1)
        heads = pc.split_pattern(pc.list_element(lines, 0), " ")
        rows = pc.split_pattern(pc.list_element(lines, 1), "\n")
        tails = pc.split_pattern(rows.flatten(), " ")
        words = pa.concat_arrays([heads.flatten(), tails.flatten()]).dictionary_encode()
        numbers = words.indices.to_numpy()
        (head_starts, head_sizes), (_, tail_rows), (tail_starts, tail_sizes) = map(_extents, (heads, rows, tails))
        n = tails.flatten().take(pa.array(tail_starts)).cast(pa.int64()).to_numpy()
        row = np.repeat(np.arange(len(head_sizes)), tail_rows)
        columns = np.full((LONGEST + 1, len(n)), -1, np.int32)
        columns[0] = lang.indices.to_numpy()[row]
        least_size, further = head_sizes[row], tail_sizes - 1
        for k in range(LONGEST):
            own = k < least_size
            columns[k + 1, own] = numbers[head_starts[row[own]] + k]
            own = ~own & (k - least_size < further)
            columns[k + 1, own] = numbers[len(heads.flatten()) + tail_starts[own] + 1 + k - least_size[own]]
        found = list(quicksorted(columns, n, least_size, least))
        names, langs = [texts.get(w, w) for w in words.dictionary.to_pylist()], lang.dictionary.to_pylist()
        made = [
            (langs[columns[0][p]], " ".join(names[w] for w in columns[1 : size + 1, p]), size, count)
            for p, size, count in found
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in made], f.type) for i, f in enumerate(arrow)], schema=arrow
        )

    def run(batches):
        """Rows come sorted by route; whole routes are sorted together."""
        texts = {code(rank).decode(): word.decode() for rank, word in enumerate(coded.value)}
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("groups").nbytes
            if size >= _SORTED:
                table = pa.Table.from_batches(held)
                route = table.column("route").to_numpy()
                end = int(np.searchsorted(route, route[-1]))
                if end:
                    yield counted(table.slice(0, end), texts)
                held = table.slice(end).to_batches()
                size = sum(b.column("groups").nbytes for b in held)
        if held:
            yield counted(pa.Table.from_batches(held), texts)

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``LONGEST`` words with ``least`` or more
    occurrences, and (lang, n) with the number of word occurrences of each language.

    A null language is ``und``, a null text empty; repeated rows count each, texts are read
    whole, other columns are left out; an empty table gives empty results.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = texts.mapInArrow(_count_words, _COUNT).groupBy("size", "lang", "word", "bucket").agg(F.sum("n").alias("n"))
    counts = written(counts.where(f"size <> 1 OR n >= {least}"), "phrase-words")
    totals = counts.where("size = 0").select("lang", "n")
    single = counts.where("size = 1").select("lang", F.col("word").alias("phrase"), "size", F.col("n").alias("f"))
    # At most _FILTER_BITS places.
    place = F.xxhash64(F.concat_ws(" ", "lang", "phrase")).bitwiseAND(_FILTER_BITS - 1).cast("int")
    bits = np.zeros(_FILTER_BITS, np.uint8)
    bits[single.select(place.alias("b")).distinct().toArrow().column(0).to_numpy()] = 1
    hot = {size: np.zeros(_BUCKETS, bool) for size in range(2, LONGEST)}
    for size, table in hot.items():
        found = counts.where(F.col("size") == size).select("bucket", "n").toArrow()
        n = found.column(1).to_numpy()
        table[found.column(0).to_numpy()[n > max(hot_rows, _HOT_SHARE * n.sum() / _BUCKETS)]] = True
    # At most CODED words.
    uses = single.groupBy("phrase").agg(F.sum("f").alias("f"))
    step = F.floor(F.log2("f") * 64)
    fewest = _least_step(uses.groupBy(step.alias("s")).count().collect(), CODED)
    common = uses.where((step >= fewest) & (F.length("phrase") <= 64)).toArrow()
    order = np.argsort(-common.column(1).to_numpy(), kind="stable")
    words = [w.encode() for w in common.column(0).take(pa.array(order)).to_pylist()]
    context = spark.sparkContext
    known = [context.broadcast(v) for v in (np.packbits(bits), hot, words)]
    routes = (totals.agg(F.sum("n")).first()[0] or 0) // _ROUTED + 1
    found = texts.mapInArrow(_route_suffixes(*known, routes), _SUFFIX)
    phrases = found.repartition("route").sortWithinPartitions("route").mapInArrow(_count_suffixes(least, known[2]), _PHRASE)
    return written(phrases.unionByName(single), "phrases"), totals


def _least_step(counted, most: int) -> int:
    """The lowest of the steps (step, rows) from which on there are at most ``most`` rows."""
    total, lowest = 0, 1 << 30
    for step, rows in sorted(map(tuple, counted), reverse=True):
        total += rows
        if total > most:
            break
        lowest = step
    return lowest


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``best`` phrases of 2 words or more.

    A phrase's score is that of its lowest-scoring cut in two. Phrases that lie in a longer
    frequent one with ``covered`` per cent of their occurrences or more are left out. Inputs
    are taken as ``frequent_phrases`` says.
    """
    phrases, totals = frequent_phrases(docs, least)
    longer = phrases.where("size >= 3")
    inner = longer.select(
        "lang",
        "f",
        F.expr(
            "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
            "i -> array_join(slice(split(phrase, ' '), i, m), ' ')))))"
        ).alias("phrase"),
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("_most"))
    left = phrases.where("size >= 2").join(most, ["lang", "phrase"], "left")
    left = left.where(f"_most IS NULL OR 100 * _most < {covered} * f")
    cuts = left.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("substring_index(phrase, ' ', k)").alias("_first"),
        F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)").alias("_rest"),
    )
    first = phrases.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    parted = cuts.join(first, ["lang", "_first"]).join(rest, ["lang", "_rest"]).join(totals, "lang")
    # Products of counts may pass 64 bits, but not 38 digits.
    score = F.expr(
        "(CAST(1000 AS DECIMAL(4)) * CAST(CAST(a AS DECIMAL(17)) * CAST(n AS DECIMAL(17)) AS DECIMAL(34)))"
        " DIV (CAST(l AS DECIMAL(17)) * CAST(r AS DECIMAL(17)))"
    )
    weakest = parted.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.select("lang", "phrase", "cut.*").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
