"""Ranked lexical search: for each query item the best documents by saturated term weights.

Documents are first restricted to the items' terms, which is written once. Each task then
builds tries of its documents block by block and searches them for all items, carrying the best
found so far as a bound from block to block; the tasks' best rows are merged by item.
"""

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tallyloom.llm.rows import with_columns
from tallyloom.llm.term_trie import Best, Trie
from tallyloom.llm.terms import terms
from tallyloom.session import written

#: Documents returned for each item.
BEST = 50
#: Vector entries of one trie.
BLOCK = 1_000_000
#: Items' terms held by a task; more items are searched in several blocks.
ITEM_TERMS = 1_000_000
#: Parts that an item's rows are merged in first.
PARTS = 64

_VECTOR = StructType(
    [
        StructField("n", LongType()),
        StructField("terms", ArrayType(IntegerType())),
        StructField("tf", ArrayType(IntegerType())),
    ]
)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def evenness(n: int, documents: int, total: int) -> int:
    """A document's m, from its number of terms."""
    return 100 - 50 + (50 * n * documents) // total


def _item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """(item_id, distinct terms) of all items, in blocks of about ``limit`` terms."""
    size = StructType([StructField("_terms", LongType())])

    def make():
        return lambda texts: ((len(set(terms(t))),) for t in texts)

    total = with_columns(items, "text", size, make, keep=[]).agg(F.sum("_terms")).first()[0] or 0
    blocks = max(1, math.ceil(total / limit))
    key = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for block in range(blocks):
        found: dict = {}
        for row in items.where(key == block).select("item_id", "text").toLocalIterator():
            found.setdefault(row[0], set()).update(terms(row[1]))
        yield [(item, sorted(words)) for item, words in found.items() if words]


def _vectors(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """doc_id, n and the restricted vector of each document that has terms."""
    listed = docs.sparkSession.sparkContext.broadcast(words)

    def make():
        number = {w: i for i, w in enumerate(listed.value)}.get

        def vectors(texts):
            for text in texts:
                found = terms(text)
                held = Counter(map(number, found))
                held.pop(None, None)
                yield len(found), list(held.keys()), list(held.values())

        return vectors

    return with_columns(docs, "text", _VECTOR, make, keep=["doc_id"]).where("n > 0")


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST, limit: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``best`` documents with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are left out. A null
    or empty text has no terms: such a document isn't counted, such an item has no rows. Items
    that share an item_id are one with all their terms. Rows with a repeated doc_id are
    documents of their own; equal scores are ordered by doc_id, null last. Empty tables give
    an empty table. Texts are read whole. ``limit`` bounds the items' terms searched at once.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    found = [_block(docs, items, block, best) for block in _item_blocks(items, limit)]
    rows = functools.reduce(DataFrame.unionByName, found)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    by_part = Window.partitionBy("item_id", part).orderBy(*order)
    by_item = Window.partitionBy("item_id").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(by_part)).where(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= best)
    return rows.select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, items: DataFrame, block: list[tuple], best: int) -> DataFrame:
    words = sorted({w for _, held in block for w in held})
    number = {w: i for i, w in enumerate(words)}
    vectors = written(_vectors(docs, words), "term-vectors")
    count, total = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(words), np.int64)
    for term, holding in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = holding
    # Terms get new numbers, the most frequent first.
    new = np.empty(len(words), np.int32)
    new[np.argsort(-df, kind="stable")] = np.arange(len(words))
    weights = np.zeros(len(words), np.int64)
    weights[new] = [weight(count, n) for n in df.tolist()]
    searched = []
    for item, held in block:
        own = np.sort(new[[number[w] for w in held]])
        searched.append((item, own, weights[own]))
    known = docs.sparkSession.sparkContext.broadcast((new, searched, count, total))
    out = StructType(
        [
            StructField("item_id", items.schema["item_id"].dataType),
            StructField("doc_id", docs.schema["doc_id"].dataType),
            StructField("score", LongType()),
        ]
    )
    arrow = to_arrow_schema(out)

    def search(batches):
        new, searched, count, total = known.value
        tops = [Best(best) for _ in searched]
        for ids, lengths, sizes, numbers, tf in _grouped(batches):
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            numbers = new[numbers]
            order = np.lexsort((numbers, np.repeat(np.arange(len(sizes)), sizes)))
            m = np.array([evenness(n, count, total) for n in lengths.tolist()], np.int64)
            trie = Trie(offsets, numbers[order], tf[order], m)
            names = [(i is None, 0 if i is None else i) for i in ids]
            for (_, own, weighed), top in zip(searched, tops, strict=True):
                trie.search(own, weighed, top, names)
        for (item, *_), top in zip(searched, tops, strict=True):
            if top.found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(top.found), arrow.field(0).type),
                        pa.array([None if null else i for _, null, i in top.found], arrow.field(1).type),
                        pa.array([-s for s, *_ in top.found], pa.int64()),
                    ],
                    schema=arrow,
                )

    held = vectors.where(F.size("terms") > 0)
    return held.select("doc_id", "n", "terms", "tf").mapInArrow(search, out)


def _grouped(batches):
    """Document ids, lengths, vector sizes, terms and tf of about ``BLOCK`` vector entries."""
    parts, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            ids, n, words, tf = part.columns
            parts.append(
                (
                    ids.to_pylist(),
                    n.to_numpy(),
                    np.diff(words.offsets.to_numpy()),
                    words.flatten().to_numpy(),
                    tf.flatten().to_numpy(),
                )
            )
            held += len(parts[-1][3])
            if held >= BLOCK:
                yield _joined(parts)
                parts, held = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts):
    ids, *arrays = zip(*parts, strict=True)
    return [i for part in ids for i in part], *[np.concatenate(a) for a in arrays]
