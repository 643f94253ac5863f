"""Near duplicates by a join over inverted lists of signature coordinates.

Each set of shingles has a signature of ``COORDINATES`` minima. A document is posted under each
pair of coordinate and value. Two documents that agree at ``MATCHES`` coordinates must share a
list even if each is posted under its rarest ``COORDINATES - MATCHES + 1`` only, so the popular
lists are skipped for all documents that have enough rare ones.

Collisions are counted in two ways. First each list names its most central member, and each
document counts in how many of its lists it meets each of them; the one it meets most often is
compared, one pair for each document, which joins up groups of copies of any size. Of the lists
that still span several components only documents stay whose shingles occur often enough in
other components: where many documents hold one passage, each with a text of its own around it,
none does. What stays is merged: members of the smaller components are tried against the others,
``LEADERS`` at a time, then more, until each list lies in one component or is used up. Where few
pairs are linked there are ``GROWTH`` times as many next, so that a list is used up in a few rounds,
else twice as many, for what they join up. These pairs are filtered before
they leave their lists, by their sizes,
by a sketch of four bits for each coordinate and by a bitmap of the set: whatever agrees at
``MATCHES`` coordinates agrees at so many of their sketches, and bitmaps differ in no more bits
than sets in shingles, so no pair above the threshold is lost. Links are confirmed
on full sets.
"""

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tallyloom.llm.components import contracted
from tallyloom.llm.rows import with_columns
from tallyloom.llm.shingles import digest, shingle_set
from tallyloom.session import written

COORDINATES = 128
#: At a similarity of 0.75 fewer agree in 2.9 of a million pairs (computed; 4.6 at 32 of 64).
MATCHES = 73
LEADERS = 16
#: Members tried next for each one tried before, where most pairs aren't linked.
GROWTH = 64
#: Rows of lists for each pair that is compared before the likeliest of each leader are.
FEW = 4
#: Leaders held at once, pairs tried at once and pairs remembered; each bounds the memory of a task.
MOST_LEADERS = 16_384
_TRIES = 16_384
_SEEN = 100_000
#: Bits of each minimum that a sketch holds, and the lowest of them; those below tell the coordinate.
_BITS = 4
_LOWEST = np.uint64(8)
#: Bits of a set's bitmap, which tells most about sets of up to about so many shingles.
_BITMAP = 2048
#: Shingles handled at once; bounds the memory of a very long text.
_BLOCK = 4096
#: Low bits of a posting's key that tell its coordinate.
_COORDINATE_BITS = np.uint64(COORDINATES - 1)

SIGNATURE = StructType(
    [
        StructField("n_shingles", LongType()),
        StructField("digest", BinaryType()),
        StructField("postings", ArrayType(LongType())),
        StructField("sketch", ArrayType(LongType())),
    ]
)

_SETS = StructType([StructField("size", LongType()), StructField("shingles", ArrayType(LongType()))])


@lru_cache(1)
def _multipliers() -> np.ndarray:
    found = np.random.default_rng(20_111).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
    return found * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> list[int]:
    """For each coordinate its minimum, with the coordinate's number in the low bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        part = shingles[at : at + _BLOCK]
        mixed = part[None, :] * _multipliers()[:, None]
        mixed ^= mixed >> np.uint64(31)
        np.minimum(least, mixed.min(axis=1), out=least)
    numbers = np.arange(COORDINATES, dtype=np.uint64)
    return ((least & ~_COORDINATE_BITS) | numbers).view(np.int64).tolist()


def sketch(postings: list[int], shingles: np.ndarray) -> list[int]:
    """Bit planes of a signature (two longs for each bit, one bit for each coordinate), then a bitmap of the set."""
    least = np.array(postings, np.int64).view(np.uint64) >> _LOWEST
    planes = [np.packbits(((least >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)) for k in range(_BITS)]
    bitmap = np.zeros(_BITMAP, np.uint8)
    bitmap[(shingles % np.uint64(_BITMAP)).astype(np.int64)] = 1
    return np.concatenate([*planes, np.packbits(bitmap)]).view(np.int64).tolist()


def agreements(one: str, other: str) -> Column:
    """At how many coordinates two sketches agree: never fewer than their signatures do."""

    def unlike(half: int) -> Column:
        planes = [F.col(one)[i].bitwiseXOR(F.col(other)[i]) for i in range(half, 2 * _BITS, 2)]
        return F.bit_count(reduce(Column.bitwiseOR, planes))

    return F.lit(COORDINATES) - unlike(0) - unlike(1)


def differing(one: str, other: str) -> Column:
    """In how many bits two bitmaps differ: never more than shingles that only one set holds."""
    longs = range(2 * _BITS, 2 * _BITS + _BITMAP // 64)
    return reduce(Column.__add__, [F.bit_count(F.col(one)[i].bitwiseXOR(F.col(other)[i])) for i in longs])


def signed(df: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``df`` with the size, digest, signature and sketch of each text's set; null for an empty set."""

    def make():
        def signatures(texts):
            for t in texts:
                found = shingle_set(t)
                if len(found):
                    minima = signature(found)
                    yield len(found), digest(found), minima, sketch(minima, found)
                else:
                    yield 0, None, None, None

        return signatures

    return with_columns(df, text, SIGNATURE, make, keep)


def prefixes(postings: DataFrame) -> DataFrame:
    """Rows (rep, weight, posting) for each document's rarest coordinates, popular ones skipped.

    A posting that no other document has can't meet any; it still takes its place among the
    rarest, which is why documents with many of them drop out. The weight tells how central a
    document is: how many others its postings meet.
    """
    shared = postings.groupBy("posting").agg(F.count("*").alias("n")).where("n > 1")
    met = postings.join(shared, "posting").groupBy("rep").agg(
        F.sort_array(F.collect_set(F.struct("n", "posting"))).alias("met"),  # a signature's length at most
        F.sum("n").alias("weight"),
    )
    room = F.lit(COORDINATES - MATCHES + 1 - COORDINATES) + F.size("met")
    return met.where(room > 0).select(
        "rep", "weight", F.explode(F.slice("met", F.lit(1), room)).alias("p")
    ).select("rep", "weight", F.col("p.posting").alias("posting"))


def alike(share: int) -> Column:
    """Whether sizes and sketches (n, sketch and ln, ls) allow a link."""
    sizes = 100 * F.least("n", "ln") >= share * F.greatest("n", "ln")
    apart = (100 + share) * differing("sketch", "ls") <= (100 - share) * (F.col("n") + F.col("ln"))
    return sizes & (agreements("sketch", "ls") >= MATCHES) & apart


def met_most(lists: DataFrame, sketches: DataFrame, share: int) -> DataFrame:
    """For each document the pair (a, b) with the central member that most of its lists name."""
    central = lists.groupBy("posting").agg(F.max(F.struct("weight", -F.col("rep"))).alias("m"))
    named = lists.join(central.select("posting", (-F.col("m")["col2"]).alias("leader")), "posting")
    counted = named.where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("times"))
    most = counted.groupBy("rep").agg(F.max(F.struct("times", "leader")).alias("m")).select("rep", "m.leader")
    both = most.join(sketches, "rep").join(sketches.toDF("leader", "ln", "ls"), "leader").where(alike(share))
    return both.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()


def tries(leaders: tuple, members: tuple, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (leader, member) of pairs that may be linked, and their agreements: ``alike`` for whole
    lists. Both sides are (place, root, n, sketch); members stand behind their leaders."""
    (place, root, n, bits), (later, roots, sizes, others) = leaders, members
    far = (place[:, None] < later) & (root[:, None] != roots)
    far &= 100 * np.minimum(n[:, None], sizes) >= share * np.maximum(n[:, None], sizes)
    i, j = np.nonzero(far)
    planes = bits[i, : 2 * _BITS] ^ others[j, : 2 * _BITS]
    unlike = [np.bitwise_or.reduce(planes[:, half::2], axis=1) for half in (0, 1)]
    agree = COORDINATES - sum(np.bitwise_count(x).astype(np.int64) for x in unlike)
    near = agree >= MATCHES
    i, j, agree = i[near], j[near], agree[near]
    apart = np.bitwise_count(bits[i, 2 * _BITS :] ^ others[j, 2 * _BITS :]).sum(axis=1, dtype=np.int64)
    near = (100 + share) * apart <= (100 - share) * (n[i] + sizes[j])
    return i[near], j[near], agree[near]


def merged(rest: DataFrame, leaders: int, share: int) -> DataFrame:
    """Rows (leader, rep, agree) of lists' first ``leaders`` with members of other components that may be linked.

    A list comes in the order of its places: its leaders are held, the others pass by.
    """
    columns = ["posting", "place", "root", "n", "rep", "sketch"]
    rows = rest.select(*columns).repartition("posting").sortWithinPartitions("posting", "place")

    def run(batches):
        at, held = None, None
        seen = set()  # what was found in other lists; forgotten now and then
        for batch in batches:
            found = []
            numbers = [c.to_numpy() for c in batch.columns[:5]]
            bits = batch.column(5).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
            ends = [0, *(np.flatnonzero(np.diff(numbers[0])) + 1).tolist(), batch.num_rows]
            for start, stop in zip(ends, ends[1:]):
                if start == stop:
                    continue
                own = [c[start:stop] for c in (*numbers[1:], bits)]
                first = [c[own[0] <= leaders] for c in own]
                new = at != numbers[0][start]
                at, held = numbers[0][start], first if new else [np.concatenate(x) for x in zip(held, first)]
                step = max(1, _TRIES // (stop - start))
                for k in range(0, len(held[0]), step):
                    place, root, n, rep, sketches = (c[k : k + step] for c in held)
                    later, roots, sizes, reps, others = own
                    i, j, agree = tries((place, root, n, sketches), (later, roots, sizes, others), share)
                    for pair in zip(rep[i].tolist(), reps[j].tolist(), agree.tolist()):
                        if pair not in seen:
                            seen.add(pair)
                            found.append(pair)
                if len(seen) > _SEEN:
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["leader", "rep", "agree"]
            )

    return rows.mapInArrow(run, "leader long, rep long, agree long")


def linkable(rest: DataFrame, texts: DataFrame, share: int) -> DataFrame:
    """The documents (rep) of open lists that a document of another component may be linked with.

    A link needs ``share`` percent of the union, so of either set, in common: a document goes if
    fewer of its shingles occur in other components' documents. Shingles are grouped, not paired.
    """

    def make():
        return lambda values: ((len(found), found.view(np.int64).tolist()) for found in map(shingle_set, values))

    rows = texts.join(rest.select(F.col("rep").alias("doc"), "root").distinct(), "doc")
    own = rows.select("doc", "root", F.xxhash64("text").alias("set"), "text")
    sets = with_columns(own, "text", _SETS, make, ["doc", "root", "set"])
    held = written(sets.select("doc", "root", "set", "size", F.explode("shingles").alias("shingle")), "shingles")
    spans = held.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    common = held.join(spans.select("shingle"), "shingle").groupBy("doc", "set").agg(
        F.count("*").alias("common"), F.max("size").alias("size")
    )
    return common.where(f"100 * common >= {share} * size").select(F.col("doc").alias("rep")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    needed = written(texts.join(ends, "doc", "left_semi"), "compared")
    sides = pairs.join(needed.toDF("b", "tb"), "b").join(needed.toDF("a", "ta"), "a").select("a", "ta", "b", "tb")

    def compare(batches):
        last, mine = None, None
        for batch in batches:
            links = []
            for a, ta, b, tb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last != ta:
                    last, mine = ta, shingle_set(ta)
                other = shingle_set(tb)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * both >= share * (len(mine) + len(other) - both):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return sides.mapInArrow(compare, "a long, b long")


def near_duplicates(documents: DataFrame, share: int = 75) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) for each row of ``documents``.

    Documents are linked where ``share`` percent of the union of their 5-word shingle sets is
    common; component_id is the smallest doc_id reachable, kept tells whether it is the
    document's own. Equal sets are joined first, by digest. A null or empty text has no
    shingles and is linked with nothing; a text of fewer than five words is one shingle. A row
    with a null doc_id is returned with a null component_id and kept. Rows that repeat a doc_id
    are linked by any of their texts. Other columns are ignored.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(signed(source, keep=["doc_id"]), "signatures")
    usable = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = written(usable.select("doc_id", "digest").join(first, "digest").distinct(), "members")
    unique = member.where("doc_id = rep").select("rep", F.col("digest").alias("own"))
    reps = usable.join(unique, (usable.doc_id == unique.rep) & (usable.digest == unique.own))
    lists = written(prefixes(reps.select("rep", F.explode("postings").alias("posting"))), "postings")
    sketches = written(reps.select("rep", F.col("n_shingles").alias("n"), "sketch"), "sketches")
    # A document with several texts stands under the representative of each.
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    roots = contracted(member.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")))
    texts = source.select(F.col("doc_id").alias("doc"), "text")
    tested = written(met_most(lists, sketches, share), "pairs")
    roots = _joined(roots, written(confirmed(tested, texts, share), "links"))
    rest = written(_open(_labelled(lists.select("posting", "rep"), roots)), "open")
    texts = written(texts.join(rest.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi"), "texts")
    rest = rest.join(linkable(rest, texts, share), "rep", "left_semi").join(sketches, "rep")
    rest, leaders, best = written(_placed(rest), "open"), LEADERS, True
    while not rest.isEmpty():
        found = merged(rest, leaders, share)
        found = found.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"), "leader", "agree")
        found = written(found.distinct().join(tested, ["a", "b"], "left_anti"), "found")
        best = best and FEW * found.count() > rest.count()
        if best:  # before all are tried: the likeliest partner of each, which joins up most
            found = found.groupBy("leader").agg(F.max(F.struct("agree", "a", "b")).alias("m")).select("m.a", "m.b")
        pairs = written(found.select("a", "b").distinct(), "pairs")
        tested = tested.unionByName(pairs)
        new = written(confirmed(pairs, texts, share), "links")
        links = new.count()
        if links:
            roots = _joined(roots, new)
        if best:
            best = False
        else:
            rest = rest.where(F.col("place") > leaders)
            leaders *= GROWTH if 2 * links < pairs.count() else 2
            leaders = min(leaders, MOST_LEADERS)
        rest = written(_placed(_labelled(rest.drop("root", "place"), roots)), "open")
    ends = member.join(roots.toDF("rep", "root"), "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("root", "rep")).alias("component_id")
    )
    return sets.select("doc_id", "n_shingles").join(ends, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _labelled(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of lists with their components (root), so far as these are known."""
    got = lists.join(roots.toDF("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    return got.select("posting", "rep", "root", *[c for c in lists.columns if c not in ("posting", "rep")])


def _open(rest: DataFrame) -> DataFrame:
    """The lists that span several components."""
    spans = rest.groupBy("posting").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return rest.join(spans.select("posting"), "posting", "left_semi")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after more links: only the links' components are contracted."""
    ends = links.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    moved = contracted(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    known = roots.join(moved.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return written(known.unionByName(moved.join(roots, "node", "left_anti")), "components")


def _placed(rest: DataFrame) -> DataFrame:
    """The lists that span several components, members with their place: those of a list's smallest
    components first, so that it closes as soon as all outside its largest have been tried.

    One shuffle, by list, serves all three windows.
    """
    whole, own = Window.partitionBy("posting"), Window.partitionBy("posting", "root")
    sized = rest.repartition("posting").withColumn("_size", F.count("*").over(own))
    spans = sized.withColumn("_x", F.min("root").over(whole)).withColumn("_y", F.max("root").over(whole)).where("_x <> _y")
    placed = spans.withColumn("place", F.row_number().over(whole.orderBy("_size", "root", "rep")))
    return placed.drop("_size", "_x", "_y")
