"""Row-wise Python over Arrow batches, for the operators that need it."""

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tallyloom.session import written

#: Rows handled at once inside a task; results leave the task in batches of this size.
SLICE = 256
#: Blanks between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\\x20\\x09-\\x0D"

_INPUT = "_in"


class Memo(dict):
    """What a worker remembers: it forgets all when keys and values pass ``limit`` bytes or so,
    and doesn't keep long keys at all."""

    def __init__(self, limit: int = 25_000_000, longest: int = 64):
        super().__init__()
        self.limit, self.longest, self.held = limit, longest, 0

    def keep(self, key: str, value: bytes) -> bytes:
        if len(key) <= self.longest:
            self.held += len(key) + len(value) + 200
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[key] = value
        return value


def told_apart(documents: DataFrame) -> DataFrame:
    """doc_id, variant and text of the rows that have both an id and a text.

    The variant is 0 where all rows of a doc_id have one text, else the text's own number: such
    texts are documents of their own. Only ids and hashes are grouped to find out.
    """
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    number = F.xxhash64("text").bitwiseOR(F.lit(1))
    ends = rows.groupBy("doc_id").agg(F.min(number).alias("low"), F.max(number).alias("high"))
    several = written(ends.where("low <> high").select("doc_id", F.lit(True).alias("several")), "repeated-ids")
    return rows.join(several, "doc_id", "left").select(
        "doc_id", F.when(F.col("several"), number).otherwise(F.lit(0)).alias("variant"), "text"
    )


def is_document(doc_id: Column, text: Column, theirs: Column, variant: Column) -> Column:
    """Whether a row is the document of a (doc_id, variant)."""
    return (doc_id == theirs) & ((variant == 0) | (variant == F.xxhash64(text).bitwiseOR(F.lit(1))))


def with_columns(
    df: DataFrame,
    source: str,
    made: StructType,
    make: Callable[[], Callable[[list], Iterable[Sequence]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with the columns ``made``, computed in Python from the column ``source``.

    ``make`` runs once in each task and gives a function from a list of values (None for
    null) to one tuple of results for each. ``keep`` names the input columns that stay, all
    by default; they pass through untouched. Where an input column has the name of a made
    one, the made one replaces it. Row by row, without a shuffle.
    """
    names = made.fieldNames()
    stays = [c for c in (df.columns if keep is None else keep) if c not in names]
    fields = [StructField(_renamed(i), df.schema[c].dataType) for i, c in enumerate(stays)]
    out = StructType(fields + list(made.fields))
    arrow = to_arrow_schema(out)
    types = [arrow.field(i).type for i in range(len(stays), len(arrow))]
    slim = df.select(
        *[F.col(f"`{c}`").alias(_renamed(i)) for i, c in enumerate(stays)],
        F.col(f"`{source}`").alias(_INPUT),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                results = list(compute(part.column(part.num_columns - 1).to_pylist()))
                columns = [pa.array(c, t) for c, t in zip(zip(*results, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + columns, schema=_like(arrow, part))

    got = slim.mapInArrow(run, out)
    return got.select(
        *[F.col(_renamed(i)).alias(c) for i, c in enumerate(stays)], *[F.col(n) for n in names]
    )


def _renamed(i: int) -> str:
    return f"_kept{i}"


def _like(arrow: pa.Schema, part: pa.RecordBatch) -> pa.Schema:
    """The result's schema with the kept columns' own Arrow types."""
    kept = part.num_columns - 1
    return pa.schema([part.schema.field(i) for i in range(kept)] + [arrow.field(i) for i in range(kept, len(arrow))])
