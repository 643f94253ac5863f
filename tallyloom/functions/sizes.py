"""Record sizes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def chain_ids(id_: Column) -> Column:
    """A chain id given as one string or as a list, always as a list."""
    return F.when(
        F.schema_of_variant(id_) == "STRING",
        F.array(F.try_variant_get(id_, "$", "string")),
    ).otherwise(F.try_variant_get(id_, "$", "array<string>"))


def token_count(sequences: Column) -> Column:
    """Chains times sequence length, summed over protein entries; other kinds count 0."""
    return F.aggregate(
        F.filter(sequences, lambda e: e["kind"] == "protein"),
        F.lit(0).cast("bigint"),
        lambda total, e: total
        + F.coalesce(F.size(e["chain_ids"]) * F.length(e["sequence"]), F.lit(0)).cast("bigint"),
    )


def in_window(size: Column, window: tuple[int, int]) -> Column:
    """``lo < size <= hi``."""
    lo, hi = window
    return (size > lo) & (size <= hi)
