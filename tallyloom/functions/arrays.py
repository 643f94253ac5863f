"""Zero-based array access over Spark's one-based functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at(array: Column, *index: int) -> Column:
    """``array[i][j]...``; NULL outside the bounds."""
    for i in index:
        array = F.get(array, F.lit(i))
    return array


def cut(array: Column, start: int, stop: int) -> Column:
    """``array[start:stop]``; shorter where the array ends early."""
    return F.slice(array, start + 1, max(stop - start, 0))


def series(df: DataFrame, array: str, *keep: str, value: str = "value") -> DataFrame:
    """One row per array position, counted from 0."""
    return df.select(*keep, F.posexplode(array).alias("pos", value))
