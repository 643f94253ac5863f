"""Predicted cost of a record from its size."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import fixed

CostModel = Callable[[Column], Column]


@dataclass(frozen=True)
class Quadratic:
    """Seconds as ``c2*n^2 + c1*n + c0``; calling it gives hours."""

    c2: float = fixed.COST_SECONDS[0]
    c1: float = fixed.COST_SECONDS[1]
    c0: float = fixed.COST_SECONDS[2]

    def seconds(self, size: Column) -> Column:
        n = size.cast("double")
        return (F.lit(self.c2) * n + F.lit(self.c1)) * n + F.lit(self.c0)

    def __call__(self, size: Column) -> Column:
        return self.seconds(size) / F.lit(3600.0)


def model_confidence(iptm: Column, ptm: Column) -> Column:
    return F.lit(fixed.CONFIDENCE_IPTM) * iptm + F.lit(fixed.CONFIDENCE_PTM) * ptm
