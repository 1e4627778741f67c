"""Join helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on same-named keys; the output keeps the left key columns.

    The right keys are renamed first, so the join also works when both sides
    come from the same lineage (no ambiguous self-join columns). With
    ``null_safe`` a null key matches a null key, as a window partition would.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    conds = [
        F.col(k).eqNullSafe(F.col(f"__r_{k}")) if null_safe else F.col(k) == F.col(f"__r_{k}")
        for k in keys
    ]
    out = left.join(renamed, on=reduce(lambda a, b: a & b, conds), how=how)
    return out.drop(*[f"__r_{k}" for k in keys])
