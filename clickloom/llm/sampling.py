"""Bounded samples that do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 2**31


def by_hash(df: DataFrame, rows: int, *columns: str | Column, seed: int = 0) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``columns``; all of them if there are fewer.

    The share is ``rows`` over the count, so the number drawn is binomial with that mean:
    for distinct columns it is above rows + 6 * sqrt(rows) once in a thousand million
    times. A filter: nothing is sorted, and a task ships its own share only. ``df`` is
    counted, so it should be a written table.
    """
    share = rows / max(df.count(), 1)
    if share >= 1:
        return df
    place = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(_STEPS))
    return df.filter(place < int(share * _STEPS))
