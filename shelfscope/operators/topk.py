"""SL-01..03: ordered listings and top-k with deterministic tie-breaks.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps its
own k best rows and only those reach the final merge, so the full input is
never sorted globally or collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], k: int, ties: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The ``k`` rows with the greatest (or least) ``by`` values; ``ties``
    (ascending) make the cut deterministic when values are equal."""
    main = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in by]
    return df.orderBy(*main, *[F.col(c).asc_nulls_last() for c in ties]).limit(k)


def ordered(df: DataFrame, by: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """SL-01: full ordering by metric descending (range-partitioned sort)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in by], *[F.col(c).asc_nulls_last() for c in ties])
