"""WN-01..03: keep the latest record per grain.

``row_number() over (partition by key order by ts desc) = 1`` sorts every key
group inside one task; a hot key (one keyword holding a third of the day)
would then sit in a single task.  ``max_by`` is an ordinary aggregate with a
map-side partial step, so each task first reduces its own slice of a hot key
to one candidate and only candidates cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``order`` is compared lexicographically, greatest wins (latest timestamp
    first, then the tie-break columns); a null order value loses to any
    non-null one, as ``desc nulls last`` does.  The order tuple must be unique
    within a key for the result to be deterministic: always append tie-break
    columns.  With ``keep`` only these columns are carried and returned; an
    order column that is not among them travels once, for comparing.
    """
    keys, keep = list(keys), list(keep or df.columns)
    payload = [c for c in keep if c not in keys]
    rec = F.struct(*[F.col(c) for c in payload])
    rank = F.struct(*[F.col(c) for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(rec, rank).alias("_latest"))
        .select(*[F.col(k) for k in keys], *[F.col(f"_latest.{c}").alias(c) for c in payload])
        .select(*keep)
    )
