"""Deterministic hashes for change detection and surrogate keys (DM-01, DM-03)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between hashed fields.
HASH_SEPARATOR = "~"


def attr_text(cols: Sequence[str]) -> Column:
    """The '~'-joined string forms; null and '' read alike."""
    return F.concat_ws(HASH_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def attr_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the '~'-joined string forms; null and '' hash alike."""
    return F.sha2(attr_text(cols), 256)


def surrogate_key(keys: Sequence[str], effective: str = "effective_date") -> Column:
    """SHA-256 of (key..., effective date); ``concat_ws`` skips null parts."""
    return F.sha2(
        F.concat_ws(HASH_SEPARATOR, *[F.col(k) for k in keys], F.col(effective).cast("string")),
        256,
    )


def row_fingerprint(cols: Sequence[str]) -> Column:
    """64-bit hash of a whole row, for order-free table content comparison."""
    return F.xxhash64(*[F.col(c) for c in cols])
