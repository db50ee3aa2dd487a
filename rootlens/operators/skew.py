"""Joining a huge table to a lookup when a few keys hold most of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks that the rows of one key are spread over.
SALTS = 16


def salted_lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join on ``key`` with the rows of every key spread over SALTS tasks.

    Each lookup row is copied SALTS times and every row of ``rows`` meets exactly
    one copy, so the result equals the plain join, whatever keys are frequent and
    however many. ``spread`` names columns that tell the rows of a key apart.
    """
    keys = [key] if isinstance(key, str) else list(key)
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        rows.withColumn("_salt", salt)
        .join(lookup.withColumn("_salt", copies), [*keys, "_salt"], how)
        .drop("_salt")
    )
