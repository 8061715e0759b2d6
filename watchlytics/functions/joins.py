"""Joins with tables of one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False, hot: bool = False
) -> DataFrame:
    """Add the columns of ``lookup``, which has at most one row per key, to ``rows``.

    A plain join: Spark broadcasts a lookup it knows to be small. ``null_safe`` lets null keys meet.

    ``hot`` says that a key may hold much of ``rows``. Adaptive execution splits the partition of such a key only
    if both sides were shuffled for this very join, but a lookup aggregated by the same keys is joined as it lies.
    Passing its keys through a one-element array hides that it is in place already, so it moves once more (one row
    per key) and the hot partition is split.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    own = {k: f"_l_{k}" for k in keys}
    renamed = lookup.withColumnsRenamed(own)
    if hot:
        renamed = renamed.withColumns({c: F.array_max(F.array(c)) for c in own.values()})
    pairs = ((F.col(k), F.col(c)) for k, c in own.items())
    match = reduce(Column.__and__, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))
    return rows.join(renamed, match, how).drop(*own.values())
