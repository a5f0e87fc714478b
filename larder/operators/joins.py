"""Equi-join operators.

No side is forced into a broadcast and none is counted beforehand: the optimiser compares
the measured bytes of a finished shuffle with ``spark.sql.autoBroadcastJoinThreshold`` (AQE), so a
small dimension is broadcast and a large one is shuffled, and skewed shuffles are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, on: str | tuple[str, str], cols: Sequence[str],
           how: str = "left", spread: str | None = None) -> DataFrame:
    """Attach ``cols`` of ``dim`` by a natural key.

    ``on`` is a shared column name or ``(left_name, dim_name)``. Only the key and
    the wanted columns of ``dim`` take part, so name clashes cannot happen. ``spread``: a column whose
    text stands in for a NULL key of any type (behind a character no key has), so that rows without a key
    do not meet in one task; keys are then compared as text, the dimension's in the left key's type.
    """
    left_key, dim_key = (on, on) if isinstance(on, str) else on
    tmp = f"_lk_{dim_key}"
    side = dim.select(F.col(dim_key).alias(tmp), *cols)
    key, other = F.col(left_key), F.col(tmp)
    if spread is not None:
        other = other.cast(df.schema[left_key].dataType).cast("string")
        key = F.coalesce(key.cast("string"), F.concat(F.lit("\x00"), F.coalesce(F.col(spread).cast("string"), F.lit(""))))
    return df.join(side, key == other, how).drop(tmp)


def bridge_lookup(df: DataFrame, key: str, bridge: DataFrame, tag: str, dim: DataFrame,
                  cols: Sequence[str], dim_tag: str | None = None) -> DataFrame:
    """Two-hop lookup product -> tag -> dim columns (J3): bridge is one row per key."""
    out = df.join(bridge.select(key, tag), key, "left")
    return lookup(out, dim, (tag, dim_tag or tag), cols, spread=key)


def star_join(fact: DataFrame, dims: Sequence[tuple]) -> DataFrame:
    """Inner joins of a fact to dimensions ``(dim, key, cols)`` by surrogate key (J5 J6): rows with a
    missing key drop out."""
    for dim, key, cols in dims:
        fact = lookup(fact, dim, key, cols, how="inner")
    return fact
