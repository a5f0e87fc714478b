"""One-row-per-key operators.

All of them are aggregations, so Spark combines map-side before the shuffle:
a key that holds a third of the input still sends one partial row per map
task, never its whole group, to a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions._util import as_col


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def collapse_max(df: DataFrame, keys, cols: Sequence[str] | dict[str, str]) -> DataFrame:
    """MAX of each column per key (A1 A2 A3), each column independently."""
    items = cols.items() if isinstance(cols, dict) else [(c, c) for c in cols]
    return df.groupBy(*_names(keys)).agg(*[F.max(src).alias(dst) for dst, src in items])


def one_per_key_max(df: DataFrame, key, col: str, alias: str | None = None) -> DataFrame:
    """MAX of one column per key (A1), e.g. a product -> tag bridge."""
    return collapse_max(df, key, {alias or col: col})


def first_nonnull(df: DataFrame, key, col: str, alias: str | None = None) -> DataFrame:
    """A stable stand-in for FIRST(col IGNORE NULLS) per key (A5): the smallest non-NULL value."""
    return df.groupBy(*_names(key)).agg(F.min(col).alias(alias or col))


def max_row(order: Sequence, payload: Sequence[str]) -> Column:
    """Struct whose MAX is the row with the greatest ``order`` (NULLs lowest), then greatest payload."""
    fields = []
    for i, o in enumerate(order):
        o = as_col(o)
        fields += [o.isNotNull().alias(f"_o{i}n"), o.alias(f"_o{i}")]
    fields += [F.col(c) for c in payload]
    return F.max(F.struct(*fields))


def latest_per_key(df: DataFrame, keys, order: Sequence, payload: Sequence[str] | None = None) -> DataFrame:
    """Keep the latest row per key.

    Same answer as ``row_number() over (partition by keys order by order desc nulls last,
    payload... desc nulls last) = 1``, but written as a MAX over a struct so the
    work is a partial (map-side) aggregation: skew-safe and one shuffle of at most
    one row per key per map task. Ties on ``order`` are broken by the payload
    columns, so the pick is deterministic.
    """
    keys = _names(keys)
    if payload is None:
        payload = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(max_row(order, payload).alias("_latest"))
    return agg.select(*keys, *[F.col("_latest").getField(c).alias(c) for c in payload])


def dedup(df: DataFrame, keys, by: Sequence[str] | None = None) -> DataFrame:
    """Keep one whole row per key subset (A14/A15), the same one in every run: that with the least md5 of its ``by``
    columns (all others by default), ties by the remaining columns' values. The hash picks without favour to early or small values;
    use :func:`latest_per_key` where an order decides. A partial aggregation, so a hot key sends one row per map task.
    Map columns cannot be compared and are not supported."""
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    by = list(by) if by is not None else rest
    digest = F.md5(F.to_json(F.struct(*by), {"ignoreNullFields": "false"})) if len(by) > 1 else F.md5(F.coalesce(F.col(by[0]).cast("string"), F.lit("\x00")))
    pick = df.groupBy(*keys).agg(F.min(F.struct(digest.alias("_digest"), *rest)).alias("_row"))
    return pick.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT."""
    return (df.select(*cols) if cols else df).distinct()
