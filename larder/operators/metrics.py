"""Aggregate expressions for KPIs (A6-A10), and mergeable distinct counts over dense keys.

A dense surrogate key (1..N) makes an exact distinct count a bitmap: one bit a key, 4 KB for each stretch of 32 768
keys. Bitmaps of parts merge by OR, so a part's result (a task's, a day's, a month's) is never counted again from the
rows, and no Expand is planned. They pay where groups hold many keys; for a great many groups of few keys each the
plain distinct aggregation moves less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions._util import as_col


def avg_rounded(c, n: int) -> Column:
    """ROUND(AVG(c), n) (A6), half-up."""
    return F.round(F.avg(as_col(c)), n)


def count_distinct(c) -> Column:
    """COUNT(DISTINCT c) as bigint."""
    return F.count_distinct(as_col(c)).cast("bigint")


def pct_where(cond: Column, denom, digits: int = 2) -> Column:
    """Share of non-NULL ``denom`` rows meeting ``cond``, in %.
    Double arithmetic; an empty input gives NULL rather than a division error."""
    num = F.count(F.when(cond, F.lit(1))).cast("double")
    den = F.count(as_col(denom)).cast("double")
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0.0)), digits)


def pct_nonnull(c, digits: int = 2) -> Column:
    """Share of rows where ``c`` is not NULL, in % (A10)."""
    num = F.count(as_col(c)).cast("double")
    den = F.count(F.lit(1)).cast("double")
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0.0)), digits)


# ---- distinct counts of dense keys as bitmaps (A7 A8) ------------------------------------------

BUCKET, BITS = "_bm_bucket", "_bm_bits"


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., bucket, bits): the distinct non-NULL values of a dense integer key in each group, a bit each."""
    rows = df.filter(F.col(key).isNotNull())
    return rows.groupBy(*by, F.bitmap_bucket_number(key).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of coarser groups from those of finer ones."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Distinct keys of each group (of all rows without ``by``)."""
    return bitmaps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint").alias(name))
