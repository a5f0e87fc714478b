"""Dense surrogate keys by a global order (W1 W2) and the first n rows (L1), without a single-partition
window and without moving wide rows more than once.

Keys. ``row_number() over (order by k)`` moves every row to one task. Here only the key columns are numbered:

1. the key columns alone are range-partitioned and sorted (Spark samples the cut points; the scan is pruned to them);
2. each key is written, narrow, with its range and its position inside the range, which fixes the placement:
   the counts below and the numbering agree even if an executor is lost and tasks run again;
3. one count per range, turned into running offsets and broadcast (its bound is the number of ranges);
4. the rows are joined back by key; number = offset + position.

The numbers equal the global ``row_number`` for any cut points. Orders with ties (``unique=False``): equal rows are
first folded into one row with a count (combined map-side), so a value that holds a third of the table is one row; the
folded rows are numbered by their counts, other columns' hash deciding among tied rows, and unfolded in chunks that are dealt out anew.
The input must give the same keys when it is computed twice.

First n rows. A cut value is searched by counting: a bounded sample of keys gives candidates, one pass counts
the rows up to each of them (no shuffle), the interval around n shrinks. Only the rows up to the cut are ranked.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import ensure_checkpoint_dir, work_dir

_PART, _POS, _N, _BASE = "_sk_part", "_sk_pos", "_sk_n", "_sk_base"

_LOW_BITS = (1 << 33) - 1
#: Equal rows unfolded at once by one task.
CHUNK = 1 << 16
#: Keys sampled and cut values counted per round of the search for the n-th row.
SAMPLE, CUTS = 2000, 64
#: Rows beyond n that may be ranked with it.
SLACK = 10_000


@dataclass(frozen=True)
class SortBy:
    """A column to sort by; defaults follow Spark (ASC NULLS FIRST, DESC NULLS LAST)."""
    column: str
    descending: bool = False
    nulls_last: bool | None = None

    @property
    def nulls_first(self) -> bool:
        return not self.descending if self.nulls_last is None else not self.nulls_last

    def order(self, name: str | None = None) -> Column:
        c = F.col(f"`{name or self.column}`")
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def equals(self, value: Column) -> Column:
        return F.col(f"`{self.column}`").eqNullSafe(value)

    def before(self, value, typ) -> Column:
        """The column comes strictly before ``value`` in this order."""
        c = F.col(f"`{self.column}`")
        if value is None:
            return F.lit(False) if self.nulls_first else c.isNotNull()
        v = F.lit(value).cast(typ)
        return F.coalesce(c > v if self.descending else c < v, F.lit(self.nulls_first))


def sort_spec(c: str | SortBy, descending: bool = False, nulls_last: bool | None = None) -> SortBy:
    return c if isinstance(c, SortBy) else SortBy(c, descending, nulls_last)


def _offsets(placed: DataFrame) -> DataFrame:
    """(part, base): rows in all earlier ranges; one row per range."""
    counts = placed.groupBy(_PART).agg(F.sum(_N).alias("_sk_sum"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_PART, F.coalesce(F.sum("_sk_sum").over(earlier), F.lit(0)).alias("_sk_before"))


def _numbered_keys(keys: DataFrame, order: Sequence[SortBy], partitions: int | None) -> DataFrame:
    """``keys`` (distinct, with a count ``_sk_n``) with ``_sk_base``, the rows of all keys before."""
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    by = [o.order() for o in order]
    # Without an explicit count AQE sizes the ranges (adjacent small ranges are merged, keeping their order).
    ranged = keys.repartitionByRange(partitions, *by) if partitions else keys.repartitionByRange(*by)
    within = (ranged.sortWithinPartitions(*by).withColumn(_PART, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    path = work_dir(spark, "keys", uuid.uuid4().hex[:12])
    within.write.parquet(path)
    placed = spark.read.schema(within.schema).parquet(path)
    return placed.join(F.broadcast(_offsets(placed)), _PART)


def surrogate_key(df: DataFrame, order: Sequence[str | SortBy], name: str, *, unique: bool = True,
                  partitions: int | None = None, first: bool = True) -> DataFrame:
    """Add ``name`` = 1..N following ``order`` (column names or :class:`SortBy`). ``unique``: no two rows agree in all
    order columns; otherwise tied rows get consecutive numbers."""
    order, cols = [sort_spec(o) for o in order], df.columns
    names = list(dict.fromkeys(o.column for o in order))
    if unique:
        keys = _numbered_keys(df.select(*[F.col(f"`{c}`") for c in names]).withColumn(_N, F.lit(1)), order, partitions)
        number = (F.col("_sk_before") + F.col(_POS) + 1).cast("bigint")
        out = _joined_back(df, keys.select(*names, number.alias("_sk")), names).withColumnRenamed("_sk", name)
    else:
        rows = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias(_N))
        ties = [c for c in cols if c not in names]
        if ties:  # rows tied in the order, but not equal, follow a hash of the rest
            rows = rows.withColumn("_sk_h1", F.xxhash64(*[F.col(f"`{c}`") for c in ties])).withColumn("_sk_h2", F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in reversed(ties)]))
        extra = ["_sk_h1", "_sk_h2"] if ties else []
        keyed = [*order, *[SortBy(h) for h in extra]]
        keys = _numbered_keys(rows.select(*[F.col(f"`{c}`") for c in [*names, *extra]], _N), keyed, partitions)
        running = Window.partitionBy(_PART).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
        base = (F.col("_sk_before") + F.coalesce(F.sum(_N).over(running), F.lit(0))).alias(_BASE)
        bases = keys.select(*[F.col(f"`{c}`") for c in [*names, *extra]], base)
        placed = _joined_back(rows, bases, [*names, *extra]) if ties else keys.withColumn(_BASE, base)
        out = _unfolded(placed, name)
    return out.select(name, *cols) if first else out.select(*cols, name)


def _joined_back(df: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with their key's columns; NULL keys find each other."""
    side = keys.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)], *[c for c in keys.columns if c not in names])
    on = F.lit(True)
    for i, c in enumerate(names):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}"))
    return df.join(side, on).drop(*[f"_k{i}" for i in range(len(names))])


def _unfolded(rows: DataFrame, name: str) -> DataFrame:
    """Each row ``_sk_n`` times, numbered from ``_sk_base`` + 1; large counts are dealt out in chunks first."""
    once = rows.filter(F.col(_N) <= CHUNK).withColumn(name, F.explode(F.sequence(F.col(_BASE) + 1, F.col(_BASE) + F.col(_N))))
    many = rows.filter(F.col(_N) > CHUNK).withColumn("_sk_from", F.explode(F.sequence(F.lit(0), F.col(_N) - 1, F.lit(CHUNK))))
    many = many.repartition("_sk_from", _BASE).withColumn(
        name, F.explode(F.sequence(F.col(_BASE) + F.col("_sk_from") + 1, F.col(_BASE) + F.least(F.col("_sk_from") + CHUNK, F.col(_N))))).drop("_sk_from")
    return once.unionByName(many).withColumn(name, F.col(name).cast("bigint"))


def small_surrogate_key(df: DataFrame, order: Sequence, name: str, first: bool = True) -> DataFrame:
    """Plain ``row_number`` over a single-partition window.

    Only for tables whose size the domain bounds (a calendar of days).
    """
    sk = F.row_number().over(Window.orderBy(*[sort_spec(o).order() for o in order])).cast("bigint").alias(name)
    return df.select(sk, *df.columns) if first else df.select(*df.columns, sk)


# ---- first n rows ------------------------------------------------------------------------------

def _before(order: Sequence[SortBy], cut: Sequence, types: Sequence, inclusive: bool) -> Column:
    """Rows that come before the key ``cut`` (or up to it)."""
    out, same = F.lit(False), F.lit(True)
    for o, value, typ in zip(order, cut, types):
        out = out | (same & o.before(value, typ))
        same = same & o.equals(F.lit(value).cast(typ))
    return out | same if inclusive else out


def cut_value(df: DataFrame, order: Sequence[SortBy], n: int, slack: int = SLACK) -> tuple[tuple, int, int | None] | None:
    """Where the n-th row lies, from counts alone: (key, rows before the key, rows up to it) if the n-th row has that
    key; (key, rows before it, None) if the n-th is among the rows before the key and these are at most
    n + max(n, slack); None if the whole table has no more rows than that."""
    keys = df.select(*[F.col(f"`{o.column}`") for o in order])
    types, by = [f.dataType for f in keys.schema.fields], [o.order() for o in order]
    low, low_upto, high, bound, seed = None, 0, None, keys.count(), 0
    if bound <= n + max(n, slack):
        return None
    while bound > n + max(n, slack):
        inside = keys if high is None else keys.filter(_before(order, high, types, inclusive=False))
        if low is not None:
            inside = inside.filter(~_before(order, low, types, inclusive=True))
        seed += 1
        sample = inside.sample(min(1.0, SAMPLE / (bound - low_upto)), seed).orderBy(*by).collect()  # about SAMPLE keys
        if not sample:
            continue
        cuts = list(dict.fromkeys(tuple(r) for r in [*sample[::max(1, len(sample) // CUTS)], sample[-1]]))
        counts = keys.agg(*[F.struct(F.count_if(_before(order, c, types, False)), F.count_if(_before(order, c, types, True))) for c in cuts]).first()
        over = next((k for k, c in enumerate(counts) if c[1] >= n), None)
        if over is not None:
            if counts[over][0] < n:
                return cuts[over], *counts[over]
            high, bound = cuts[over], counts[over][0]
        if over != 0:
            last = len(cuts) - 1 if over is None else over - 1
            low, low_upto = cuts[last], counts[last][1]
    return high, bound, None


def top_n(df: DataFrame, order: Sequence[str | SortBy], n: int) -> DataFrame:
    """First ``n`` rows by ``order``, ties broken by the remaining columns. About n rows are moved, whatever the table holds."""
    if n <= 0:
        return df.limit(0)
    order = [sort_spec(o) for o in order]
    rest = [SortBy(c, nulls_last=True) for c in df.columns if c not in {o.column for o in order}]
    types = [df.schema[o.column].dataType for o in order]
    cut = cut_value(df, order, n)
    if cut is not None:
        key, below, upto = cut
        before = df.filter(_before(order, key, types, inclusive=False))
        if upto is not None and rest and upto > n + max(n, SLACK):
            # many rows share the n-th key: those before it are in, and the first of them by the other columns
            same = F.lit(True)
            for o, value, typ in zip(order, key, types):
                same = same & o.equals(F.lit(value).cast(typ))
            return before.unionByName(top_n(df.filter(same), rest, n - below))
        df = before if upto is None else df.filter(_before(order, key, types, inclusive=True))
    ranked = surrogate_key(df, [*order, *rest], "_top_rank", unique=False, first=False)
    return ranked.filter(F.col("_top_rank") <= n).drop("_top_rank")
