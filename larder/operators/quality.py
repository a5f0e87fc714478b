"""Data-quality checks and their report (Q1-Q7).

All checks of a table take ONE scan and one grouping, with a grouping set for each distinct unique key (a composite key
is one key, however many checks name it) on its own typed columns, combined map-side. The row-level checks of a row are the
bits of one number and that number is one more grouping set, of few groups, so that a key's group carries nothing but its
count. The report is a
small DataFrame ``(table_name, check_name, column_name, violations, passed)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.predicates import not_in_nonnull, out_of_range

#: Row-level checks whose outcomes one number holds.
MASK_BITS = 62

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "violations", "passed"]


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | at_least | in_range
    column: str
    values: tuple = field(default=())
    lo: float | None = None
    hi: float | None = None
    where: str | None = None       # optional SQL predicate restricting the checked rows
    mode: str = "values"           # unique (column may be a comma list = composite key): 'values' = duplicated values (NULLs ignored),
                                   #         'rows' = rows minus distinct values (NULL counts as a value)
    label: str | None = None

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        return {"at_least": "positive_values", "in_range": "accepted_range"}.get(self.kind, self.kind)

    def violation(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            bad = c.isNull()
        elif self.kind == "accepted_values":
            bad = not_in_nonnull(c, self.values)
        elif self.kind == "at_least":
            bad = out_of_range(c, lo=self.lo)
        elif self.kind == "in_range":
            bad = out_of_range(c, lo=self.lo, hi=self.hi)
        else:
            raise ValueError(f"{self.kind} is not a row-level check")
        if self.where:
            bad = bad & F.expr(self.where)
        return bad


def not_null(col: str) -> Check:
    return Check("not_null", col)


def unique(col: str, mode: str = "values") -> Check:
    return Check("unique", col, mode=mode)


def accepted_values(col: str, values: Iterable, where: str | None = None) -> Check:
    return Check("accepted_values", col, values=tuple(values), where=where)


def at_least(col: str, lo: float = 0) -> Check:
    return Check("at_least", col, lo=lo)


def in_range(col: str, lo: float, hi: float) -> Check:
    return Check("in_range", col, lo=lo, hi=hi)


def _row(table: str, check: Check, violations: Column) -> Column:
    v = F.coalesce(violations.cast("bigint"), F.lit(0).cast("bigint"))
    return F.struct(F.lit(table).alias("table_name"), F.lit(check.name).alias("check_name"),
                    F.lit(check.column).alias("column_name"), v.alias("violations"))


def _keys(checks: Sequence[Check]) -> list[tuple[tuple[str, ...], str | None]]:
    """The distinct (columns, restriction) whose uniqueness is asked."""
    return list(dict.fromkeys((tuple(k.strip() for k in c.column.split(",")), c.where) for c in checks if c.kind == "unique"))


def run_checks(df: DataFrame, checks: Sequence[Check], table: str = "") -> DataFrame:
    """Evaluate ``checks`` on ``df`` (Q6) in one pass."""
    if not checks:
        raise ValueError("no checks")
    by_row = [c for c in checks if c.kind != "unique"]
    keys = _keys(checks)
    names = list(dict.fromkeys(c for cols, _ in keys for c in cols))
    at = {c: f"_k{i}" for i, c in enumerate(names)}
    slots = [tuple(n for n in at.values() if n in {at[c] for c in cols}) for cols, _ in keys]
    sets = list(dict.fromkeys(slots))  # the columns' order does not matter
    wheres = list(dict.fromkeys(w for _, w in keys if w))
    masks = []
    for lo in range(0, len(by_row), MASK_BITS):
        mask = F.lit(0).cast("bigint")
        for i, c in enumerate(by_row[lo:lo + MASK_BITS]):
            mask = mask.bitwiseOR(F.when(F.coalesce(c.violation(), F.lit(False)), F.lit(1 << i).cast("bigint")).otherwise(0))
        masks.append(mask.alias(f"_m{len(masks)}"))
    marks = [f"_m{i}" for i in range(len(masks))]
    rows = df.select(*[F.col(c).alias(at[c]) for c in names], *masks, *[F.expr(w).alias(f"_w{i}") for i, w in enumerate(wheres)])
    grouped = [*sets, *([tuple(marks)] if marks else [])]
    by = list(dict.fromkeys(c for s in grouped for c in s))
    groups = rows.groupingSets([[F.col(c) for c in s] for s in grouped], *by).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *[F.count_if(f"_w{i}").alias(f"_n{i}") for i in range(len(wheres))])

    def of(s: tuple[str, ...]) -> Column:
        # the grouping id has a bit, the first column's highest, for each column that is not in the set
        return F.col("_set") == sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in s)

    found, totals = {}, []
    for tag, (_, where) in enumerate(keys):
        key = slots[tag]
        n = F.col(f"_n{wheres.index(where)}" if where else "_n")
        whole = of(key) & (n > 1)
        totals.append(F.sum(F.when(whole, n - 1)).alias(f"_rows{tag}"))
        for c in key:
            whole = whole & F.col(c).isNotNull()
        totals.append(F.count_if(whole).alias(f"_values{tag}"))
    for i, c in enumerate(by_row):
        hit = of(tuple(marks)) & (F.col(marks[i // MASK_BITS]).bitwiseAND(F.lit(1 << i % MASK_BITS).cast("bigint")) != 0)
        totals.append(F.sum(F.when(hit, F.col("_n"))).alias(f"_v{i}"))
        found[id(c)] = F.col(f"_v{i}")
    for c in (c for c in checks if c.kind == "unique"):
        tag = keys.index((tuple(k.strip() for k in c.column.split(",")), c.where))
        found[id(c)] = F.col(f"_{'values' if c.mode == 'values' else 'rows'}{tag}")
    report = groups.agg(*totals).select(F.inline(F.array(*[_row(table, c, found[id(c)]) for c in checks])))
    return report.withColumn("passed", F.col("violations") == 0)


def run_suite(tables: dict[str, DataFrame], suite: dict[str, Sequence[Check]]) -> DataFrame:
    """Checks over several tables, one report."""
    out = None
    for name, checks in suite.items():
        r = run_checks(tables[name], checks, name)
        out = r if out is None else out.unionByName(r)
    return out


def status(report: DataFrame) -> str:
    """'SUCCESS' or 'FAILED' (Q7): a soft failure, the run goes on and the audit row says so."""
    failed = report.agg(F.count_if(~F.col("passed")).alias("f")).first()["f"]
    return "SUCCESS" if failed == 0 else "FAILED"
