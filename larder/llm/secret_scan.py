"""Secret scanning with an incremental blob ledger.

Every version of every path is content-addressed: its blob is the SHA-256 of its text. A rule's version is a digest of the
rule itself, so changing a rule is a new version. A ledger row (blob, rules, findings) says which rule versions were
held against a blob and what they found; only pairs of blob and rule version that no row holds are scanned, each
blob once however many paths carry it, and findings are joined back to all paths. New text is scanned with all
rules, known text only with the rules that are new. Findings of rules that are no longer asked for stay in the ledger unread.

Positions come from built-in functions: the text is cut at the matches (``split``) and the matches
are taken out (``regexp_extract_all``) with the same expression, so the running length of pieces
and matches gives each match's start in code points.

A null text is scanned as an empty one. Null ids and repeated rows are paths like any other (one
result row per input row). Extra columns are ignored. Very long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import written


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates, leftmost and non-overlapping; those whose group ``group`` has
    fewer than ``least`` characters are dropped. ``hint`` is a cheap test that every match passes."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    hint: str | None = None

    @property
    def version(self) -> str:
        """Names the rule and what it finds (the hint changes nothing)."""
        return f"{self.kind}-{hashlib.sha256(repr((self.kind, self.pattern, self.least, self.group)).encode()).hexdigest()[:16]}"


# The base expressions of the contract. A run shorter than asked for cannot hide a
# longer one for these two, so the least length stands in the expression.
BASE_RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               8, 2, r"(?i)pass|secret|token|api"),
    SecretRule("access", r"AKIA[A-Z0-9]{12,}", 16, 0, "AKIA"),
    SecretRule("hex", r"[0-9a-f]{32,}", 32, 0, r"[0-9a-f]{32}"),
)
#: Further kinds of this scanner: private key blocks, signed web tokens, forge and chat tokens.
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint="-----BEGIN "),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=r"eyJ"),
    SecretRule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hint=r"gh[pousr]_"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint=r"xox"),
)
ALL_RULES = BASE_RULES + MORE_RULES
FINDINGS = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER_FINDINGS = "array<struct<start:int,rule:string,end:int>>"


_PLACED = "array<struct<start:int,rank:int,kind:string,end:int,keep:boolean>>"


def _placed(parts: Column, rule: SecretRule, rank: int) -> Column:
    """The matches with their starts and ends: running sums of (before, n). An array that grows by one element at a time is
    copied each time, so the sums are taken in blocks of the square root of their number, and then over the blocks."""
    n = F.size(parts)
    wide = F.greatest(F.lit(32), F.ceil(F.sqrt(n)).cast("int"))
    blocks = F.when(n <= 0, F.array().cast("array<array<struct<n:int,g:int,before:int>>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), wide), lambda at: F.slice(parts, at, wide)))
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x["before"] + x["n"]))
    bases = F.aggregate(totals, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                        lambda acc: acc["out"])

    def one(acc, x):
        start = acc["at"] + x["before"]
        found = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (start + x["n"]).alias("end"),
                         (x["g"] >= rule.least).alias("keep"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    def block_places(block, base):
        return F.aggregate(block, F.struct(base.alias("at"), F.array().cast(_PLACED).alias("out")), one, lambda acc: acc["out"])

    return F.flatten(F.zip_with(blocks, bases, block_places))


def spans(text: Column, rule: SecretRule, rank: int) -> Column:
    """Array of (start, rank, kind, end) of the rule's matches in ``text``; code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    parts = F.zip_with(F.zip_with(found, measured, lambda m, g: F.struct(F.length(m).alias("n"), F.length(g).alias("g"))),
                       F.slice(pieces, F.lit(1), F.size(found)),
                       lambda m, p: F.struct(m["n"].alias("n"), m["g"].alias("g"), p.alias("before")))
    placed = _placed(parts, rule, rank)
    kept = F.transform(F.filter(placed, lambda s: s["keep"]),
                       lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"),
                                          s["end"].alias("end")))
    hint = text.rlike(rule.hint) if rule.hint else F.lit(True)
    return F.when(hint, kept).otherwise(F.array().cast(FINDINGS))


def scan(text: Column, rules: Sequence[SecretRule], wanted: Column | None = None) -> Column:
    """All findings (start, rule version, end) of ``rules`` in ``text``; ``wanted``: an array with the versions to be held against it."""
    def found(rule):
        hits = F.transform(spans(text, rule, 0), lambda s: F.struct(s["start"].alias("start"), F.lit(rule.version).alias("rule"), s["end"].alias("end")))
        return hits if wanted is None else F.when(F.array_contains(wanted, rule.version), hits).otherwise(F.array().cast(LEDGER_FINDINGS))

    return F.concat(*[found(r) for r in rules])


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[SecretRule] = ALL_RULES, text_col: str = "text") -> DataFrame:
    """The ledger rows (blob, rules, findings) that ``ledger`` lacks for ``docs``, scanned now: one row per
    blob with the rule versions that had not been held against it."""
    versions = F.array(*[F.lit(r.version) for r in rules])
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("body"))
    # One text per blob: copies meet in a partial aggregation before the shuffle.
    unseen = blobs.groupBy("blob").agg(F.first("body").alias("body"))
    if ledger is None:
        return unseen.select("blob", versions.alias("rules"), scan(F.col("body"), rules).alias("findings"))
    held = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("held"))
    done = held.filter(F.size(F.array_except(versions, "held")) == 0).select("blob")
    unseen = unseen.join(done, "blob", "left_anti").join(held, "blob", "left")
    missing = F.array_except(versions, F.coalesce("held", F.array().cast("array<string>")))
    return unseen.select("blob", missing.alias("rules"), scan(F.col("body"), rules, missing).alias("findings"))


def join_findings(docs: DataFrame, ledger: DataFrame, rules: Sequence[SecretRule] = ALL_RULES, text_col: str = "text",
                  carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, blob and findings (start, rank, kind, end; by start, then by the rules' order) of every row of
    ``docs``, by its blob; of the ledger, what ``rules`` found."""
    rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.version), F.lit(k))])
    kind = F.array(*[F.lit(r.kind) for r in rules])
    asked = F.transform(F.filter("findings", lambda s: F.map_contains_key(rank, s["rule"])), lambda s: F.struct(
        s["start"].alias("start"), rank[s["rule"]].alias("rank"), kind[rank[s["rule"]]].alias("kind"), s["end"].alias("end")))
    told = ledger.select("blob", asked.alias("f")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("f"))).alias("findings"))
    paths = docs.select(*carry, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    return paths.join(told, "blob", "left")


def scan_documents(spark: SparkSession, docs: DataFrame, rules: Sequence[SecretRule] = ALL_RULES,
                   ledger: DataFrame | None = None, text_col: str = "text", carry: Sequence[str] = ("doc_id",), batches: int = 1) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and join its findings to all rows. ``batches``: the documents come in so many
    parts (by a hash of the first carried column), each scanned against the ledger that the parts before have left."""
    part = F.pmod(F.xxhash64(carry[0]), F.lit(batches))
    for k in range(batches):
        own = docs.filter(part == k) if batches > 1 else docs
        new = written(update_ledger(own, ledger, rules, text_col=text_col), "secret-ledger")
        ledger = new if ledger is None else ledger.unionByName(new)
    return join_findings(docs, ledger, rules, text_col=text_col, carry=carry)


def span_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
