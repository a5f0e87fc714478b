"""String scalars (F1-F11). All return Columns built from Spark built-ins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions._util import as_col


def first_of_list(c, sep: str = ",") -> Column:
    """First item of a delimited text, untrimmed (F3). NULL text gives NULL."""
    return F.get(F.split(as_col(c), re.escape(sep), -1), 0)


def sentence_case(c) -> Column:
    """First character upper, the rest lower (F6); unlike ``initcap`` it ignores word breaks."""
    c = as_col(c)
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def apply_case(c, case: str) -> Column:
    if case == "sentence":
        return sentence_case(c)
    if case == "upper":
        return F.upper(as_col(c))
    if case == "lower":
        return F.lower(as_col(c))
    if case == "none":
        return as_col(c)
    raise ValueError(f"unknown case {case!r}")


# Fixed value: the language-prefix pattern of a tag such as 'en:sweet-spreads'.
# Exactly two characters then ':' (so 'fra:cafe' keeps its prefix).
TAG_PREFIX = "^..:"


def prettify_tag(c, prefix_pattern: str = TAG_PREFIX) -> Column:
    """Tag -> readable name: drop the language prefix, '-' -> ' ', capitalise words."""
    stripped = F.regexp_replace(as_col(c), prefix_pattern, "")
    return F.initcap(F.regexp_replace(stripped, "-", " "))


def tag_name_offset(c, offset: int = 4) -> Column:
    """Tag -> name by a fixed offset: char ``offset`` upper, rest as is."""
    c = as_col(c)
    return F.concat(F.upper(F.substr(c, F.lit(offset), F.lit(1))), F.substr(c, F.lit(offset + 1)))


def clean_tag(c, lower: bool = True) -> Column:
    """trim, optionally lower (F1 F2)."""
    t = F.trim(as_col(c))
    return F.lower(t) if lower else t


def nonempty(c) -> Column:
    """Predicate: not NULL and not '' (P3)."""
    c = as_col(c)
    return c.isNotNull() & (c != F.lit(""))
