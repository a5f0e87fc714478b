"""Array and struct functions.

The keyed lookup (N6) is written with ``array_position`` over the extracted key
array instead of a ``filter`` lambda: the same first-match answer, but it stays
inside whole-stage codegen and lets the Parquet reader prune the struct down to
the two fields it needs (lambdas defeat nested-column pruning).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions._util import as_col


def first_item(arr) -> Column:
    """Element 0, or NULL for a NULL or empty array (N1). ANSI-safe, unlike ``arr[0]``."""
    return F.get(as_col(arr), 0)


def struct_lookup(arr, key_field: str, key: str, value_field: str) -> Column:
    """Value field of the first struct whose key field equals ``key``; NULL if none."""
    arr = as_col(arr)
    pos = F.array_position(arr.getField(key_field), F.lit(key))
    return F.get(arr.getField(value_field), (pos - F.lit(1)).cast("int"))


def pruned_items(arr, fields: Sequence[str]) -> Column:
    """The array with only ``fields`` of its structs. Taken field by field, so the reader sees which fields are used;
    a lambda over the whole array would make it read all of them. NULL items become structs of NULLs; NULL array: NULL."""
    arr = as_col(arr)
    return F.arrays_zip(*[arr.getField(f) for f in fields])


def keep_items(arr, fields: Sequence[str], keep: Callable[[dict[str, Column]], Column]) -> Column:
    """Items that meet a condition on their ``fields`` (N3), each with these fields; a NULL condition drops. NULL array: NULL."""
    return F.filter(pruned_items(arr, fields), lambda s: keep({f: s.getField(f) for f in fields}))


def map_items(arr, fields: Sequence[str], make: Callable[[dict[str, Column]], Column]) -> Column:
    """A value from the ``fields`` of every item (N4). NULL array: NULL."""
    return F.transform(pruned_items(arr, fields), lambda s: make({f: s.getField(f) for f in fields}))


def name_with_fallback(arr, lang: str = "main", lang_field: str = "lang", text_field: str = "text") -> Column:
    """Text of the ``lang`` entry, else of the first entry."""
    arr = as_col(arr)
    return F.coalesce(struct_lookup(arr, lang_field, lang, text_field), first_item(arr).getField(text_field))


def first_text(arr, text_field: str = "text") -> Column:
    return first_item(arr).getField(text_field)


def array_size(arr) -> Column:
    """Number of elements, NULL for a NULL array."""
    return F.when(as_col(arr).isNotNull(), F.cardinality(as_col(arr)))


# Nutrient names in the raw ``nutriments`` array, with the output
# column names of the two source implementations.
NUTRIENTS = [
    ("energy-kcal", "energy_kcal", "energy_kcal"),
    ("fat", "fat_100g", "fat_g"),
    ("saturated-fat", "saturated_fat_100g", "saturated_fat_g"),
    ("sugars", "sugar_100g", "sugars_g"),
    ("salt", "salt_100g", "salt_g"),
    ("proteins", "proteins_100g", "proteins_g"),
    ("fiber", "fiber_100g", "fiber_g"),
]


def measure_names(style: str = "100g") -> list[str]:
    idx = {"100g": 1, "g": 2}[style]
    return [n[idx] for n in NUTRIENTS]


def nutrient_columns(arr="nutriments", style: str = "100g", value_field: str = "100g") -> list[Column]:
    """The seven per-100g measures as double columns, named per ``style``."""
    idx = {"100g": 1, "g": 2}[style]
    return [struct_lookup(arr, "name", n[0], value_field).cast("double").alias(n[idx]) for n in NUTRIENTS]
