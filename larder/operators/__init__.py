"""DataFrame -> DataFrame operators: dedup, surrogate keys, joins, metrics, quality."""

from larder.operators import dedup, joins, keys, metrics, quality  # noqa: F401
