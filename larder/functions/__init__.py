"""Column -> Column helpers: text (F*), dates (D*), nested (N*), predicates (P*, M*)."""

from larder.functions import dates, nested, predicates, text  # noqa: F401
