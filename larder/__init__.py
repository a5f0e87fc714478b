"""larder: a food-product nutrition warehouse built on Spark.

Raw nested product rows -> staging models -> star schema (dimensions and a
product-by-country fact) -> KPI tables -> data-quality report -> audit log.
Everything is DataFrame / Spark SQL code; see README.md for the layout.
"""

from larder.config import VARIANT_A, VARIANT_B, DEFAULT, Variant  # noqa: F401
from larder.session import get_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["Variant", "VARIANT_A", "VARIANT_B", "DEFAULT", "get_session", "ensure_checkpoint_dir"]
