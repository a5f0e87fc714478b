"""Where the two source implementations disagree, the library takes a parameter.

``VARIANT_A`` reproduces the SQL implementation, ``VARIANT_B`` the DataFrame one,
``DEFAULT`` is the recommended mix (keeps the fact at its product x country grain).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Variant:
    name: str
    # brands (T2, T8)
    brand_case: str = "sentence"         # 'sentence' (first upper, rest lower) | 'upper'
    brand_filter: str = "trimmed"        # 'raw': brands non-empty before trim | 'trimmed': name non-empty after trim
    brand_collapse: str = "row"          # 'none': one row per source row | 'row': max(tag, name) pair | 'independent'
    brand_key: str = "tag"               # dim_brand natural key: 'tag' | 'name'
    # categories
    category_lower: bool = True          # lower(trim(tag)) vs trim(tag)
    category_drop_empty: bool = True
    category_label: str = "first_text"   # 'first_text': first item of `categories` | 'from_tag'
    category_collapse: bool = False      # one row per product in staging
    # countries
    country_lower: bool = True
    country_distinct: bool = True
    country_name: str = "pretty"         # 'pretty': strip prefix, '-' -> ' ', initcap | 'offset': substr(4)
    country_filter: str = "clean"        # drop NULL/'' tags 'raw' (before trim) | 'clean' (after trim/lower)
    # dates (T5, T11)
    date_rows: str = "latest"            # 'per_row' | 'latest' (max date per product)
    weekday: str = "iso"                 # 'iso' (Mon=1) | 'sunday' (Sun=1)
    date_key: str = "smart"              # 'smart' yyyymmdd | 'dense' row_number over the date
    date_col: str = "date_value"         # name of the date column: 'date_value' | 'full_date'
    # nutrition
    nutrition: str = "latest"            # 'max' per metric | 'latest' row by last_modified_t
    measure_names: str = "100g"          # '100g' (fat_100g, sugar_100g) | 'g' (fat_g, sugars_g)
    # products (T1, T7)
    product_name: str = "main_fallback"  # 'main_fallback' | 'first'
    product_quantity_col: str = "product_quantity"
    products_distinct: bool = True       # stg_products as SELECT DISTINCT
    # fact (T12)
    fact_sk: str = "nutrition_sk"

    def __post_init__(self) -> None:
        for name, allowed in _CHOICES.items():
            value = getattr(self, name)
            if value not in allowed:
                raise ValueError(f"Variant.{name}={value!r}; expected one of {sorted(allowed)}")

    def with_(self, **kw) -> "Variant":
        return replace(self, **kw)


_CHOICES = {
    "brand_case": {"sentence", "upper", "lower", "none"},
    "brand_filter": {"raw", "trimmed"},
    "brand_collapse": {"none", "row", "independent"},
    "brand_key": {"tag", "name"},
    "category_label": {"first_text", "from_tag"},
    "country_name": {"pretty", "offset"},
    "country_filter": {"raw", "clean"},
    "date_rows": {"per_row", "latest"},
    "weekday": {"iso", "sunday"},
    "date_key": {"smart", "dense"},
    "date_col": {"date_value", "full_date"},
    "nutrition": {"max", "latest"},
    "measure_names": {"100g", "g"},
    "product_name": {"main_fallback", "first"},
    "product_quantity_col": {"product_quantity", "quantity"},
    "fact_sk": {"nutrition_sk", "nutrition_fact_sk"},
}


VARIANT_A = Variant(
    name="a", brand_case="sentence", brand_filter="raw", brand_collapse="none", brand_key="tag",
    category_lower=True, category_drop_empty=False, category_label="first_text", category_collapse=False,
    country_lower=False, country_distinct=False, country_name="offset", country_filter="raw",
    date_rows="per_row", weekday="iso", date_key="smart", date_col="date_value",
    nutrition="max", measure_names="100g", product_name="main_fallback",
    product_quantity_col="product_quantity", products_distinct=True,
    fact_sk="nutrition_sk",
)

VARIANT_B = Variant(
    name="b", brand_case="upper", brand_filter="trimmed", brand_collapse="independent", brand_key="name",
    category_lower=False, category_drop_empty=True, category_label="from_tag", category_collapse=True,
    country_lower=True, country_distinct=True, country_name="pretty", country_filter="clean",
    date_rows="latest", weekday="sunday", date_key="dense", date_col="full_date",
    nutrition="latest", measure_names="g", product_name="first",
    product_quantity_col="quantity", products_distinct=False,
    fact_sk="nutrition_fact_sk",
)

DEFAULT = Variant(name="default")

VARIANTS = {"a": VARIANT_A, "b": VARIANT_B, "default": DEFAULT}
