"""DuckDB SQL for what each registered query must return, from the rules alone.

Everything about products comes from three relations per variant: ``clean`` (each raw row with all
cleaned values side by side), ``product`` (one GROUP BY of it: latest attributes, measures, bridge
values) and ``place`` (product x country). Dimensions number the distinct values of ``clean``; the
fact finds its keys as positions in the sorted lists of those values; KPIs group ``place`` by the
dimensions' own attributes, without surrogate keys. Used only for checking.

``FOOD`` is the DuckDB twin of ``larder.sources.testdata.food``.
"""

from __future__ import annotations

from dataclasses import dataclass

FOOD = """
WITH c AS (
  SELECT l_partkey, list_sort(list(DISTINCT 'en:' || lower(replace(n_name, '_', '-')))) AS tags,
         max(CAST(epoch(l_shipdate) AS BIGINT)) AS t
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_partkey)
SELECT
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS code,
  CASE WHEN p_partkey % 3 = 0 THEN [{'lang': 'en', 'text': upper(p_name)}]
       ELSE [{'lang': 'en', 'text': upper(p_name)}, {'lang': 'main', 'text': p_name}] END AS product_name,
  CASE p_type WHEN 'ECONOMY' THEN 'a' WHEN 'SMALL' THEN 'b' WHEN 'MEDIUM' THEN 'c' WHEN 'STANDARD' THEN 'd'
              WHEN 'LARGE' THEN 'e' ELSE 'unknown' END AS nutriscore_grade,
  CASE WHEN p_partkey % 11 <> 0 THEN p_size - 15 END AS nutriscore_score,
  p_size % 4 + 1 AS nova_group,
  lower(substr(p_type, 1, 1)) AS environmental_score_grade,
  p_size || ' g' AS quantity,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '' ELSE ' ' || p_brand || ' , House' END AS brands,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE ['XX:' || lower(replace(p_brand, '#', '-')), 'xx:house'] END AS brands_tags,
  p_type || ' goods, other' AS categories,
  CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN []::VARCHAR[]
       ELSE [' en:' || lower(p_type) || '-goods', 'en:other'] END AS categories_tags,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE c.tags END AS countries_tags,
  CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE c.t - 86400 * v END AS last_modified_t,
  CASE WHEN p_partkey % 5 = 0 THEN
    [{'name': 'energy-kcal', '100g': p_size * 36.0::DOUBLE}, {'name': 'fat', '100g': CAST(p_size AS DOUBLE)},
     {'name': 'saturated-fat', '100g': p_size / 4.0::DOUBLE}, {'name': 'sugars', '100g': p_size / 5.0::DOUBLE},
     {'name': 'proteins', '100g': p_size / 2.0::DOUBLE}]
  ELSE
    [{'name': 'energy-kcal', '100g': p_size * 36.0::DOUBLE}, {'name': 'fat', '100g': CAST(p_size AS DOUBLE)},
     {'name': 'saturated-fat', '100g': p_size / 4.0::DOUBLE}, {'name': 'sugars', '100g': p_size / 5.0::DOUBLE},
     {'name': 'salt', '100g': p_size / 10.0::DOUBLE + v}, {'name': 'proteins', '100g': p_size / 2.0::DOUBLE},
     {'name': 'fiber', '100g': p_size / 8.0::DOUBLE}] END AS nutriments
FROM part LEFT JOIN c ON p_partkey = l_partkey CROSS JOIN (SELECT unnest([0, 1]) AS v) g
WHERE v = 0 OR p_partkey % 7 = 0
"""



# Nutrient names in the raw table and the measures' names in the two sources.
NUTRIENTS = ["energy-kcal", "fat", "saturated-fat", "sugars", "salt", "proteins", "fiber"]
M_A = ["energy_kcal", "fat_100g", "saturated_fat_100g", "sugar_100g", "salt_100g", "proteins_100g", "fiber_100g"]
M_B = ["energy_kcal", "fat_g", "saturated_fat_g", "sugars_g", "salt_g", "proteins_g", "fiber_g"]
# French month names, January first.
MONTHS = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre",
          "Décembre"]


def _nutrient(name: str) -> str:
    """The value under a nutrient's name: the first such entry of the array."""
    return f"list_filter(nutriments, lambda e: e.name = '{name}')[1]['100g']"


def _upper_first(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def _from_tag(x: str) -> str:
    """'en:some-thing' -> 'Some Thing'."""
    bare = f"CASE WHEN {x}[3] = ':' THEN {x}[4:] ELSE {x} END"
    return f"array_to_string(list_transform(string_split({bare}, '-'), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _date(sec: str) -> str:
    return f"(DATE '1970-01-01' + CAST(floor({sec} / 86400) AS INTEGER))"


def _largest(values: list[str]) -> str:
    """Aggregate: the row with the largest values, NULL the smallest of all; field i is ['v' || i]."""
    parts = ", ".join(f"'n{i}': ({v}) IS NOT NULL, 'v{i}': {v}" for i, v in enumerate(values))
    return f"max({{{parts}}})"


@dataclass(frozen=True)
class Rules:
    """One configuration's rules as SQL over a raw row."""

    measures: list[str]
    quantity: str            # the output name of the raw quantity
    name: str
    brand_name: str
    brand_row: str           # which raw rows speak about a brand
    brand_key: str           # brand_tag | brand_name
    category_tag: str
    category_row: str
    label: str               # the label's column name
    category_label: str
    country: str             # a tag x, cleaned
    country_row: str         # which tags x count
    country_name: str
    country_once: bool
    latest: bool             # measures of the latest row, else the largest of each
    iso: bool                # weekday from Monday = 1, smart date keys; else Sunday = 1, dense keys
    date: str
    date_per_row: bool
    fact_key: str


_ITEM = "trim(split_part({}, ',', 1))"
_FIRST_CATEGORY = "trim(categories_tags[1])"
_LABEL_FROM_TEXT = _upper_first(_ITEM.format("categories"))
_MAIN = "coalesce(list_filter(product_name, lambda e: e.lang = 'main')[1].text, product_name[1].text)"
A = Rules(M_A, "product_quantity", _MAIN, _upper_first(_ITEM.format("brands")), "brands <> ''", "brand_tag",
          f"lower({_FIRST_CATEGORY})", "categories_tags IS NOT NULL", "category_label", _LABEL_FROM_TEXT,
          "trim(x)", "x <> ''", "upper(country_tag[4]) || country_tag[5:]", False, False, True, "date_value", True, "nutrition_sk")
B = Rules(M_B, "quantity", "product_name[1].text", f"upper({_ITEM.format('brands')})", f"{_ITEM.format('brands')} <> ''",
          "brand_name", _FIRST_CATEGORY, f"{_FIRST_CATEGORY} <> ''", "category_name", _from_tag(_FIRST_CATEGORY),
          "lower(trim(x))", "trim(x) <> ''", _from_tag("country_tag"), True, True, False, "full_date", False, "nutrition_fact_sk")
D = Rules(M_A, "product_quantity", _MAIN, _upper_first(_ITEM.format("brands")), f"{_ITEM.format('brands')} <> ''", "brand_tag",
          f"lower({_FIRST_CATEGORY})", f"{_FIRST_CATEGORY} <> ''", "category_label", _LABEL_FROM_TEXT,
          "lower(trim(x))", "trim(x) <> ''", _from_tag("country_tag"), True, True, True, "date_value", False, "nutrition_sk")
ATTRS = ["product_name", "nutriscore_grade", "nova_group", "environmental_score_grade"]


def clean(r: Rules) -> str:
    measured = ", ".join(f"CAST({_nutrient(n)} AS DOUBLE) AS {m}" for n, m in zip(NUTRIENTS, r.measures))
    return f"""SELECT code, last_modified_t, {_date('last_modified_t')} AS d, {r.name} AS product_name,
        if(nutriscore_grade IN ('a', 'b', 'c', 'd', 'e'), nutriscore_grade, NULL) AS nutriscore_grade, nova_group,
        environmental_score_grade, quantity AS {r.quantity}, coalesce({r.brand_row}, false) AS has_brand,
        lower(trim(brands_tags[1])) AS brand_tag, {r.brand_name} AS brand_name, coalesce({r.category_row}, false) AS has_category,
        {r.category_tag} AS category_tag, {r.category_label} AS {r.label},
        list_transform(list_filter(countries_tags, lambda x: {r.country_row}), lambda x: {r.country}) AS countries,
        {measured}, nutriscore_score FROM ({FOOD}) food"""


def brands(r: Rules) -> str:
    """Brand rows: as they are (A), the largest of each column (B) or the largest pair (D) per product."""
    rows = "FROM clean WHERE code IS NOT NULL AND has_brand"
    if r is A:
        return f"SELECT code AS product_code, brand_tag, brand_name {rows}"
    if r is B:
        return f"SELECT code AS product_code, max(brand_tag) AS brand_tag, max(brand_name) AS brand_name {rows} GROUP BY code"
    return f"SELECT product_code, b.v0 AS brand_tag, b.v1 AS brand_name FROM (SELECT code AS product_code, {_largest(['brand_tag', 'brand_name'])} AS b {rows} GROUP BY code)"


def categories(r: Rules) -> str:
    rows = "FROM clean WHERE code IS NOT NULL AND has_category"
    if r is B:
        return f"SELECT code AS product_code, max(category_tag) AS category_tag, max({r.label}) AS {r.label} {rows} GROUP BY code"
    return f"SELECT code AS product_code, category_tag, {r.label} {rows}"


def countries(r: Rules) -> str:
    once = "DISTINCT " if r.country_once else ""
    return f"SELECT {once}code AS product_code, unnest(countries) AS country_tag FROM clean WHERE code IS NOT NULL"


def calendar(r: Rules, d: str) -> str:
    """Attributes of a date, with the columns the rules name."""
    same = f"""CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter, CAST(month({d}) AS INTEGER) AS month,
        strftime({d}, '%w') IN ('0', '6') AS is_weekend, {d} AS {r.date}"""
    if r.iso:
        return f"""{same}, CAST(strftime({d}, '%u') AS INTEGER) AS day_of_week, CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_sk,
            CAST(year({d}) - year({d}) % 10 AS INTEGER) AS decade"""
    return f"{same}, CAST(strftime({d}, '%w') AS INTEGER) + 1 AS day_of_week"


def dates(r: Rules) -> str:
    more = f", CAST(day(d) AS INTEGER) AS day, ({MONTHS})[month(d)] AS month_name" if r.iso else ""
    if r.date_per_row:
        return f"SELECT code AS product_code, {calendar(r, 'd')}{more} FROM clean WHERE d IS NOT NULL"
    return f"""SELECT product_code, {calendar(r, 'd')}{more} FROM (
        SELECT code AS product_code, max(d) AS d FROM clean WHERE code IS NOT NULL AND d IS NOT NULL GROUP BY code)"""


def product(r: Rules) -> str:
    """One row per code: number, latest attributes, measures and the values its fact rows point at."""
    attrs = [*ATTRS, r.quantity]
    best = f"{_largest(['last_modified_t', *attrs])} AS latest"
    figures = [*r.measures, "nutriscore_score"]
    if r.latest:
        grouped = f"{_largest(['last_modified_t', *figures])} AS nut"
        out = ", ".join(f"nut.v{i + 1} AS {m}" for i, m in enumerate(figures)) + ", nut.v0 AS nut_t"
    else:
        grouped = ", ".join(f"max({m}) AS {m}" for m in figures) + ", max(last_modified_t) AS nut_t"
        out = ", ".join([*figures, "nut_t"])
    pair = _largest(["brand_tag", "brand_name"])
    brand = {"brand_name": "max(brand_name) FILTER (has_brand)", "brand_tag": "max(brand_tag) FILTER (has_brand)"}[r.brand_key]
    if r is D:
        brand = f"({pair} FILTER (has_brand)).v0"
    return f"""SELECT row_number() OVER (ORDER BY code) AS product_sk, code AS product_code,
        {", ".join(f"latest.v{i + 1} AS {a}" for i, a in enumerate(attrs))}, {out}, brand, category, last_day FROM (
        SELECT code, {best}, {grouped}, {brand} AS brand, max(category_tag) FILTER (has_category) AS category, max(d) AS last_day
        FROM clean WHERE code IS NOT NULL GROUP BY code)"""


def dim(key: str, value: str | None, of: str, sk: str, drop: str) -> str:
    """Distinct non-NULL keys in order, numbered, each with its largest value."""
    more = f", {value}" if value else ""
    return f"SELECT CAST(dense_rank() OVER (ORDER BY {key}) AS BIGINT) AS {sk}, {key}{more} FROM {of} WHERE {drop} GROUP BY {key}"


def dims(r: Rules) -> dict[str, str]:
    other = "max(brand_name) AS brand_name" if r.brand_key == "brand_tag" else "min(brand_tag) AS brand_tag"
    day = f"SELECT DISTINCT d AS x FROM clean WHERE d IS NOT NULL{'' if r.date_per_row else ' AND code IS NOT NULL'}"
    if not r.date_per_row:
        day = "SELECT DISTINCT last_day AS x FROM product WHERE last_day IS NOT NULL"
    number = "" if r.iso else f"CAST(dense_rank() OVER (ORDER BY x) AS BIGINT) AS date_sk, "
    kept = [r.date, "date_sk", "year", "quarter", "month", "day_of_week", "is_weekend"] + (["decade"] if r.iso else [])
    return {
        "dim_brand": dim(r.brand_key, other, "brands", "brand_sk", f"{r.brand_key} IS NOT NULL"),
        "dim_category": dim("category_tag", f"max({r.label}) AS {r.label}", "categories", "category_sk", "category_tag IS NOT NULL"),
        "dim_country": dim("country_tag", f"any_value({r.country_name}) AS country_name", "countries", "country_sk", "country_tag <> ''"
                           if r.country_once else "country_tag IS NOT NULL"),
        "dim_date": f"SELECT {', '.join(kept)} FROM (SELECT {number}{calendar(r, 'x')} FROM ({day}))",
        "dim_product": f"SELECT CAST(product_sk AS BIGINT) AS product_sk, product_code, {', '.join([*ATTRS, r.quantity])} FROM product"}


def _position(table: str, key: str, value: str) -> str:
    return f"CAST(nullif(list_position((SELECT list({key} ORDER BY {key}) FROM {table}), {value}), 0) AS BIGINT)"


def fact(r: Rules) -> str:
    day = "CAST(strftime(last_day, '%Y%m%d') AS INTEGER)" if r.iso else _position("dim_date", r.date, "last_day")
    return f"""SELECT row_number() OVER (ORDER BY product_sk, country_tag) AS {r.fact_key}, product_sk,
        {_position('dim_category', 'category_tag', 'category')} AS category_sk, {_position('dim_brand', r.brand_key, 'brand')} AS brand_sk,
        {_position('dim_country', 'country_tag', 'country_tag')} AS country_sk, {day} AS date_sk,
        {', '.join([*r.measures, 'nutriscore_score'])} FROM place"""


def relations(r: Rules) -> dict[str, str]:
    return {"clean": clean(r), "product": product(r), "brands": brands(r), "categories": categories(r), "countries": countries(r),
            "dates": dates(r), "place": "SELECT * FROM product JOIN countries USING (product_code)", **dims(r), "fact_nutrition": fact(r)}


def over(r: Rules, body: str) -> str:
    """``body`` over the relations of a variant (DuckDB computes those it uses)."""
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in relations(r).items()) + "\n" + body


def all_of(r: Rules, name: str, cols: str = "*") -> str:
    return over(r, f"SELECT {cols} FROM {name}")


def products(r: Rules) -> str:
    once = "" if r is B else "DISTINCT "
    return over(r, f"SELECT {once}code AS product_code, {', '.join([*ATTRS, r.quantity])} FROM clean WHERE code IS NOT NULL")


def kpis(r: Rules) -> dict[str, str]:
    salt = r.measures[4]
    labelled = f"place JOIN dim_category ON category = category_tag"
    year = "CAST(year(last_day) AS INTEGER) AS year, CAST(month(last_day) AS INTEGER) AS month"
    share = "round(100 * CAST(count(*) FILTER (nutriscore_grade = 'a') AS DOUBLE) / nullif(count(nutriscore_grade), 0), 2) AS pct_produits_nutriscore_a"
    return {
        "kpi_active_products": over(r, "SELECT count(DISTINCT product_code) AS nb_produits_actifs FROM place"),
        "kpi_mean_score": over(r, f"""SELECT {r.label}, b.brand_name, c.country_name, {year}, round(avg(nutriscore_score), 2) AS nutriscore_moyen,
            count(DISTINCT product_code) AS nb_produits FROM {labelled} JOIN dim_brand b ON brand = b.{r.brand_key}
            JOIN dim_country c USING (country_tag) WHERE nutriscore_score IS NOT NULL AND last_day IS NOT NULL GROUP BY ALL"""),
        "kpi_pct_grade_a": over(r, f"SELECT {share} FROM place"),
        "kpi_pct_grade_a_products": over(r, f"SELECT {share} FROM product WHERE product_code IN (SELECT product_code FROM countries)"),
        "kpi_mean_salt": over(r, f"SELECT {r.label}, round(avg({salt}), 4) AS sel_moyen_g FROM {labelled} WHERE {salt} IS NOT NULL GROUP BY ALL"),
        "kpi_completeness": over(r, """SELECT round(100 * CAST(count(nutriscore_score) AS DOUBLE) / nullif(count(*), 0), 2)
            AS taux_completude_nutriscore FROM place""")}


def _check(table: str, kind: str, col: str, *, label: str | None = None, values=(), lo=None, hi=None,
           where: str | None = None, mode: str = "values") -> str:
    name = label or {"at_least": "positive_values", "in_range": "accepted_range"}.get(kind, kind)
    head = f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{col}' AS column_name, "
    if kind == "unique":
        if mode == "values":
            nn = " AND ".join(f"{k} IS NOT NULL" for k in col.split(","))
            v = f"(SELECT count(*) FROM (SELECT {col} FROM {table} WHERE {nn} GROUP BY {col} HAVING count(*) > 1) x)"
        else:
            v = f"((SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {col} FROM {table}) x))"
        return head + f"CAST({v} AS BIGINT) AS violations"
    if kind == "not_null":
        cond = f"{col} IS NULL"
    elif kind == "accepted_values":
        cond = f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(repr(x) for x in values)})"
    elif kind == "at_least":
        cond = f"{col} IS NOT NULL AND {col} < {lo}"
    else:
        cond = f"{col} IS NOT NULL AND ({col} < {lo} OR {col} > {hi})"
    if where:
        cond = f"({cond}) AND ({where})"
    return head + f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {table}"



def quality(r: Rules, mode: str, more: list[tuple] = ()) -> str:
    """The checks on the gold tables, each as one count of violations."""
    keys = ["product_sk", "category_sk", "brand_sk", "country_sk", "date_sk"]
    natural = {"product": "product_code", "category": "category_tag", "brand": "brand_tag", "country": "country_tag", "date": r.date}
    checks = []
    for name, col in natural.items():
        sk = f"{name}_sk"
        checks += [(f"dim_{name}", "unique", sk, {"mode": mode}), (f"dim_{name}", "not_null", sk, {}), (f"dim_{name}", "not_null", col, {})]
    checks += [("dim_product", "accepted_values", "nutriscore_grade", {"values": tuple("abcde"), "where": "nutriscore_grade IS NOT NULL"}),
               ("fact_nutrition", "unique", r.fact_key, {"mode": mode}), ("fact_nutrition", "unique", "product_sk,country_sk", {"mode": mode}),
               *[("fact_nutrition", "not_null", c, {}) for c in [r.fact_key, *keys]],
               ("fact_nutrition", "at_least", "energy_kcal", {"lo": 0}), ("fact_nutrition", "at_least", r.measures[4], {"lo": 0}),
               ("fact_nutrition", "in_range", "nutriscore_score", {"lo": -15, "hi": 40}), *more]
    parts = [_check(t, k, c, **kw) for t, k, c, kw in checks]
    return over(r, "SELECT *, violations = 0 AS passed FROM (" + "\nUNION ALL ".join(parts) + ")")


LINEITEM_CHECKS = [
    ("lineitem", "unique", "l_orderkey,l_linenumber", {}), ("lineitem", "unique", "l_orderkey,l_linenumber", {"mode": "rows", "label": "unique_rows"}),
    ("lineitem", "not_null", "l_shipdate", {}), ("lineitem", "at_least", "l_quantity", {"lo": 0}),
    ("lineitem", "in_range", "l_discount", {"lo": 0.0, "hi": 0.1})]
DQ_A, DQ_B = quality(A, "values", LINEITEM_CHECKS), quality(B, "rows")

_JSON = ["product_name", "brands_tags", "categories_tags", "countries_tags", "nutriments"]


def _food(cols: str, rest: str = "") -> str:
    return f"SELECT {', '.join(f'to_json({c}) AS {c}' if c in _JSON else c for c in cols.split())} FROM ({FOOD}) food {rest}"


DOC_COLS = "code product_name brands nutriscore_grade nutriscore_score nova_group environmental_score_grade categories_tags countries_tags"
_MEASURED = ", ".join(f"CAST({_nutrient(n)} AS DOUBLE) AS {m}" for n, m in zip(NUTRIENTS, M_B))
DOCUMENTS = f"""SELECT {', '.join(f'to_json({c}) AS {c}' if c in _JSON else c for c in DOC_COLS.split())}, {', '.join(M_B)}
    FROM (SELECT *, {_MEASURED} FROM ({FOOD}) food WHERE nutriscore_grade IS NOT NULL) WHERE energy_kcal <= 900"""
_ORDER = ", ".join(f"{c} NULLS LAST" for c in ["code", *[c for c in DOC_COLS.split() if c != "code"], *M_B])


def contract(actual: dict[str, str]) -> str:
    """The contract's columns against the types a file has; NULLs counted where the column exists."""
    wanted = {"code": "string", "nutriscore_grade": "string", "nutriscore_score": "bigint", "nova_group": "int",
              "last_modified_t": "bigint", "countries_tags": "array<string>", "created_t": "bigint"}
    rows = []
    for c, t in wanted.items():
        has = actual.get(c)
        nulls = f"(SELECT count(*) - count({'last_modified_t' if c == 'created_t' else c}) FROM food)" if has else "NULL"
        rows.append(f"('{c}', '{t}', {repr(has) if has else 'NULL'}, {has == t}, {nulls})")
    return f"WITH food AS ({FOOD}) SELECT * FROM (VALUES {', '.join(rows)}) v(column_name, expected_type, actual_type, type_ok, null_rows)"


_TYPES = {"code": "string", "nutriscore_grade": "string", "nutriscore_score": "int", "nova_group": "int", "last_modified_t": "bigint",
          "countries_tags": "array<string>"}
_EVENT = "event_id, user_id, event_type, value"
_SINKS = " UNION ALL ".join(f"SELECT {_EVENT}, '{s}' AS sink FROM events" for s in ("first", "parquet", "json"))
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _nutrition(r: Rules) -> str:
    last = f", {_date('nut_t')} AS last_modified_date" if r.latest else ", nut_t AS last_modified_t"
    return over(r, f"SELECT product_code, {', '.join([*r.measures, 'nutriscore_score'])}{last} FROM product")


def _variant(r: Rules, tail: str) -> dict[str, str]:
    return {**{f"stg_{n}_{tail}": all_of(r, n) for n in ("brands", "categories", "countries")}, f"stg_products_{tail}": products(r),
            f"stg_date_{tail}": all_of(r, "dates"),
            **{f"dim_{n}_{tail}": all_of(r, f"dim_{n}") for n in ("product", "brand", "category", "country", "date")},
            f"fact_nutrition_{tail}": all_of(r, "fact_nutrition")}


TYPED = f"""SELECT code, nutriscore_grade, CAST(nova_group AS BIGINT) AS nova_group, environmental_score_grade, categories, brands,
    CAST(NULL AS BIGINT) AS created_t, CAST(last_modified_t AS BIGINT) AS last_modified_t, CAST(nutriscore_score AS BIGINT) AS nutriscore_score,
    {_MAIN} AS product_name, quantity AS product_quantity, {', '.join(f"array_to_string({c}, ',') AS {c}" for c in ('categories_tags', 'countries_tags', 'brands_tags'))},
    {', '.join(f"CAST({_nutrient(n)} AS DOUBLE) AS {m.removesuffix('_100g')}_100g" for n, m in zip(NUTRIENTS, M_A))} FROM ({FOOD}) food"""


ORACLES: dict[str, str] = {
    **_variant(A, "a"), **_variant(B, "b"), **_variant(D, "default"),
    "dim_product": all_of(A, "dim_product"), "gold_dim_product": all_of(A, "dim_product"),
    **kpis(A), **{f"{k}_default": q for k, q in kpis(D).items()},
    "stg_nutrition_max": _nutrition(A), "stg_nutrition_latest": _nutrition(B),
    "stg_nutrition_rows_a": over(A, f"SELECT code AS product_code, nutriscore_score, last_modified_t, {', '.join(M_A)} FROM clean WHERE code IS NOT NULL"),
    "dq_report": DQ_A, "dq_report_b": DQ_B,
    "run_status": f"SELECT count(*) FILTER (NOT passed) AS failed, if(bool_and(passed), 'SUCCESS', 'FAILED') AS statut FROM ({DQ_A})",
    "document_subset": DOCUMENTS, "document_roundtrip": DOCUMENTS, "document_top_n": f"{DOCUMENTS} ORDER BY {_ORDER} LIMIT 100",
    "document_subset_basic": _food(DOC_COLS, "WHERE nutriscore_grade IS NOT NULL"),
    "food_flags": f"""SELECT code, len(countries_tags) AS nb_countries, if(nutriscore_score > 10, nutriscore_grade, NULL) AS weak_grade
        FROM ({FOOD}) food WHERE code IS NOT NULL""",
    "schema_contract": contract(_TYPES), "schema_drift": contract({**_TYPES, "nutriscore_score": "string", "created_t": "bigint"}),
    "sql_text_lookup": f"SELECT code AS product_code, CAST({_nutrient('salt')} AS DOUBLE) AS nutrient_100g FROM ({FOOD}) food WHERE code IS NOT NULL",
    "land_raw": _food("code product_name nutriscore_grade nutriscore_score nova_group environmental_score_grade quantity brands brands_tags "
                      "categories categories_tags countries_tags last_modified_t nutriments"),
    "audit_append": f"""SELECT true AS run_id_ok, true AS run_date_ok, 'food' AS source_file, 'food.parquet' AS output_file,
        count(*) AS nb_lignes_output, 'SUCCESS' AS statut FROM ({FOOD}) food""",
    "audit_catalog": "SELECT 'part' AS source_file, 'part.parquet' AS output_file, count(*) AS nb_lignes_output, 'SUCCESS' AS statut FROM part",
    "raw_scan_typed": """SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS BIGINT) AS line_number,
        CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag,
        TRY_CAST(l_returnflag AS INTEGER) AS return_flag_code FROM lineitem""",
    "read_paths_source": """SELECT *, 'orders.parquet' AS source_file FROM orders
        UNION ALL BY NAME SELECT *, 'lineitem.parquet' AS source_file FROM lineitem""",
    "date_out_of_range": """SELECT o_orderkey, d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS d_key FROM (
        SELECT o_orderkey, CASE WHEN o_orderkey <= 253 THEN DATE '1970-01-01' + CAST(o_orderkey * 1000000000 // 86400 AS INTEGER) END AS d FROM orders)""",
    "layer_view": "SELECT * FROM orders",
    "mart_table": "SELECT o_custkey, count(*) AS nb_orders, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey",
    "food_typed": TYPED,
    "food_rich_nutrients": f"""SELECT code, last_modified_t, array_to_string(list_transform(rich, lambda e: e.name), ',') AS rich, len(rich) AS nb_rich
        FROM (SELECT code, last_modified_t, list_filter(nutriments, lambda e: e['100g'] > 5) AS rich FROM ({FOOD}) food WHERE code IS NOT NULL)""",
    "food_nutrient_labels": f"""SELECT code, last_modified_t, array_to_string(list_transform(nutriments,
        lambda e: e.name || '=' || CAST(floor(e['100g'] * 10) AS BIGINT)), ';') AS labels FROM ({FOOD}) food WHERE code IS NOT NULL""",
    "active_products_by_period": over(A, f"""SELECT CASE WHEN grouping(m) = 0 THEN 'month' WHEN grouping(y) = 0 THEN 'year' ELSE 'all' END AS period,
        y AS year, m AS month, count(DISTINCT product_code) AS nb_produits_actifs
        FROM (SELECT product_code, CAST(year(last_day) AS INTEGER) AS y, CAST(month(last_day) AS INTEGER) AS m FROM place WHERE last_day IS NOT NULL)
        GROUP BY GROUPING SETS ((y, m), (y), ())"""),
    "bucketed_grades": over(A, "SELECT nutriscore_grade, count(*) AS nb_lignes, count(DISTINCT product_code) AS nb_produits FROM place GROUP BY nutriscore_grade"),
    "contract_by_file": """SELECT 2 AS batch, c AS column_name, e AS expected_type, a AS actual_type, n AS nb_rows
        FROM (VALUES ('value', 'double', 'string'), ('props', 'string', NULL)) v(c, e, a),
             (SELECT count(*) FILTER (event_id % 4 = 2) AS n FROM events)""",
    "write_options": "SELECT count(*) AS nb_rows, 'zstd' AS codecs, true AS groups_small, true AS files_small FROM lineitem",
    "landing_checksum": """SELECT landing, count(*) AS nb_rows, true AS rows_ok, landing <> 'changed' AS content_ok
        FROM orders, (VALUES ('orders'), ('moved'), ('changed')) v(landing) GROUP BY landing""",
    "partition_rerun": """SELECT event_date, count(*) AS nb_events, CAST(sum(CAST(floor(value * f * 100) AS BIGINT)) AS BIGINT) AS cents,
        if(f = 2, 'again', 'first') AS run, true AS committed
        FROM (SELECT CAST(ts AS DATE) AS event_date, value, if(CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events), 2, 1) AS f FROM events)
        GROUP BY event_date, f""",
    "order_nation": """SELECT o_orderkey, o_custkey AS c_custkey, c_nationkey, n_name FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "one_per_customer": "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY md5(CAST(o_orderkey AS VARCHAR))) = 1",
    "star_join_sales": """SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS order_year,
        round(avg(l_extendedprice * (1 - l_discount)), 2) AS avg_revenue,
        count(DISTINCT o_custkey) AS nb_customers, count(*) AS nb_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name, year(o_orderdate)""",
    "latest_event_per_user": f"""SELECT user_id, e.v1 AS event_id, e.v0 AS ts, e.v3 AS event_type, e.v4 AS value, e.v5 AS props FROM (
        SELECT user_id, {_largest(["ts", "event_id", "ts", "event_type", "value", "props"])} AS e FROM events GROUP BY user_id)""",
    "pct_errors": """SELECT CAST(ts AS DATE) AS event_date, count(*) AS nb_events,
        round(100.0::DOUBLE * count(*) FILTER (event_type = 'error') / nullif(count(event_type), 0), 2) AS pct_errors
        FROM events GROUP BY 1""",
    "completeness_labels": """SELECT lang, count(*) AS nb_documents, round(100.0::DOUBLE * count(quality) / nullif(count(*), 0), 2) AS pct_labelled
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "surrogate_key_scalable": "SELECT row_number() OVER (ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in LINEITEM_COLS) + ") AS line_sk, * FROM lineitem",
    "parquet_roundtrip": "SELECT * FROM part", "external_table": "SELECT * FROM part",
    "fan_out": "SELECT *, 'parquet' AS sink FROM events UNION ALL SELECT *, 'json' AS sink FROM events",
    "fan_out_csv_first": _SINKS, "fan_out_json_first": _SINKS,
}
