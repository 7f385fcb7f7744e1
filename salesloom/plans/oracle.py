"""The same questions in DuckDB SQL, to check the Spark results against."""

from salesloom.sources.synthetic import CITIES, FIRST_NAMES, LAST_NAMES, SEGMENTS, SHIP_MODES

_JOIN = """
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey"""


def _nine_digits(key: str) -> str:
    return f"lpad({key}::VARCHAR, greatest(9, length({key}::VARCHAR))::INTEGER, '0')"


_ORDER_ID = f"'US-' || year(o_orderdate) || '-' || {_nine_digits('o_orderkey')}"
_CUSTOMER_ID = f"'C-' || {_nine_digits('c_custkey')}"
_PRODUCT_ID = f"'P-' || {_nine_digits('p_partkey')}"

_COLUMNS = f"""
    {_ORDER_ID} AS order_id,
    o_orderdate::DATE AS order_date,
    l_shipdate::DATE AS ship_date,
    o_orderpriority AS ship_mode,
    {_CUSTOMER_ID} AS customer_id,
    c_name AS customer_name,
    c_mktsegment AS segment,
    'CITY_' || (c_custkey % 100) AS city,
    n_name AS state,
    lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS postal_code,
    r_name AS region,
    p_type AS category,
    p_brand AS sub_category,
    {_PRODUCT_ID} AS product_id,
    p_name AS product_name,
    p_retailprice AS price,
    l_quantity::INTEGER AS quantity,
    l_discount AS discount"""

_ROW_ID = """
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_shipdate) AS row_id"""

_FAULTS = f"""
    CASE WHEN l_orderkey % 107 = 0 THEN 'not-a-date'
      WHEN l_orderkey % 109 = 0 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN l_orderkey % 113 = 0 THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN l_orderkey % 127 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN l_orderkey % 131 = 0 THEN strftime(o_orderdate, '%b %-d %Y')
      ELSE o_orderdate::DATE::VARCHAR END AS order_date,
    CASE WHEN l_orderkey % 101 <> 0 THEN {_CUSTOMER_ID} END AS customer_id,
    CASE WHEN l_orderkey % 103 <> 0 THEN r_name END AS region,
    CASE WHEN l_partkey % 97 <> 0 THEN p_retailprice END AS price,
    CASE WHEN l_linenumber <> 5 THEN l_quantity::INTEGER END AS quantity,
    CASE l_linenumber WHEN 7 THEN l_discount * 20 WHEN 6 THEN -l_discount WHEN 4 THEN NULL
      ELSE l_discount END AS discount"""
_FAULTY = ("order_date", "customer_id", "region", "price", "quantity", "discount")


def _dirty_columns() -> str:
    plain = [c for c in _COLUMNS.split(",\n") if c.split(" AS ")[-1].strip() not in _FAULTY]
    return ",\n".join([*plain, _FAULTS])


def _ctes(columns: str, row_id: bool = False) -> str:
    """raw -> cleaned -> sales (the enriched lines)."""
    number = f",{_ROW_ID}" if row_id else ""
    return f"""WITH raw AS (SELECT {columns}{number} {_JOIN}),
cleaned AS (
  SELECT * REPLACE (
    coalesce(price, 0) AS price,
    coalesce(quantity, 0)::INTEGER AS quantity,
    least(greatest(coalesce(discount, 0), 0), 1)::DOUBLE AS discount)
  FROM raw),
dated AS (SELECT * REPLACE (coalesce(
    try_strptime(order_date::VARCHAR,
      ['%Y-%m-%d', '%Y%m%d', '%Y/%m/%d', '%m/%d/%Y', '%b %-d %Y'])::DATE,
    NULL) AS order_date) FROM cleaned),
sales AS (
  SELECT *,
    year(order_date)::INTEGER AS order_year,
    month(order_date)::INTEGER AS order_month,
    round_even(price * quantity * (1 - discount), 2) AS revenue,
    round_even(price * quantity * discount, 2) AS discount_amount,
    round_even(price * quantity, 2) AS gross_sales
  FROM dated)"""


_CLEAN = _ctes(_COLUMNS)
_DIRTY = _ctes(_dirty_columns())

_PERIOD = (
    "(SELECT * FROM sales WHERE order_year IN (1996, 1997, 1998) "
    "AND order_month IN (1, 2, 3, 4, 5, 6))"
)
_DATED = "(SELECT * FROM sales WHERE order_year IS NOT NULL AND order_month IS NOT NULL)"
_REVENUE = "coalesce(sum(revenue::DECIMAL(18,2)), 0)::DOUBLE AS total_revenue"
_QUANTITY = "coalesce(sum(quantity), 0)::BIGINT AS total_quantity"
_LABEL = "order_year || '-' || lpad(order_month::VARCHAR, 2, '0') AS year_month"


def _unique(column: str, name: str) -> str:
    return (
        f"count(DISTINCT {column}) + coalesce(max(({column} IS NULL)::INTEGER), 0)::BIGINT"
        f" AS {name}"
    )


_DIMENSIONS = """,
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id, customer_name NULLS LAST, segment NULLS LAST)
    AS customer_key, *
  FROM (SELECT DISTINCT customer_id, customer_name, segment FROM sales
        WHERE customer_id IS NOT NULL)),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id, product_name NULLS LAST, category NULLS LAST,
    sub_category NULLS LAST, base_price NULLS LAST) AS product_key, *
  FROM (SELECT DISTINCT product_id, product_name, category, sub_category, price AS base_price
        FROM sales WHERE product_id IS NOT NULL)),
dim_location AS (
  SELECT row_number() OVER (ORDER BY region NULLS LAST, state NULLS LAST, city NULLS LAST,
    postal_code NULLS LAST) AS location_key, *
  FROM (SELECT DISTINCT city, state, postal_code, region FROM sales WHERE city IS NOT NULL)),
dim_date AS (
  SELECT strftime(day, '%Y%m%d')::INTEGER AS date_key, day::DATE AS date,
    year(day)::INTEGER AS year, month(day)::INTEGER AS month, strftime(day, '%B') AS month_name
  FROM (SELECT unnest(generate_series(
          (SELECT min(order_date) FROM sales)::TIMESTAMP,
          (SELECT max(order_date) FROM sales)::TIMESTAMP, INTERVAL 1 DAY)) AS day))"""

_FACT = """,
fact_sales AS (
  SELECT row_id AS sales_key, order_id, customer_key, product_key, location_key,
    strftime(order_date, '%Y%m%d')::INTEGER AS order_date_key,
    strftime(ship_date, '%Y%m%d')::INTEGER AS ship_date_key,
    ship_mode, revenue AS sales_amount, quantity, discount, discount_amount, gross_sales,
    price AS unit_price, date_diff('day', order_date, ship_date)::INTEGER AS ship_latency_days
  FROM sales s
  LEFT JOIN dim_customer dc ON s.customer_id = dc.customer_id
  LEFT JOIN dim_product dp ON s.product_id = dp.product_id
  LEFT JOIN dim_location dl
    ON s.city = dl.city AND s.state = dl.state AND s.postal_code = dl.postal_code)"""

_STAR = _ctes(_COLUMNS, row_id=True) + _DIMENSIONS + _FACT
_STAR_DIRTY = _ctes(_dirty_columns(), row_id=True) + _DIMENSIONS + _FACT

_STAR_TABLES = ("fact_sales", "dim_customer", "dim_product", "dim_location", "dim_date")

_COVERAGE = """
SELECT count(*) AS total_rows, count(customer_key) AS has_customer,
  count(product_key) AS has_product, count(location_key) AS has_location,
  count(order_date_key) AS has_order_date
FROM fact_sales"""


def _key_problems() -> str:
    checks = [
        ("dim_customer", "customer_key"),
        ("dim_customer", "customer_id"),
        ("dim_product", "product_key"),
        ("dim_product", "product_id"),
        ("dim_location", "location_key"),
        ("dim_location", "city, state, postal_code"),
        ("dim_date", "date_key"),
        ("sales", "row_id"),
    ]
    parts = []
    for table, keys in checks:
        complete = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
        parts.append(f"""
SELECT '{table}' AS table_name, '{keys}' AS key_columns,
  count(*) FILTER (WHERE n > 1 AND {complete}) AS duplicate_keys,
  coalesce(sum(n) FILTER (WHERE n > 1 AND {complete}), 0)::BIGINT AS duplicate_rows,
  coalesce(sum(n) FILTER (WHERE NOT ({complete})), 0)::BIGINT AS null_rows
FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY ALL)""")
    return " UNION ALL ".join(parts)


def _repeated_keys() -> str:
    parts = []
    for table, keys in [
        ("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_location", "city, state, postal_code")
    ]:
        same = " AND ".join(f"d.{k} = s.{k}" for k in keys.split(", "))
        value = "concat_ws('|', " + ", ".join(f"d.{k}" for k in keys.split(", ")) + ")"
        complete = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
        parts.append(f"""
SELECT '{table}' AS table_name, '{keys}' AS key_columns, {value} AS key_value, max(d.n) AS row_count,
  count(*) AS line_count, min(s.row_id) AS first_row_id, max(s.row_id) AS last_row_id
FROM (SELECT {keys}, count(*) AS n FROM {table} WHERE {complete} GROUP BY ALL HAVING count(*) > 1) d
JOIN sales s ON {same}
GROUP BY {value}""")
    return " UNION ALL ".join(parts)


_CHECKS = """,
failed AS (
  SELECT
    count(*) FILTER (WHERE order_id IS NULL) AS order_id_not_null,
    count(*) FILTER (WHERE customer_id IS NULL) AS customer_id_not_null,
    count(*) FILTER (WHERE price IS NULL) AS price_not_null,
    count(*) FILTER (WHERE order_date IS NULL) AS order_date_not_null,
    count(*) FILTER (WHERE NOT price > 0) AS sales_positive,
    count(*) FILTER (WHERE discount < 0 OR discount > 0.5) AS discount_in_range,
    count(*) FILTER (WHERE quantity < 1 OR quantity > 100) AS quantity_in_range,
    count(*) FILTER (WHERE order_year < (SELECT min(order_year) FROM sales)
      OR order_year > (SELECT max(order_year) FROM sales)) AS order_year_valid_range
  FROM sales),
checks AS (
  SELECT check_name, failed_rows, failed_rows = 0 AS passed
  FROM (UNPIVOT failed ON COLUMNS(*) INTO NAME check_name VALUE failed_rows)
  UNION ALL
  SELECT 'overall_success', count(*) FILTER (WHERE failed_rows > 0), bool_and(failed_rows = 0)
  FROM (UNPIVOT failed ON COLUMNS(*) INTO NAME check_name VALUE failed_rows))"""
_QUALITY = f"{_CHECKS} SELECT * FROM checks"

_AS_DAY = "try_strptime(order_date::VARCHAR, ['%Y-%m-%d', '%Y%m%d', '%Y/%m/%d', '%m/%d/%Y', '%b %-d %Y'])"
_NOT_READ = f"(SELECT count(*) FROM raw WHERE order_date IS NOT NULL AND {_AS_DAY} IS NULL)"

_SUMMARY_MEASURES = f"""{_REVENUE}, count(*) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers"""

_YEARLY = f"""
SELECT order_year, {_SUMMARY_MEASURES} FROM sales WHERE order_year IS NOT NULL GROUP BY ALL"""
_REGIONAL = f"""
SELECT region, {_SUMMARY_MEASURES} FROM sales WHERE region IS NOT NULL GROUP BY ALL"""
_TOP_PER_CATEGORY = f"""
SELECT category, product_name, total_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_name) AS n
  FROM (SELECT category, product_name, {_REVENUE} FROM sales
        WHERE category IS NOT NULL AND product_name IS NOT NULL GROUP BY ALL))
WHERE n <= 3"""


def _kpis(source: str) -> str:
    return f"""
SELECT {_REVENUE}, count(*) AS total_orders, {_QUANTITY},
  {_unique("customer_id", "unique_customers")}, {_unique("product_id", "unique_products")}
FROM {source}"""


def _short(column: str) -> str:
    return (
        f"CASE WHEN {column} >= 1e9 THEN format('{{:.1f}}B', {column} / 1e9) "
        f"WHEN {column} >= 1e6 THEN format('{{:.1f}}M', {column} / 1e6) "
        f"WHEN {column} >= 1e3 THEN format('{{:.1f}}K', {column} / 1e3) "
        f"ELSE format('{{:.0f}}', {column}::DOUBLE) END"
    )


_KPIS_TEXT = f""",
figures AS ({_kpis(_DATED)})
SELECT '$' || {_short("total_revenue")} AS total_revenue,
  {_short("total_orders")} AS total_orders,
  {_short("total_quantity")} AS total_quantity,
  {_short("unique_customers")} AS unique_customers,
  {_short("unique_products")} AS unique_products,
  CASE WHEN total_orders > 0 THEN format('{{:,}}', total_orders) END AS filtered_rows,
  CASE WHEN total_orders > 0 THEN format('${{:,.0f}}', total_revenue) END AS filtered_revenue
FROM figures"""


def _monthly(measure: str, *keys: str) -> str:
    columns = ", ".join(["order_year", "order_month", *keys])
    return f"SELECT {columns}, {measure}, {_LABEL} FROM {_DATED} GROUP BY {columns}"


_VOLUMES = f"{_REVENUE}, {_unique('order_id', 'total_orders')}, {_QUANTITY}"
_TOP_CUSTOMERS = f"""
SELECT customer_name, {_REVENUE} FROM {_DATED} GROUP BY ALL
ORDER BY total_revenue DESC, customer_name NULLS FIRST LIMIT 10"""
_CITIES = f"SELECT city, {_VOLUMES} FROM {_DATED} GROUP BY city"
_TOP_PRODUCTS = f"""
SELECT category, product_name, {_VOLUMES} FROM {_DATED} GROUP BY category, product_name
ORDER BY total_revenue DESC, category NULLS FIRST, product_name NULLS FIRST LIMIT 10"""
_REGION = f"SELECT region, {_REVENUE} FROM sales GROUP BY ALL"
_REGION_DATED = f"SELECT region, {_REVENUE} FROM {_DATED} GROUP BY ALL"

_MONEY_TEXT = "format('${:,.0f}', total_revenue) AS \"Revenue\""
_VOLUME_TEXT = (
    "format('{:,}', total_orders) AS \"Orders\", format('{:,}', total_quantity) AS \"Quantity\""
)

def _texts(values) -> str:
    return f"[{', '.join(f'{v!r}' for v in values)}]"


def _draw(group: str, place: int, choices: str, key: str = "row_id") -> str:
    """32 bits of an md5, modulo the choices."""
    return f"('0x' || substr(md5('42:{group}:' || {key}), {8 * place + 1}, 8))::BIGINT % ({choices})"


_PLACES = ", ".join(
    f"{{'city': {city!r}, 'state': {state!r}, 'prefix': {prefix!r}, 'region': {region!r}}}"
    for city, state, prefix, region in CITIES
)
_QUANTITY_LIMIT = "CASE category WHEN 'Furniture' THEN 2 WHEN 'Technology' THEN 12 ELSE 50 END"

# Synthetic lines: a row id for each event, the parts as catalog, as many customers as there are.
_SYNTHETIC = f"""
WITH products AS (
  SELECT p_type AS category, p_brand AS sub_category, {_PRODUCT_ID} AS product_id,
    p_name AS product_name, p_retailprice AS price,
    row_number() OVER (ORDER BY p_type, p_brand, {_PRODUCT_ID}, p_name, p_retailprice) AS product_no
  FROM part),
sub_categories AS (
  SELECT category, min(product_no) AS first_product, count(*) AS n_products,
    row_number() OVER (ORDER BY category, sub_category) AS sub_category_no
  FROM products GROUP BY category, sub_category),
categories AS (
  SELECT min(sub_category_no) AS first_sub_category, count(*) AS n_sub_categories,
    row_number() OVER (ORDER BY category) AS category_no
  FROM sub_categories GROUP BY category),
sizes AS (
  SELECT (SELECT count(*) FROM categories) AS n_categories, (SELECT count(*) FROM customer) AS n_customers,
    min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE - min(o_orderdate)::DATE + 1 AS n_days
  FROM orders),
in_category AS (
  SELECT row_id, first_sub_category + {_draw("product", 1, "n_sub_categories")} AS sub_category_no
  FROM (SELECT event_id + 1 AS row_id, 1 + {_draw("product", 0, "n_categories", "(event_id + 1)")} AS category_no
        FROM events, sizes)
  JOIN categories USING (category_no)),
in_sub_category AS (
  SELECT row_id, first_product + {_draw("product", 2, "n_products")} AS product_no
  FROM in_category JOIN sub_categories USING (sub_category_no)),
drawn AS (
  SELECT *, (row_id - 1) % n_customers AS customer,
    first_day + ({_draw("order", 0, "n_days")})::INTEGER AS order_date,
    [{_PLACES}][1 + {_draw("place", 0, str(len(CITIES)))}] AS place,
    (1 + {_draw("product", 3, _QUANTITY_LIMIT)})::INTEGER AS quantity
  FROM in_sub_category JOIN products USING (product_no), sizes),
named AS (
  SELECT *,
    {_texts(FIRST_NAMES)}[1 + {_draw("customer", 0, str(len(FIRST_NAMES)), "customer")}] AS first_name,
    {_texts(LAST_NAMES)}[1 + {_draw("customer", 1, str(len(LAST_NAMES)), "customer")}] AS last_name,
    {_texts(SEGMENTS)}[1 + {_draw("customer", 2, str(len(SEGMENTS)), "customer")}] AS segment
  FROM drawn)
SELECT row_id, 'US-' || year(order_date) || '-' || (100000 + {_draw("order", 3, "900000")}) AS order_id,
  order_date, order_date + 1 + ({_draw("order", 1, "7")})::INTEGER AS ship_date,
  {_texts(SHIP_MODES)}[1 + {_draw("order", 2, str(len(SHIP_MODES)))}] AS ship_mode,
  upper(left(first_name, 1) || left(last_name, 1)) || '-'
    || (10000 + (customer * 7919 + 42) % 90000 + customer // 90000 * 90000) AS customer_id,
  first_name || ' ' || last_name AS customer_name, segment,
  place.city AS city, place.state AS state, place.prefix || (10 + {_draw("place", 1, "90")}) AS postal_code,
  place.region AS region, category, sub_category, product_id, product_name, price, quantity,
  CASE WHEN quantity >= 100 THEN 0.15 WHEN quantity >= 20 THEN 0.10 WHEN quantity >= 5 THEN 0.05
    ELSE 0 END::DOUBLE AS discount
FROM named"""

# The same lines as the batch job makes them, numbered from 1, cleaned and enriched.
_JOB = f"""WITH sales AS (
  SELECT *, year(order_date)::INTEGER AS order_year, month(order_date)::INTEGER AS order_month,
    round_even(price * quantity * (1 - discount), 2) AS revenue
  FROM ({_SYNTHETIC.replace("(event_id + 1)", "event_id").replace("event_id + 1 AS", "event_id AS").replace(
      "FROM events, sizes", "FROM (SELECT row_number() OVER () AS event_id FROM events), sizes")}))"""

_NULLS_LEFT = " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL)"
    for c in (
        "order_id order_date ship_date ship_mode customer_id customer_name segment city state "
        "postal_code region category sub_category product_id product_name"
    ).split()
)

ORACLE: dict[str, str] = {
    "sales_view": f"{_CLEAN} SELECT * FROM raw",
    "dirty_sales_view": f"{_DIRTY} SELECT * FROM raw",
    "clean_numeric": f"{_DIRTY} SELECT order_id, product_id, price, quantity, discount FROM cleaned",
    "null_profile": f"""{_DIRTY}
SELECT count(*) FILTER (WHERE price IS NULL) AS price_nulls,
  count(*) FILTER (WHERE quantity IS NULL) AS quantity_nulls,
  count(*) FILTER (WHERE discount IS NULL) AS discount_nulls,
  {_NULLS_LEFT} AS remaining_nulls
FROM raw""",
    "parse_order_date": f"{_DIRTY} SELECT order_id, order_date, order_year, order_month FROM sales",
    "derive_metrics": f"{_CLEAN} SELECT * FROM sales",
    "derive_metrics_dirty": f"{_DIRTY} SELECT * FROM sales",
    "filter_year_month": f"{_CLEAN} SELECT * FROM {_PERIOD}",
    "filter_options": f"""{_CLEAN}
SELECT DISTINCT 'year' AS kind, order_year AS value, order_year::VARCHAR AS label FROM sales
UNION ALL
SELECT 'month', m::INTEGER, strftime(make_date(2000, m, 1), '%B') FROM range(1, 13) t(m)""",
    "drop_duplicates": f"""{_CLEAN}
SELECT DISTINCT order_id, order_date, ship_mode, customer_id, segment FROM raw""",
    "summary_yearly": _CLEAN + _YEARLY,
    "summary_regional": _CLEAN + _REGIONAL,
    "summary_top_products": _CLEAN + _TOP_PER_CATEGORY,
    "summary_segment_yearly": f"""{_CLEAN}
SELECT segment, order_year, {_SUMMARY_MEASURES} FROM sales
WHERE segment IS NOT NULL AND order_year IS NOT NULL GROUP BY ALL""",
    "summary_yearly_dirty": _DIRTY + _YEARLY,
    "summary_regional_dirty": _DIRTY + _REGIONAL,
    "quality_report": _CLEAN + _QUALITY,
    "quality_report_dirty": _DIRTY + _QUALITY,
    "quality_report_unread": _DIRTY + _QUALITY.replace(
        "AS order_date_not_null,", f"AS order_date_not_null, {_NOT_READ} AS order_date_readable,"
    ),
    "quality_report_partial": f"""{_DIRTY}{_CHECKS}
SELECT check_name, failed_rows, passed FROM checks
WHERE check_name IN ('order_id_not_null', 'customer_id_not_null', 'price_not_null', 'sales_positive', 'quantity_in_range')
UNION ALL
SELECT 'overall_success', count(*) FILTER (WHERE NOT passed), bool_and(passed) FROM checks
WHERE check_name IN ('order_id_not_null', 'customer_id_not_null', 'price_not_null', 'sales_positive', 'quantity_in_range')""",
    "unread_days": f"""{_DIRTY}
SELECT order_id, product_id, order_date AS order_date_unread FROM raw
WHERE order_date IS NOT NULL AND {_AS_DAY} IS NULL""",
    "summaries_partial": f"""{_CLEAN}
SELECT 'yearly' AS summary, count(DISTINCT order_year) AS "rows" FROM sales
UNION ALL SELECT 'top_products', count(*) FROM ({_TOP_PER_CATEGORY})""",
    "dim_customer": f"{_CLEAN}{_DIMENSIONS} SELECT * FROM dim_customer",
    "dim_product": f"{_CLEAN}{_DIMENSIONS} SELECT * FROM dim_product",
    "dim_location": f"{_CLEAN}{_DIMENSIONS} SELECT * FROM dim_location",
    "dim_location_dirty": f"{_DIRTY}{_DIMENSIONS} SELECT * FROM dim_location",
    "dim_date": f"{_CLEAN}{_DIMENSIONS} SELECT * FROM dim_date",
    "fact_sales": f"{_STAR} SELECT * FROM fact_sales",
    "fact_sales_dirty": f"{_STAR_DIRTY} SELECT * FROM fact_sales",
    "star_row_counts": f"{_STAR} SELECT "
    + ", ".join(f"(SELECT count(*) FROM {t}) AS {t}" for t in _STAR_TABLES)
    + ", (SELECT count(*) FROM sales) AS original_sales",
    "star_fk_coverage": _STAR + _COVERAGE,
    "star_fk_coverage_dirty": _STAR_DIRTY + _COVERAGE,
    "star_pk_violations": _STAR + _key_problems(),
    "star_pk_violations_dirty": _STAR_DIRTY + _key_problems(),
    "star_ship_date_gap": f"""{_STAR}
SELECT ship_date_key, count(*) AS line_count FROM fact_sales
WHERE ship_date_key NOT IN (SELECT date_key FROM dim_date) GROUP BY ALL""",
    "star_revenue_by_month": f"""{_STAR}
SELECT year, month, month_name, sum(sales_amount::DECIMAL(18,2))::DOUBLE AS revenue
FROM fact_sales JOIN dim_date ON order_date_key = date_key GROUP BY ALL""",
    "dim_customer_first": f"{_STAR} SELECT * FROM dim_customer ORDER BY customer_key LIMIT 10",
    "dim_attribute_filter": f"{_STAR} SELECT * FROM dim_product WHERE category = 'PROMO'",
    "dim_location_region": f"{_STAR} SELECT * FROM dim_location WHERE region = 'ASIA'",
    "dim_date_year": f"{_STAR} SELECT * FROM dim_date WHERE year = 1997",
    "fact_sales_first": f"{_STAR} SELECT * FROM fact_sales ORDER BY sales_key LIMIT 10",
    "panel_kpis": _CLEAN + _kpis(_DATED),
    "panel_kpis_period": _CLEAN + _kpis(_PERIOD),
    "panel_kpis_dirty": _DIRTY + _kpis(_DATED),
    "panel_kpis_text": _CLEAN + _KPIS_TEXT,
    "panel_revenue_by_month": f"{_CLEAN} {_monthly(_REVENUE)}",
    "panel_orders_by_month": f"{_CLEAN} {_monthly('count(order_id) AS total_orders')}",
    "panel_segment_by_month": f"{_CLEAN} {_monthly(_REVENUE, 'segment')}",
    "panel_top_customers": _CLEAN + _TOP_CUSTOMERS,
    "panel_top_customers_text": f"""{_CLEAN}
SELECT customer_name AS "Customer", {_MONEY_TEXT} FROM ({_TOP_CUSTOMERS})""",
    "panel_cities": f"{_CLEAN} {_CITIES}",
    "panel_cities_text": f"""{_CLEAN}
SELECT city AS "City", {_MONEY_TEXT}, {_VOLUME_TEXT} FROM ({_CITIES})""",
    "panel_region": f"{_CLEAN} {_REGION}",
    "panel_region_dirty": f"{_DIRTY} {_REGION}",
    "panel_category_by_month": f"{_CLEAN} {_monthly(_REVENUE, 'category')}",
    "panel_top_products": _CLEAN + _TOP_PRODUCTS,
    "panel_top_products_text": f"""{_CLEAN}
SELECT category AS "Category", product_name AS "Product", {_MONEY_TEXT}, {_VOLUME_TEXT}
FROM ({_TOP_PRODUCTS})""",
    "cube_segment_by_month": f"{_CLEAN} {_monthly(_REVENUE, 'segment')}",
    "cube_orders_by_month": f"{_CLEAN} {_monthly('count(order_id) AS total_orders')}",
    "cube_region_dirty": f"{_DIRTY} {_REGION_DATED}",
    "sample_rows": f"{_ctes(_COLUMNS, row_id=True)} SELECT * FROM sales ORDER BY row_id LIMIT 50",
    "catalog_flatten": f"""
SELECT p_type AS category, p_brand AS sub_category, p_name AS product_name,
  p_retailprice AS price, {_PRODUCT_ID} AS product_id
FROM part""",
    "catalog_nesting": """
SELECT categories, sub_categories, products, count(*) AS documents
FROM (
  SELECT count(DISTINCT p_type)::INTEGER AS categories,
    count(DISTINCT p_type || '|' || p_brand)::INTEGER AS sub_categories, count(*)::INTEGER AS products
  FROM part GROUP BY p_partkey // 500)
GROUP BY ALL""",
    "synth_sales": _SYNTHETIC,
    "synth_contract": """
SELECT (SELECT count(*) FROM events) AS "rows",
  (SELECT least((SELECT count(*) FROM customer), (SELECT count(*) FROM events))) AS customers,
  0::BIGINT AS broken_ship_latency, 0::BIGINT AS broken_quantity, 0::BIGINT AS broken_discount,
  0::BIGINT AS broken_order_id, 0::BIGINT AS broken_customer_id, 0::BIGINT AS broken_postal_code,
  0::BIGINT AS broken_price, 0::BIGINT AS broken_order_date, 0::BIGINT AS broken_product,
  0::BIGINT AS broken_ship_mode, 0::BIGINT AS broken_segment, 0::BIGINT AS broken_place""",
    "synth_rotation": """
SELECT events // least(events, customers) AS fewest,
  (events + least(events, customers) - 1) // least(events, customers) AS most
FROM (SELECT (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM customer) AS customers)""",
    "summary_csv_roundtrip": _CLEAN + _TOP_PER_CATEGORY,
    "silver_roundtrip": f"{_CLEAN} SELECT * FROM sales",
    "sample_csv_roundtrip": f"{_ctes(_COLUMNS, row_id=True)} "
    "SELECT * FROM sales ORDER BY row_id LIMIT 50",
    "quality_json_roundtrip": f"{_DIRTY}{_CHECKS} SELECT check_name, passed FROM checks",
    "warehouse_sql": f"""{_STAR}
SELECT d.year, d.month, d.month_name, p.category,
  sum(f.sales_amount::DECIMAL(18,2))::DOUBLE AS revenue
FROM fact_sales f
JOIN dim_date d ON f.order_date_key = d.date_key
JOIN dim_product p ON f.product_key = p.product_key
GROUP BY ALL""",
    "stored_star_sql": f"""{_STAR}
SELECT l.region, d.year, count(*) AS line_count,
  sum(f.sales_amount::DECIMAL(18,2))::DOUBLE AS revenue,
  sum(s.revenue::DECIMAL(18,2))::DOUBLE AS sales_revenue
FROM fact_sales f
JOIN dim_location l ON f.location_key = l.location_key
JOIN dim_date d ON f.order_date_key = d.date_key
JOIN sales s ON f.sales_key = s.row_id
GROUP BY ALL""",
    "stored_panel_kpis": _CLEAN + _kpis(_PERIOD),
    "stored_panel_cities": f"{_CLEAN} {_CITIES.replace(_DATED, _PERIOD)}",
    "stored_panel_empty": _CLEAN + _kpis("(SELECT * FROM sales WHERE false)"),
    "star_refused_dirty": _STAR_DIRTY + _repeated_keys(),
    "batch_regional": f"{_JOB} {_REGIONAL}",
    "batch_reuse_yearly": f"{_JOB} {_YEARLY}",
    "batch_quality": f"{_JOB}{_CHECKS} SELECT check_name, passed FROM checks",
    "dashboard_kpis": _CLEAN + _kpis(_PERIOD),
    "dashboard_kpis_dirty": _DIRTY + _kpis(_DATED),
    "dashboard_empty": _CLEAN + _kpis("(SELECT * FROM sales WHERE false)"),
    "dashboard_cities": f"{_CLEAN} {_CITIES.replace(_DATED, _PERIOD)}",
    "dashboard_top_products_dirty": _DIRTY + _TOP_PRODUCTS,
    "dashboard_top_customers": _CLEAN + _TOP_CUSTOMERS.replace(_DATED, _PERIOD),
    "dashboard_category_by_month_dirty": f"{_DIRTY} {_monthly(_REVENUE, 'category')}",
    "panel_cities_dirty": f"{_DIRTY} {_CITIES}",
    "panel_top_products_dirty": _DIRTY + _TOP_PRODUCTS,
    "panel_category_by_month_dirty": f"{_DIRTY} {_monthly(_REVENUE, 'category')}",
    "unrounded_revenue": """
SELECT l_returnflag,
  round_even(sum((l_extendedprice * (1 - l_discount))::DECIMAL(18,6))::DOUBLE, 2) AS revenue
FROM lineitem GROUP BY l_returnflag""",
    "warehouse_tables": f"{_STAR} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _STAR_TABLES
    ),
}
