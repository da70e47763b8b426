"""SQL for the same results, written from the raw tables for DuckDB."""

from __future__ import annotations

_USD = "DECIMAL(22,2)"


def _mean(x: str) -> str:
    """Mean of non-negative money in whole cents, half up."""
    return (
        f"CAST(((2 * CAST(SUM({x} * 100) AS BIGINT) + COUNT({x})) // (2 * COUNT({x}))) / 100.0 "
        "AS DECIMAL(18,2))"
    )


_PART = """
part_c AS (
  SELECT p_partkey AS product_id, p_name AS name, lower(p_type) AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price_usd,
         CAST(p_size / 10.0 AS DECIMAL(3,2)) AS rating_rate,
         CAST(p_size * 10 AS INTEGER) AS rating_count
  FROM part)"""

_CUSTOMER = """
customer_c AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         n_name AS city,
         CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5
              THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS zipcode,
         CAST(n_nationkey * 2.5 - 30 AS DECIMAL(9,6)) AS lat,
         CAST(n_nationkey * 7 - 84 AS DECIMAL(9,6)) AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _calendar(days: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
         CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS "quarter",
         CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS "day", CAST(isodow(d) - 1 AS INTEGER) AS weekday_num,
         dayname(d) AS weekday_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT {days})"""


_DATE = f"date_c AS ({_calendar('CAST(o_orderdate AS DATE) AS d FROM orders')})"

_FACT = """
fact_c AS (
  SELECT o_orderkey AS order_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
         l_partkey AS product_id, o_custkey AS customer_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price_usd,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(12,2))
           AS total_usd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_BAD_DATE = "(o_orderkey % 97 = 0 OR o_orderkey % 101 = 0 OR o_orderkey % 103 = 0)"

# Lines of the faulty feed with a readable date, before any is turned away.
_STAGED = f"""
dirty_line AS (
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN l_partkey % 89 = 0 THEN -1 ELSE l_partkey END AS product_id,
         CASE WHEN o_orderkey % 79 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN l_partkey % 83 = 0 THEN 1 WHEN l_partkey % 73 = 0 THEN NULL
              ELSE CAST(l_quantity AS INTEGER) END AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE NOT {_BAD_DATE}),
staged AS (
  SELECT order_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id,
         CAST(product_id AS BIGINT) AS product_id, customer_id,
         CAST(quantity AS INTEGER) AS quantity,
         CAST(CASE WHEN product_id = -1 THEN 0
              WHEN product_id % 50 = 0 THEN CAST(p_retailprice AS DECIMAL(10,2)) + 1
              WHEN product_id % 61 = 0 THEN NULL
              ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DECIMAL(10,2)) AS unit_price_usd
  FROM dirty_line LEFT JOIN part ON product_id = p_partkey),
loaded AS (
  SELECT *, CAST(unit_price_usd * quantity AS DECIMAL(12,2)) AS total_usd FROM staged
  WHERE customer_id IS NOT NULL AND quantity IS NOT NULL AND unit_price_usd IS NOT NULL)"""

# The faulty lines that were loaded, and the clean ones.
_BOTH_LOADS = """
both_loads AS (
  SELECT order_id, date_id, quantity, total_usd FROM loaded
  UNION ALL SELECT order_id, date_id, quantity, total_usd FROM fact_c)"""

_PRICED = """
entry AS (
  SELECT p_partkey AS product_id, 0 AS nth,
         CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(10,2)) END
           AS price_usd FROM part
  UNION ALL
  SELECT p_partkey, 1, CAST(p_retailprice AS DECIMAL(10,2)) + 1 FROM part WHERE p_partkey % 50 = 0)"""

# Customers of the faulty feed: whether the address object is there, and the latitude text.
_DIRTY_USER = """
dirty_user AS (
  SELECT *, NOT (customer_id % 5 = 0 OR customer_id % 29 = 0) AS placed,
         CASE WHEN customer_id % 13 = 0 OR customer_id % 17 = 0 OR customer_id % 19 = 0 THEN 0
              WHEN customer_id % 23 = 0 THEN NULL ELSE lat END AS read_lat
  FROM customer_c)"""

_CURRENCY = """
currency_c AS (
  SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS currency_id,
         'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS currency_code,
         CAST(round(10.0 / n_nationkey, 8) AS DECIMAL(18,8)) AS rate_to_usd
  FROM nation WHERE n_nationkey <> 0)"""

_COUNTRY = """
country_c AS (
  SELECT c_custkey AS customer_id, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
         n_name AS country, r_name AS region,
         'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS currency_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _daily(fact: str, date_cte: str) -> str:
    return f"""
SELECT full_date, "year", month_name, weekday_name, is_weekend,
       CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold,
       CAST(SUM(total_usd) AS {_USD}) AS revenue_usd,
       {_mean('total_usd')} AS avg_order_value_usd
FROM {fact} JOIN {date_cte} USING (date_id)
GROUP BY full_date, "year", month_name, weekday_name, is_weekend"""


_DIRTY_DATE = (
    "date_d AS ("
    + _calendar(f"CAST(o_orderdate AS DATE) AS d FROM orders WHERE NOT {_BAD_DATE}")
    + ")"
)

_LINE_TOTALS = f"""COUNT(*) AS lines, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd"""

_REASONS = {
    "customer_id: missing": "customer_id IS NULL",
    "quantity: missing": "quantity IS NULL",
    "unit_price_usd: missing": "unit_price_usd IS NULL",
    "total_usd: missing": "quantity IS NULL OR unit_price_usd IS NULL",
}

_WEEK = f"""
SELECT "year", week_num, week_start, total_orders, revenue_usd,
       CAST(SUM(revenue_usd) OVER (ORDER BY "year", week_num
            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS {_USD}) AS rolling_4wk_revenue_usd
FROM (SELECT CAST(year(d) AS INTEGER) AS "year", CAST(weekofyear(d) AS INTEGER) AS week_num,
             MIN(d) AS week_start, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
             CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
      FROM dated GROUP BY 1, 2)"""

_KEPT_PRODUCTS = (
    "kept AS (SELECT product_id, price_usd FROM (SELECT *, row_number() OVER "
    "(PARTITION BY product_id ORDER BY nth DESC) AS r FROM entry WHERE price_usd IS NOT NULL) WHERE r = 1)"
)

# Gold over the faulty feed: its products and customers.
_GOLD_DIRTY = (
    _PART,
    _CUSTOMER,
    _DIRTY_USER,
    _STAGED,
    _PRICED,
    _KEPT_PRODUCTS,
    _DIRTY_DATE,
    """
product_d AS (
  SELECT product_id, name, category, CAST(kept.price_usd AS DECIMAL(10,2)) AS price_usd, rating_rate
  FROM part_c JOIN kept USING (product_id)),
customer_d AS (
  SELECT customer_id, first_name, CASE WHEN customer_id % 11 = 0 THEN '' ELSE last_name END AS last_name,
         CASE WHEN customer_id % 7 <> 0 THEN email END AS email,
         CASE WHEN placed THEN city ELSE '' END AS city,
         CAST(CASE WHEN placed THEN read_lat ELSE 0 END AS DECIMAL(9,6)) AS lat,
         CAST(CASE WHEN placed THEN lon ELSE 0 END AS DECIMAL(9,6)) AS lon, placed
  FROM dirty_user WHERE NOT placed OR read_lat IS NOT NULL)""",
)


def _by_category(fact: str, product: str) -> str:
    return f"""
SELECT category, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd,
       {_mean(product + '.price_usd')} AS avg_product_price_usd, {_mean('rating_rate')} AS avg_rating
FROM {fact} JOIN {product} USING (product_id) GROUP BY category"""


def _top(fact: str, product: str) -> str:
    return f"""
SELECT product_id, name AS product_name, category, price_usd, units_sold, revenue_usd, revenue_rank
FROM (SELECT product_id, units_sold, revenue_usd, name, category, p.price_usd,
             CAST(rank() OVER (ORDER BY revenue_usd DESC) AS INTEGER) AS revenue_rank
      FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units_sold,
                   CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
            FROM {fact} GROUP BY product_id) JOIN {product} p USING (product_id))
WHERE revenue_rank <= 10"""


def _by_city(fact: str, customer: str) -> str:
    return f"""
SELECT city, lat, lon, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM {fact} JOIN {customer} USING (customer_id) GROUP BY city, lat, lon"""


def _ltv(fact: str, customer: str, dates: str) -> str:
    return f"""
SELECT customer_id, first_name || ' ' || last_name AS full_name, email, city,
       CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS total_units,
       CAST(SUM(total_usd) AS {_USD}) AS lifetime_value_usd,
       MIN(full_date) AS first_order_date, MAX(full_date) AS last_order_date,
       CAST(date_diff('day', MIN(full_date), MAX(full_date)) AS INTEGER) AS customer_tenure_days
FROM {fact} JOIN {customer} USING (customer_id) JOIN {dates} USING (date_id)
GROUP BY customer_id, first_name, last_name, email, city"""


def _dated(fact: str, dates: str) -> str:
    return f"dated AS (SELECT full_date AS d, order_id, total_usd FROM {fact} JOIN {dates} USING (date_id))"


ORACLE: dict[str, str] = {
    "dim_product": _with(_PART) + "SELECT * FROM part_c",
    "dim_customer": _with(_CUSTOMER) + "SELECT * FROM customer_c",
    "dim_date": _with(_DATE) + "SELECT * FROM date_c",
    "dim_currency": _with(_CURRENCY) + "SELECT * FROM currency_c",
    "fact_orders": _with(_FACT) + "SELECT * FROM fact_c",
    "fact_orders_dirty": _with(_STAGED) + "SELECT * FROM loaded",
    "dim_date_dirty": _with(_DIRTY_DATE) + "SELECT date_id, full_date FROM date_d",
    "lookup_join_default": """
SELECT l_orderkey AS order_id,
       CAST(CASE WHEN l_partkey % 89 = 0 THEN -1 ELSE l_partkey END AS BIGINT) AS product_id,
       CAST(CASE WHEN l_partkey % 89 = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(10,2))
         AS unit_price_usd
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "lookup_last_wins": _with(_PRICED) + """
SELECT product_id, CAST(arg_max(price_usd_or_gap, nth) AS DECIMAL(10,2)) AS price_usd
FROM (SELECT product_id, nth, coalesce(price_usd, -1) AS price_usd_or_gap FROM entry)
GROUP BY product_id HAVING arg_max(price_usd_or_gap, nth) >= 0
UNION ALL
SELECT p_partkey, NULL FROM part WHERE p_partkey % 61 = 0 AND p_partkey % 50 <> 0""",
    "category_normalise": "SELECT p_partkey AS product_id, lower(trim(p_type)) AS category FROM part",
    "struct_guard": """
SELECT p_partkey AS product_id,
       CASE WHEN p_size % 5 <> 0 AND p_size % 7 <> 0 THEN CAST(p_size / 10.0 AS DECIMAL(3,2)) END
         AS rating_rate,
       CASE WHEN p_size % 5 <> 0 AND p_size % 7 <> 0 THEN CAST(p_size * 10 AS BIGINT) END
         AS rating_count
FROM part""",
    "nested_default": _with(_CUSTOMER, _DIRTY_USER) + """
SELECT customer_id, first_name, CASE WHEN customer_id % 11 = 0 THEN '' ELSE last_name END AS last_name,
       CASE WHEN customer_id % 7 <> 0 THEN email END AS email,
       CASE WHEN placed THEN city ELSE '' END AS city,
       CASE WHEN placed THEN zipcode ELSE '' END AS zipcode
FROM dirty_user""",
    "numeric_default": _with(_CUSTOMER, _DIRTY_USER) + """
SELECT customer_id,
       CAST(CASE WHEN placed THEN read_lat ELSE 0 END AS DECIMAL(18,6)) AS lat,
       CAST(CASE WHEN placed THEN lon ELSE 0 END AS DECIMAL(18,6)) AS lon
FROM dirty_user""",
    "date_parse_lenient": f"""
SELECT o_orderkey AS order_id, CASE WHEN NOT {_BAD_DATE} THEN CAST(o_orderdate AS DATE) END AS "day"
FROM orders""",
    "date_key": """
SELECT CAST(l_shipdate AS DATE) AS full_date,
       CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id, COUNT(*) AS lines
FROM lineitem GROUP BY 1, 2""",
    "calendar_parts": _calendar("CAST(l_shipdate AS DATE) AS d FROM lineitem"),
    "map_explode_rates": """
SELECT n_nationkey AS pos, 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code,
       CAST(n_nationkey / 10.0 AS DECIMAL(9,2)) AS rate FROM nation""",
    "reciprocal_rate": _with(_CURRENCY) + "SELECT * FROM currency_c",
    "array_explode_items": _with(_STAGED)
    + 'SELECT order_id, customer_id, d AS "day", CAST(product_id AS BIGINT) AS product_id, '
    "CAST(quantity AS INTEGER) AS quantity FROM dirty_line",
    "bronze_roundtrip": _with(_FACT) + "SELECT * FROM fact_c",
    "bronze_lines_roundtrip": _with(_PART, _PRICED, _KEPT_PRODUCTS) + """
SELECT product_id, name, category, CAST(kept.price_usd AS DECIMAL(10,2)) AS price_usd,
       rating_rate, rating_count
FROM part_c JOIN kept USING (product_id)""",
    "bronze_documents_roundtrip": _with(_FACT) + "SELECT * FROM fact_c",
    "bronze_document_bytes": r"""
SELECT sha256(body) AS body_sha256, strlen(body) AS bytes
FROM (SELECT '{ "a":[1.10, {"b":"]}, \\\" [{"}],' || chr(9) || '"id":' || o_orderkey || ' }' AS body FROM orders)""",
    "bronze_unreadable": """
SELECT 'products' AS source, COUNT(*) AS rows FROM part WHERE p_partkey % 97 = 0
UNION ALL SELECT 'carts', COUNT(*) FROM orders WHERE o_orderkey % 97 = 0
UNION ALL SELECT 'users', COUNT(*) FROM customer WHERE c_custkey % 97 = 0
UNION ALL SELECT 'countries', COUNT(*) FROM nation WHERE n_nationkey % 97 = 0
UNION ALL SELECT 'fx_rates', 0""",
    "silver_roundtrip": _with(_PART) + "SELECT * FROM part_c",
    "load_by_name": """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price_usd, CAST(NULL AS DECIMAL(3,2)) AS rating_rate,
       CAST(p_size * 10 AS INTEGER) AS rating_count
FROM part""",
    "load_rejects": _with(_STAGED)
    + " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, COUNT(*) AS rows FROM staged WHERE {test} HAVING COUNT(*) > 0"
        for reason, test in _REASONS.items()
    ),
    "reject_values": """
WITH product AS (
  SELECT 'products' AS source,
         concat_ws(', ', CASE WHEN p_partkey % 83 = 0 THEN 'product_id: not a whole number' END,
           CASE WHEN p_partkey % 59 = 0 THEN 'price_usd: not a number' END,
           CASE WHEN p_partkey % 67 = 0 THEN 'rating_rate: not a number' END,
           CASE WHEN p_partkey % 71 = 0 THEN 'rating_count: not a whole number' END) AS reasons,
         CASE WHEN p_partkey % 59 = 0 THEN 'n/a' ELSE '1.10' END AS price, CAST(NULL AS VARCHAR) AS quantity
  FROM part),
line AS (
  SELECT 'lines' AS source,
         concat_ws(', ', CASE WHEN l_partkey % 83 = 0 THEN 'product_id: not a whole number' END,
           CASE WHEN l_partkey % 59 = 0 OR l_partkey % 67 = 0 THEN 'quantity: not a whole number' END) AS reasons,
         CAST(NULL AS VARCHAR) AS price,
         CASE WHEN l_partkey % 59 = 0 THEN '2.7' WHEN l_partkey % 67 = 0 THEN 'true' ELSE '2' END AS quantity
  FROM lineitem)
SELECT source, reasons, price, quantity, COUNT(*) AS rows
FROM (SELECT * FROM product UNION ALL SELECT * FROM line) WHERE reasons <> '' GROUP BY ALL""",
    "load_summary": _with(_CUSTOMER, _DIRTY_USER, _STAGED, _PRICED, _KEPT_PRODUCTS, _DIRTY_DATE) + """,
counted AS (
  SELECT 'carts' AS table_name, COUNT(*) AS staged, COUNT(*) FILTER (NOT """ + _BAD_DATE + """) AS loaded,
         COUNT(*) FILTER (""" + _BAD_DATE + """) AS rejected FROM orders
  UNION ALL
  SELECT 'dim_product' AS table_name, (SELECT COUNT(*) FROM entry) AS staged,
         (SELECT COUNT(*) FROM kept) AS loaded,
         (SELECT COUNT(*) FROM entry WHERE price_usd IS NULL) AS rejected
  UNION ALL
  SELECT 'dim_customer', COUNT(*), COUNT(*) FILTER (NOT placed OR read_lat IS NOT NULL),
         COUNT(*) FILTER (placed AND read_lat IS NULL) FROM dirty_user
  UNION ALL SELECT 'dim_date', COUNT(*), COUNT(*), 0 FROM date_d
  UNION ALL SELECT 'dim_currency', COUNT(*), COUNT(*), 0 FROM nation WHERE n_nationkey <> 0
  UNION ALL
  SELECT 'fact_orders', (SELECT COUNT(*) FROM staged), (SELECT COUNT(*) FROM loaded),
         (SELECT COUNT(*) FROM staged) - (SELECT COUNT(*) FROM loaded))
SELECT table_name, staged, loaded, rejected, staged - loaded - rejected AS superseded FROM counted""",
    "full_refresh_twice": _with(_PART) + "SELECT * FROM part_c",
    "refresh_seen_by_readers": _with(_PRICED, _KEPT_PRODUCTS)
    + """
SELECT 'began before' AS reader, COUNT(*) AS products FROM kept
UNION ALL SELECT 'between', COUNT(*) FROM kept UNION ALL SELECT 'after', COUNT(*) FROM part""",
    "fact_replace_run": _with(_FACT, _STAGED)
    + f"SELECT DATE '2024-01-05' AS run_date, {_LINE_TOTALS} FROM loaded UNION ALL "
    f"SELECT DATE '2024-01-06', {_LINE_TOTALS} FROM fact_c",
    "fact_replace_run_empty": _with(_FACT)
    + f"SELECT DATE '2024-01-06' AS run_date, {_LINE_TOTALS} FROM fact_c",
    "views_after_reload": _with(_FACT, _STAGED)
    + """,
both_loads AS (SELECT quantity FROM loaded UNION ALL SELECT quantity FROM fact_c),
seen AS (SELECT COUNT(*) AS lines, CAST(SUM(quantity) AS BIGINT) AS units FROM both_loads)
SELECT 'view' AS shown, lines, units FROM seen UNION ALL SELECT 'catalog', lines, units FROM seen
UNION ALL SELECT 'report', units, units FROM seen""",
    "fact_snapshot": _with(_FACT) + f"SELECT DATE '2024-01-06' AS run_date, {_LINE_TOTALS} FROM fact_c",
    "fact_append_files_once": _with(_FACT, _STAGED)
    + f"SELECT DATE '2024-01-05' AS run_date, {_LINE_TOTALS} FROM loaded UNION ALL "
    f"SELECT DATE '2024-01-06', {_LINE_TOTALS} FROM fact_c",
    "fact_append_late_files": _with(_FACT, _STAGED)
    + """,
counted AS (
  SELECT (SELECT COUNT(*) FROM staged) AS s, (SELECT COUNT(*) FROM loaded) AS l, (SELECT COUNT(*) FROM fact_c) AS f)
SELECT 'call 1' AS what, f AS staged, f AS loaded, 0 AS rejected FROM counted
UNION ALL SELECT 'call 2', s, l, s - l FROM counted
UNION ALL SELECT 'call 3', 0, 0, 0
UNION ALL SELECT 'stored 2024-01-05', NULL, l, NULL FROM counted
UNION ALL SELECT 'stored 2024-01-06', NULL, f, NULL FROM counted""",
    "distinct_orders_merged": _with(_FACT, _PART, _DATE)
    + f""",
labelled AS (
  SELECT f.*, category, strftime(full_date, '%Y') || '-' || lpad(CAST(weekofyear(full_date) AS VARCHAR), 2, '0') AS week
  FROM fact_c f JOIN part_c USING (product_id) JOIN date_c USING (date_id)),
kinds AS (
  SELECT 'day' AS kind, CAST(date_id AS VARCHAR) AS label, * FROM labelled
  UNION ALL SELECT 'week', week, * FROM labelled UNION ALL SELECT 'category', category, * FROM labelled)
SELECT kind, label, COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS lines,
       CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM kinds GROUP BY kind, label""",
    "rpt_daily_incremental": _with(_FACT, _STAGED, _DATE, _BOTH_LOADS) + _daily("both_loads", "date_c"),
    "weekly_orders_incremental": _with(_FACT, _STAGED, _DATE, _BOTH_LOADS)
    + f"""
SELECT "year", CAST(weekofyear(full_date) AS INTEGER) AS week_num, COUNT(DISTINCT order_id) AS total_orders,
       CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM both_loads JOIN date_c USING (date_id) GROUP BY 1, 2""",
    "load_file_results": _with(_STAGED, _PRICED, _KEPT_PRODUCTS)
    + """,
line AS (
  SELECT 'fact_orders' AS table_name, CAST(order_id % 4 AS INTEGER) AS part,
         CASE WHEN customer_id IS NULL THEN 'customer_id: missing' WHEN quantity IS NULL THEN 'quantity: missing'
              WHEN unit_price_usd IS NULL THEN 'unit_price_usd: missing' END AS error,
         true AS last, order_id AS o1, product_id AS o2, quantity AS o3
  FROM staged
  UNION ALL
  SELECT 'dim_product', CAST(e.product_id % 2 AS INTEGER), CASE WHEN e.price_usd IS NULL THEN 'price_usd: missing' END,
         e.price_usd IS NOT NULL AND e.price_usd = k.price_usd, e.product_id, nth, 0
  FROM entry e LEFT JOIN kept k ON e.product_id = k.product_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, part ORDER BY o1 NULLS FIRST, o2 NULLS FIRST, o3 NULLS FIRST) - 1 AS nth_row
  FROM line)
SELECT table_name, part,
       CASE WHEN COUNT(error) = 0 THEN 'loaded' WHEN COUNT(error) < COUNT(*) THEN 'partly loaded' ELSE 'failed' END AS status,
       COUNT(*) AS staged, COUNT(*) FILTER (error IS NULL AND last) AS loaded, COUNT(error) AS rejected,
       COUNT(*) FILTER (error IS NULL AND NOT last) AS superseded,
       arg_min(error, nth_row) FILTER (error IS NOT NULL) AS first_error, MIN(nth_row) FILTER (error IS NOT NULL) AS first_error_row
FROM placed GROUP BY table_name, part""",
    "fact_insert_rows": _with(_FACT) + f"""
SELECT batch, COUNT(*) AS lines, COUNT(*) AS line_keys, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM fact_c, (VALUES ('rows-00000'), ('rows-00001')) AS b(batch) GROUP BY batch""",
    "fact_defaults": _with(_FACT)
    + "SELECT date_id, COUNT(*) AS lines, COUNT(*) AS units, COUNT(*) AS stamped FROM fact_c GROUP BY date_id",
    "line_key_unique": _with(_FACT, _STAGED)
    + """,
counted AS (
  SELECT (SELECT COUNT(*) FROM loaded) AS dirty, (SELECT COUNT(*) FROM fact_c) AS clean)
SELECT 'run' AS loaded_by, dirty + 2 * clean AS lines, dirty + 2 * clean AS line_keys, CAST(0 AS BIGINT) AS null_keys
FROM counted UNION ALL SELECT 'file', dirty + clean, dirty + clean, 0 FROM counted""",
    "load_timestamp": "SELECT COUNT(*) AS lines, COUNT(*) AS stamped_lines FROM lineitem",
    "fact_clustered_scan": _with(_FACT)
    + f"SELECT date_id, product_id, {_LINE_TOTALS} FROM fact_c GROUP BY date_id, product_id",
    "fact_sample": _with(_FACT)
    + "SELECT * FROM fact_c ORDER BY order_id, date_id, product_id, customer_id, quantity, unit_price_usd, total_usd LIMIT 5",
    "param_sql": _with(_PART)
    + "SELECT category, price_usd >= 950 AS is_dear, COUNT(*) AS products FROM part_c GROUP BY 1, 2",
    "rpt_daily_revenue": _with(_FACT, _DATE) + _daily("fact_c", "date_c"),
    "rpt_revenue_by_category": _with(_FACT, _PART) + _by_category("fact_c", "part_c"),
    "rpt_top_products": _with(_FACT, _PART) + _top("fact_c", "part_c"),
    "rpt_orders_by_city": _with(_FACT, _CUSTOMER) + _by_city("fact_c", "customer_c"),
    "rpt_customer_ltv": _with(_FACT, _CUSTOMER, _DATE) + _ltv("fact_c", "customer_c", "date_c"),
    "rpt_weekly_revenue": _with(_FACT, _DATE, _dated("fact_c", "date_c")) + _WEEK,
    "rpt_revenue_by_category_dirty": _with(*_GOLD_DIRTY) + _by_category("loaded", "product_d"),
    "rpt_top_products_dirty": _with(*_GOLD_DIRTY) + _top("loaded", "product_d"),
    "rpt_orders_by_city_dirty": _with(*_GOLD_DIRTY) + _by_city("loaded", "customer_d"),
    "rpt_customer_ltv_dirty": _with(*_GOLD_DIRTY) + _ltv("loaded", "customer_d", "date_d"),
    "rpt_weekly_revenue_dirty": _with(*_GOLD_DIRTY, _dated("loaded", "date_d")) + _WEEK,
    "rpt_orders_by_country_dirty": _with(*_GOLD_DIRTY) + f"""
SELECT CASE WHEN placed THEN n_name END AS country, CASE WHEN placed THEN r_name END AS region,
       CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM loaded JOIN customer_d USING (customer_id) JOIN customer ON customer_id = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "top_products_ties": f"""
SELECT product_id, revenue_usd, revenue_rank
FROM (SELECT l_partkey AS product_id, CAST(COUNT(*) AS {_USD}) AS revenue_usd,
             CAST(rank() OVER (ORDER BY COUNT(*) DESC) AS INTEGER) AS revenue_rank
      FROM lineitem GROUP BY l_partkey)
WHERE revenue_rank <= 10""",
    "rolling_four_rows": _with(
        _FACT,
        "dated AS (SELECT DATE '1995-01-01' + CAST(14 * date_diff('day', DATE '1995-01-01', "
        "CAST(o_orderdate AS DATE)) AS INTEGER) AS d, order_id, total_usd "
        "FROM fact_c JOIN orders ON order_id = o_orderkey)",
    )
    + _WEEK,
    "audit_duplicate_keys": """
SELECT 'dim_product' AS table_name, 'product_id' AS column_name,
       CAST(p_partkey AS VARCHAR) AS key_value, CAST(2 AS BIGINT) AS copies
FROM part WHERE p_partkey % 50 = 0""",
    "audit_nulls": _with(_STAGED)
    + " UNION ALL ".join(
        f"SELECT 'fact_orders' AS table_name, '{column}' AS column_name, "
        f"COUNT(*) FILTER ({test}) AS null_rows FROM staged"
        for column, test in (
            ("order_id", "order_id IS NULL"),
            ("date_id", "date_id IS NULL"),
            ("product_id", "product_id IS NULL"),
            ("customer_id", "customer_id IS NULL"),
            ("quantity", "quantity IS NULL"),
            ("unit_price_usd", "unit_price_usd IS NULL"),
            ("total_usd", "quantity IS NULL OR unit_price_usd IS NULL"),
        )
    ),
    "audit_orphans": _with(_CUSTOMER, _DIRTY_USER, _STAGED, _PRICED, _KEPT_PRODUCTS) + """
SELECT 'product_id' AS column_name, CAST(product_id AS BIGINT) AS key_value, COUNT(*) AS lines
FROM loaded WHERE product_id NOT IN (SELECT product_id FROM kept) GROUP BY product_id
UNION ALL
SELECT 'customer_id', customer_id, COUNT(*) FROM loaded
WHERE customer_id NOT IN
  (SELECT customer_id FROM dirty_user WHERE NOT placed OR read_lat IS NOT NULL)
GROUP BY customer_id""",
    "audit_row_counts": _with(_CUSTOMER, _DIRTY_USER, _STAGED, _PRICED, _KEPT_PRODUCTS, _DIRTY_DATE) + """
SELECT 'dim_product' AS table_name, COUNT(*) AS rows FROM kept
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dirty_user WHERE NOT placed OR read_lat IS NOT NULL
UNION ALL SELECT 'dim_date', COUNT(*) FROM date_d
UNION ALL SELECT 'dim_currency', COUNT(*) FROM nation WHERE n_nationkey <> 0
UNION ALL SELECT 'fact_orders', COUNT(*) FROM loaded""",
    "customer_country": _with(_COUNTRY) + "SELECT * FROM country_c",
    "revenue_in_currency": _with(_FACT, _COUNTRY, _CURRENCY) + f""",
revenue AS (
  SELECT country_c.currency_code, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
  FROM fact_c JOIN country_c USING (customer_id) GROUP BY country_c.currency_code),
local AS (
  SELECT revenue.currency_code, revenue_usd, rate_to_usd,
         CAST((2 * CAST(revenue_usd * 100 AS HUGEINT) * 100000000 + CAST(rate_to_usd * 100000000 AS HUGEINT))
              // (2 * CAST(rate_to_usd * 100000000 AS HUGEINT)) AS {_USD}) / 100 AS revenue_local
  FROM revenue LEFT JOIN currency_c USING (currency_code))
SELECT currency_code, revenue_usd, CAST(revenue_local AS {_USD}) AS revenue_local,
       CAST(round(CAST(revenue_local AS DECIMAL(20,2)) * rate_to_usd, 2) AS {_USD}) AS back_in_usd
FROM local""",
    "rpt_orders_by_country": _with(_FACT, _COUNTRY) + f"""
SELECT country, region, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(total_usd) AS {_USD}) AS revenue_usd
FROM fact_c JOIN country_c USING (customer_id) GROUP BY country, region""",
    "daily_run": _with(_STAGED, _DIRTY_DATE) + _daily("loaded", "date_d"),
}
