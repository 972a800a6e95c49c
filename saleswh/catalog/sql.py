"""Common table expressions shared by the check SQL."""

FLAT = """
flat AS (
  SELECT l_orderkey AS order_number, l_linenumber AS order_line_number,
         CAST(l_quantity AS INTEGER) AS quantity_ordered,
         l_extendedprice / l_quantity AS price_each,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS sales,
         CASE WHEN l_extendedprice < 30000 THEN 'Small'
              WHEN l_extendedprice < 70000 THEN 'Medium' ELSE 'Large' END AS deal_size,
         CAST(p_partkey AS VARCHAR) AS product_code, p_type AS product_line,
         CAST(p_retailprice AS DECIMAL(12,2)) AS msrp,
         c_name AS customer_name, CAST(NULL AS VARCHAR) AS city,
         NULLIF(c_mktsegment, 'BUILDING') AS state,
         n_name AS country, r_name AS territory,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(year(o_orderdate) AS INTEGER) AS year_id,
         CAST(month(o_orderdate) AS INTEGER) AS month_id,
         monthname(o_orderdate) AS month_name,
         CAST(quarter(o_orderdate) AS INTEGER) AS qtr_id,
         dayname(o_orderdate) AS day_of_week
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

CUSTOMER_HISTORY = """
customer_history AS (
  SELECT c_custkey AS customer_id, c_name AS name, 'CITY_' || CAST(c_nationkey AS VARCHAR) AS city,
         TIMESTAMP '1995-01-01 00:00:00' AS valid_from,
         CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '1998-01-01 00:00:00' END AS valid_to
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, 'CITY_' || CAST(c_nationkey + 1 AS VARCHAR),
         TIMESTAMP '1998-01-01 00:00:00', NULL
  FROM customer WHERE c_mktsegment = 'BUILDING'
)"""

PRICE_HISTORY = """
price_history AS (
  SELECT p_partkey AS product_id, p_name AS name,
         CAST(p_retailprice + 10 * k AS DECIMAL(10,2)) AS price,
         CAST(make_date(1995 + 2 * k, 1, 1) AS TIMESTAMP) AS valid_from,
         CASE WHEN k < 3 THEN CAST(make_date(1997 + 2 * k, 1, 1) AS TIMESTAMP) END AS valid_to
  FROM part CROSS JOIN (SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS k) AS steps
)"""

AS_OF_ORDERS = f"""
{CUSTOMER_HISTORY},
{PRICE_HISTORY},
order_facts AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, product_id, o_orderdate AS order_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount
  FROM orders
  JOIN (SELECT l_orderkey, min(l_partkey) AS product_id FROM lineitem GROUP BY l_orderkey) AS firsts
    ON l_orderkey = o_orderkey
),
as_of AS (
  SELECT order_id, order_date, f.customer_id, c.name AS customer_name, c.city AS customer_city,
         f.product_id, p.name AS product_name, p.price AS product_price, amount
  FROM order_facts f
  JOIN customer_history c ON c.customer_id = f.customer_id AND order_date >= c.valid_from
   AND (c.valid_to IS NULL OR order_date < c.valid_to)
  JOIN price_history p ON p.product_id = f.product_id AND order_date >= p.valid_from
   AND (p.valid_to IS NULL OR order_date < p.valid_to)
)"""

# priority dimension: changes collapsed per instant, no-ops dropped, chained
PRIORITY_VERSIONS = """
start_rows AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey AS customer_id, c_name AS name,
         '3-MEDIUM' AS priority, TIMESTAMP '1995-01-01 00:00:00' AS ts
  FROM customer
),
batch AS (
  SELECT o_custkey AS customer_id, o_orderdate AS ts, arg_max(o_orderpriority, o_orderkey) AS priority
  FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01 00:00:00'
  GROUP BY o_custkey, o_orderdate
),
timeline AS (
  SELECT id, customer_id, ts, priority FROM start_rows
  UNION ALL SELECT NULL, customer_id, ts, priority FROM batch
),
marked AS (
  SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY ts) AS before FROM timeline
),
kept AS (
  SELECT *, lead(ts) OVER (PARTITION BY customer_id ORDER BY ts) AS ends
  FROM marked WHERE before IS NULL OR before <> priority
),
versions AS (
  SELECT CASE WHEN k.id IS NOT NULL THEN k.id
              ELSE (SELECT max(id) FROM start_rows)
                   + row_number() OVER (PARTITION BY k.id IS NULL ORDER BY k.ts, k.customer_id) END AS id,
         k.customer_id, s.name, k.priority, k.ts AS valid_from, k.ends AS valid_to,
         k.ends IS NULL AS is_current
  FROM kept k JOIN start_rows s ON s.customer_id = k.customer_id
)"""

EVENT_HISTORY = """
entries AS (
  SELECT user_id, ts, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id, ts
),
changes AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM entries
),
history AS (
  SELECT user_id, event_type, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM changes WHERE before IS NULL OR before <> event_type
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + " "
