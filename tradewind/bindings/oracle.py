"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

from ..schemas import MEANINGS, TABLES

ORACLE: dict[str, str] = {}

# Common table expressions shared by several queries. Money is summed as
# DECIMAL and returned as DOUBLE, dates as text, whole numbers as BIGINT.
ITEMS = """items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_tax AS DECIMAL(18,2)) AS freight
    FROM lineitem)"""
PRODUCT_REVENUE = f"""{ITEMS}, revenue AS (
    SELECT p_brand AS category_name, product_id, sum(price) AS revenue
    FROM items JOIN part ON p_partkey = product_id GROUP BY ALL)"""
CUSTOMER_TOTALS = """totals AS (
    SELECT c_custkey AS customer_id, c_nationkey AS customer_state, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_spent
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def _date(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


# --- scans, sinks, row counts ------------------------------------------------

ORACLE["scan_table"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

STG_ORDERS = """stg_orders AS (
    SELECT CASE WHEN o_orderkey % 101 = 0 THEN '  ' ELSE ' ' || o_orderkey END AS order_id,
           CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE o_custkey || ' ' END AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN ' Delivered' WHEN 'O' THEN 'SHIPPED ' ELSE 'lost' END AS order_status,
           CASE WHEN o_orderkey % 89 = 0 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M')
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_purchase_timestamp,
           CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_approved_at,
           CASE WHEN o_orderkey % 83 = 0 THEN '2018-02-31 10:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END
               AS order_delivered_carrier_date,
           CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(o_orderdate + INTERVAL 20 DAY, '%Y-%m-%d %H:%M:%S') END
               AS order_delivered_customer_date,
           strftime(o_orderdate + INTERVAL 20 DAY, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
    FROM orders)"""

# Empty text is written as "" and stays empty text.
ORACLE["scan_csv_staging"] = f"WITH {STG_ORDERS} SELECT * FROM stg_orders"

ORACLE["scan_csv_multiline"] = """
SELECT ' r' || doc_id AS review_id, CAST(doc_id AS VARCHAR) AS order_id, text AS review_comment_message FROM documents"""

ORACLE["scan_csv_malformed"] = """
SELECT 'read' AS tbl, count(*) FILTER (WHERE l_partkey % 5 <> 0 AND l_partkey % 7 <> 0) AS cnt FROM lineitem
UNION ALL
SELECT 'set aside', count(*) FILTER (WHERE l_partkey % 5 = 0 OR l_partkey % 7 = 0) FROM lineitem"""

ORACLE["scan_repaired_lines"] = """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line"""

ORACLE["rowcount_staging"] = """
SELECT 'stg_orders' AS tbl, count(*) AS cnt FROM orders
UNION ALL SELECT 'stg_order_items', count(*) FROM lineitem
UNION ALL SELECT 'stg_products', count(*) FROM part
UNION ALL SELECT 'stg_sellers', 2 * count(*) FROM supplier
UNION ALL SELECT 'stg_order_payments', count(*) FROM orders
UNION ALL SELECT 'stg_order_reviews', count(*) FROM documents
UNION ALL SELECT 'stg_geolocation', count(*) FROM events"""

ORACLE["sink_insert_select"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp
FROM orders"""

# --- table changes -----------------------------------------------------------

ORACLE["delete_by_key"] = """
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
SELECT 'order_items' AS tbl, count(*) AS cnt FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone)
UNION ALL
SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)"""

ORACLE["propagate_delete_cascade"] = """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
       l_extendedprice AS price
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""

ORACLE["propagate_delete_restrict"] = """
SELECT l_orderkey AS order_id, count(*) AS blocking_rows
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' GROUP BY l_orderkey"""

ORACLE["propagate_delete_set_null"] = """
SELECT p_partkey AS product_id,
       CASE WHEN p_brand NOT IN ('Brand#4', 'Brand#5', 'Brand#11') THEN p_brand END AS category_id
FROM part"""

ORACLE["delete_over_references"] = """
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'),
sizes AS (
    SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM orders) AS orders,
           (SELECT count(*) FROM lineitem) AS order_items, (SELECT count(*) FROM labels) AS order_reviews,
           (SELECT count(*) FROM part) AS products, (SELECT count(DISTINCT p_brand) FROM part) AS categories,
           (SELECT count(*) FROM part WHERE p_brand IS NULL) AS without
),
every AS (
    SELECT deleted, unnest([
        {'t': 'customers', 's': 'left', 'n': customers}, {'t': 'orders', 's': 'left', 'n': orders},
        {'t': 'order_items', 's': 'left', 'n': order_items}, {'t': 'order_payments', 's': 'left', 'n': orders},
        {'t': 'order_reviews', 's': 'left', 'n': order_reviews}, {'t': 'products', 's': 'left', 'n': products},
        {'t': 'product_category', 's': 'left', 'n': categories}, {'t': 'products', 's': 'without category', 'n': without}
    ]) AS r
    FROM sizes, (VALUES ('customers'), ('orders'), ('product_category')) d(deleted)
),
less AS (
    SELECT 'orders' AS deleted, 'orders' AS t, 'left' AS s, (SELECT count(*) FROM gone) AS n
    UNION ALL SELECT 'orders', 'order_payments', 'left', (SELECT count(*) FROM gone)
    UNION ALL SELECT 'orders', 'order_items', 'left', (SELECT count(*) FROM lineitem WHERE l_orderkey IN (FROM gone))
    UNION ALL SELECT 'orders', 'order_reviews', 'left', (SELECT count(*) FROM labels WHERE doc_id IN (FROM gone))
    UNION ALL SELECT 'product_category', 'product_category', 'left',
                     (SELECT count(DISTINCT p_brand) FROM part WHERE p_brand IN ('Brand#4', 'Brand#5', 'Brand#11'))
    UNION ALL SELECT 'product_category', 'products', 'without category',
                     -(SELECT count(*) FROM part WHERE p_brand IN ('Brand#4', 'Brand#5', 'Brand#11'))
)
SELECT deleted, r.t AS "table", r.s AS state, r.n - coalesce(less.n, 0) AS cnt
FROM every LEFT JOIN less USING (deleted) WHERE (less.t = r.t AND less.s = r.s) OR less.t IS NULL
UNION ALL
SELECT deleted, r.t, r.s, r.n FROM every e
WHERE EXISTS (FROM less WHERE less.deleted = e.deleted)
  AND NOT EXISTS (FROM less WHERE less.deleted = e.deleted AND less.t = e.r.t AND less.s = e.r.s)
UNION ALL
SELECT 'customers', 'orders', 'blocked by customer_id', count(*)
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 3 HAVING count(*) > 0"""

ORACLE["update_from_subquery"] = """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
       CAST(CASE WHEN n_name IN ('NATION_3', 'NATION_4', 'NATION_5') THEN (SELECT max(n_nationkey) FROM nation)
                 ELSE n_regionkey END AS BIGINT) AS n_regionkey
FROM nation"""

ORACLE["rewrite_touched_files"] = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey BETWEEN 300 AND 700 AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS order_status,
       CASE WHEN o_orderkey BETWEEN 300 AND 700 AND o_orderstatus = 'O' THEN -o_custkey ELSE o_custkey END AS customer_id
FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderkey < 500)"""

ORACLE["add_nullable_column"] = """
SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS filled, max(n_name) AS last_name FROM nation"""

ORACLE["insert_values"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp
FROM orders
UNION ALL
SELECT -1, (SELECT min(c_custkey) FROM customer), 'created', NULL"""

ORACLE["fill_default"] = """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_extendedprice AS price,
       CAST(0 AS DOUBLE) AS freight_value
FROM lineitem"""

ORACLE["surrogate_key"] = """
SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS customer_unique_id FROM customer
UNION ALL
SELECT count(*), 'events:1:' || count(*) FROM events"""

ORACLE["surrogate_key_over_loads"] = """
WITH first AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 3 = 0),
later AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM first))
SELECT row_number() OVER (ORDER BY p_name) AS name_id, p_name FROM first
UNION ALL
SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY p_name), p_name FROM later"""

ORACLE["dedup_keep_last"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM lineitem)
WHERE rn = 1"""

# --- constraints -------------------------------------------------------------

ORACLE["validate_not_null"] = f"WITH {STG_ORDERS}\n" + "\nUNION ALL\n".join(
    f"SELECT 'orders' AS \"table\", 'not_null {c}' AS rule, count(*) FILTER (WHERE trim({c}) = '') AS violations "
    "FROM stg_orders"
    for c in (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    )
)

ORACLE["validate_key"] = """
SELECT 'orders' AS "table", 'primary_key order_id' AS rule, count(*) - count(DISTINCT o_orderkey) AS violations FROM orders
UNION ALL
SELECT 'order_items', 'primary_key order_id, order_item_id', count(*) - count(DISTINCT (l_orderkey, l_linenumber))
FROM lineitem"""

ORACLE["validate_check"] = """
SELECT 'order_items' AS "table", 'check chk_price_positive' AS rule,
       count(*) FILTER (WHERE l_extendedprice < 10000) AS violations FROM lineitem
UNION ALL
SELECT 'order_items', 'check chk_freight_nonneg', count(*) FILTER (WHERE l_tax < 0) FROM lineitem
UNION ALL
SELECT 'orders', 'check chk_order_status', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders"""

ORACLE["validate_foreign_key"] = """
SELECT 'order_items' AS "table", 'foreign_key order_id -> orders' AS rule, count(*) AS violations
FROM lineitem WHERE CASE WHEN l_linenumber = 7 THEN -l_orderkey ELSE l_orderkey END NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'order_items', 'foreign_key seller_id -> sellers', count(*)
FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"""

_ITEM_RULES = {
    "not_null order_id": "count(*) FILTER (WHERE l_orderkey IS NULL)",
    "not_null order_item_id": "count(*) FILTER (WHERE l_linenumber IS NULL)",
    "not_null product_id": "count(*) FILTER (WHERE l_partkey IS NULL)",
    "not_null seller_id": "count(*) FILTER (WHERE l_suppkey IS NULL)",
    "not_null price": "count(*) FILTER (WHERE l_extendedprice IS NULL)",
    "not_null freight_value": "count(*) FILTER (WHERE l_tax IS NULL)",
    "length order_id": "count(*) FILTER (WHERE length(CAST(l_orderkey AS VARCHAR)) > 32)",
    "length product_id": "count(*) FILTER (WHERE length(CAST(l_partkey AS VARCHAR)) > 32)",
    "length seller_id": "count(*) FILTER (WHERE length(seller_id) > 32)",
    "check chk_price_positive": "count(*) FILTER (WHERE l_extendedprice < 0)",
    "check chk_freight_nonneg": "count(*) FILTER (WHERE l_tax < 0)",
    "primary_key order_id, order_item_id": "count(*) - count(DISTINCT (l_orderkey, l_linenumber))",
    "foreign_key order_id -> orders": "count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))",
    "foreign_key product_id -> products": "count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part))",
    "foreign_key seller_id -> sellers":
        "count(*) FILTER (WHERE seller_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))",
}
_ORDER_RULES = {
    "not_null order_id": "count(*) FILTER (WHERE o_orderkey IS NULL)",
    "not_null customer_id": "count(*) FILTER (WHERE o_custkey IS NULL)",
    "not_null order_status": "count(*) FILTER (WHERE o_orderstatus IS NULL)",
    "not_null order_purchase_timestamp": "count(*) FILTER (WHERE o_orderdate IS NULL)",
    "not_null order_estimated_delivery_date": "count(*) FILTER (WHERE o_orderdate + INTERVAL 30 DAY IS NULL)",
    "length order_id": "count(*) FILTER (WHERE length(CAST(o_orderkey AS VARCHAR)) > 32)",
    "length customer_id": "count(*) FILTER (WHERE length(CAST(o_custkey AS VARCHAR)) > 32)",
    "length order_status": "count(*) FILTER (WHERE length(o_orderstatus) > 20)",
    "check chk_order_status": "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P'))",
    "primary_key order_id": "count(*) - count(DISTINCT o_orderkey)",
    "foreign_key customer_id -> customers": "count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))",
}
_LINES = "(SELECT *, CAST(l_suppkey AS VARCHAR) AS seller_id FROM lineitem)"

ORACLE["validate_table"] = "\nUNION ALL\n".join(
    f"SELECT 'order_items' AS \"table\", '{rule}' AS rule, {count} AS violations FROM {_LINES}"
    for rule, count in _ITEM_RULES.items()
)

_STRAYS = """(SELECT *, CASE WHEN l_partkey % 10 = 7 THEN 'no-' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS seller_id
    FROM lineitem)"""
_ONCE = """(SELECT *, CAST(l_suppkey AS VARCHAR) AS seller_id FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC) = 1)"""


def _report(batch: str, table: str, rules: dict[str, str], source: str, accepted: int) -> list[str]:
    return [
        f"SELECT '{batch}' AS batch, '{table}' AS \"table\", '{rule}' AS rule, {count} AS violations, "
        f"CAST({accepted} AS BIGINT) AS accepted FROM {source}"
        for rule, count in rules.items()
    ]


ORACLE["q06_gated_append"] = "\nUNION ALL\n".join(
    _report("bad", "orders", _ORDER_RULES, "orders", 0)
    + _report("bad", "order_items", _ITEM_RULES, _STRAYS, 0)
    + _report("good", "orders", _ORDER_RULES, "orders", 1)
    + _report("good", "order_items", _ITEM_RULES, _ONCE, 1)
    + [
        "SELECT 'stored', 'orders', 'rows', count(*), 1 FROM orders",
        "SELECT 'stored', 'order_items', 'rows', count(DISTINCT (l_orderkey, l_linenumber)), 1 FROM lineitem",
    ]
)

# --- cleaning ----------------------------------------------------------------

CLEAN_CUSTOMERS = """customers AS (SELECT DISTINCT trim(customer_id) AS customer_id FROM stg_orders WHERE trim(customer_id) <> '')"""
_ISO = "try_strptime(nullif(trim({0}), ''), '%Y-%m-%d %H:%M:%S')"
_TIMES = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
SIFTED_ORDERS = f"""{STG_ORDERS}, {CLEAN_CUSTOMERS}, sifted AS (
    SELECT *, CASE WHEN trim(order_id) = '' THEN 'no order_id'
        {" ".join(f"WHEN trim({c}) <> '' AND {_ISO.format(c)} IS NULL THEN 'unreadable {c}'" for c in _TIMES)}
        WHEN lower(trim(order_status)) NOT IN ('delivered', 'shipped') THEN 'check chk_order_status'
        WHEN trim(customer_id) NOT IN (SELECT customer_id FROM customers) THEN 'unknown customer_id' END AS reason
    FROM stg_orders)"""
CLEAN_ORDERS = f"""{SIFTED_ORDERS}, clean_orders AS (
    SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, lower(trim(order_status)) AS order_status,
           {", ".join(f"{_ISO.format(c)} AS {c}" for c in _TIMES)}
    FROM sifted WHERE reason IS NULL)"""

ORACLE["clean_customers"] = f"""WITH {STG_ORDERS}, {CLEAN_CUSTOMERS}
SELECT customer_id, customer_id AS customer_unique_id, CAST(NULL AS VARCHAR) AS customer_zip_code_prefix,
       CAST(NULL AS VARCHAR) AS customer_city, CAST(NULL AS VARCHAR) AS customer_state
FROM customers"""
ORACLE["clean_orders"] = f"WITH {CLEAN_ORDERS} SELECT * FROM clean_orders"
ORACLE["clean_orders_rejects"] = f"""WITH {SIFTED_ORDERS}
SELECT reason AS reject_reason, count(*) AS rows_rejected FROM sifted WHERE reason IS NOT NULL GROUP BY reason"""

STG_PRODUCTS = """stg_products AS (
    SELECT CASE WHEN p_partkey % 103 = 0 THEN ' ' ELSE p_partkey || '  ' END AS product_id,
           CASE WHEN p_partkey % 11 = 0 THEN ' ' WHEN p_partkey % 3 = 0 THEN upper(p_type)
                WHEN p_partkey % 3 = 1 THEN ' ' || translate(p_type, 'AEO', 'ÁÉÓ') || ' ' ELSE p_type END AS category,
           CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size END AS product_name_length,
           CASE WHEN p_partkey % 17 = 0 THEN 13 ELSE p_size END AS product_description_length,
           CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE p_size END AS product_photos_qty,
           CASE WHEN p_partkey % 107 = 0 THEN NULL ELSE p_size + 0.25 END AS product_weight_g,
           CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size END AS product_length_cm, p_size, p_partkey
    FROM part),
named AS (SELECT *, coalesce(nullif(lower(trim(category)), ''), 'unknown') AS name FROM stg_products),
lookup AS (
    SELECT row_number() OVER (ORDER BY name) AS category_id, name AS category_name, folded
    FROM (SELECT strip_accents(name) AS folded, min(name) AS name FROM named GROUP BY folded)),
products AS (
    SELECT trim(product_id) AS product_id, category_id, CAST(product_name_length AS BIGINT) AS product_name_length,
           CAST(product_description_length AS BIGINT) AS product_description_length,
           CAST(product_photos_qty AS BIGINT) AS product_photos_qty,
           CAST(product_weight_g AS DOUBLE) AS product_weight_g, CAST(product_length_cm AS DOUBLE) AS product_length_cm,
           CAST(p_size AS DOUBLE) AS product_height_cm, CAST(p_size AS DOUBLE) AS product_width_cm
    FROM named JOIN lookup ON folded = strip_accents(name)
    WHERE trim(product_id) <> '' AND p_partkey % 107 <> 0)"""
ORACLE["clean_category_lookup"] = f"WITH {STG_PRODUCTS} SELECT category_id, category_name FROM lookup"
ORACLE["clean_products"] = f"WITH {STG_PRODUCTS} SELECT * FROM products"
ORACLE["clean_products_rejects"] = f"""WITH {STG_PRODUCTS}, reasons AS (
    SELECT CASE WHEN trim(product_id) = '' THEN 'no product_id' WHEN p_partkey % 107 = 0 THEN 'unreadable product_weight_g'
                WHEN strip_accents(name) = (SELECT min(folded) FROM lookup WHERE category_id = 1) THEN 'unknown category'
           END AS reason FROM named)
SELECT reason AS reject_reason, count(*) AS rows_rejected FROM reasons WHERE reason IS NOT NULL GROUP BY ALL"""
ORACLE["clean_rows_accounted_for"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS \"table\", count(*) AS rows FROM {source}"
    for table, source in {
        "products": "part",
        "orders": "orders",
        "order_items": "lineitem",
        "order_payments": "orders",
        "order_reviews": "documents",
        "geolocation": "events",
    }.items()
)

CLEAN_SELLERS = """sellers AS (
    SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS seller_id,
           CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_nationkey || '00' END AS seller_zip_code_prefix,
           CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'city ' || lower(n_name) END AS seller_city,
           upper(n_name[1:2]) AS seller_state
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 31 <> 0)"""
ORACLE["clean_sellers"] = f"WITH {CLEAN_SELLERS} SELECT * FROM sellers"

CLEAN_ITEMS = """order_items AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
           l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value
    FROM lineitem
    WHERE l_orderkey % 41 <> 0 AND l_partkey % 47 <> 0
      AND CAST(l_orderkey AS VARCHAR) IN (SELECT order_id FROM clean_orders)
      AND CAST(l_partkey AS VARCHAR) IN (SELECT product_id FROM products)
      AND CAST(l_suppkey AS VARCHAR) IN (SELECT seller_id FROM sellers))"""
ORACLE["clean_order_items"] = f"""WITH {CLEAN_ORDERS}, {STG_PRODUCTS}, {CLEAN_SELLERS}, {CLEAN_ITEMS}
SELECT * FROM order_items"""

CLEAN_PAYMENTS = """order_payments AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
           lower(trim(o_orderpriority)) AS payment_type,
           CAST(CASE WHEN o_orderkey % 29 = 0 THEN 2 ELSE 3 END AS BIGINT) AS payment_installments,
           o_totalprice AS payment_value
    FROM orders
    WHERE o_orderkey % 37 <> 0 AND o_orderkey % 53 <> 0
      AND CAST(o_orderkey AS VARCHAR) IN (SELECT order_id FROM clean_orders))"""
ORACLE["clean_order_payments"] = f"WITH {CLEAN_ORDERS}, {CLEAN_PAYMENTS} SELECT * FROM order_payments"

CLEAN_REVIEWS = """reviews AS (
    SELECT doc_id, text, source, TIMESTAMP '2018-03-05 14:07:00' + to_days(CAST(doc_id % 300 AS INTEGER)) AS ts
    FROM documents),
order_reviews AS (
    SELECT 'r' || doc_id AS review_id, CAST(doc_id AS VARCHAR) AS order_id, doc_id % 9 + 1 AS review_score,
           CASE WHEN doc_id % 4 = 0 THEN 'A' WHEN doc_id % 3 = 0 THEN NULL ELSE nullif(trim(source), '') END
               AS review_comment_title,
           nullif(trim(text), '') AS review_comment_message, ts AS review_creation_date,
           CASE WHEN doc_id % 6 <> 0 THEN ts END AS review_answer_timestamp
    FROM reviews
    WHERE doc_id % 9 < 5 AND doc_id % 59 <> 0 AND CAST(doc_id AS VARCHAR) IN (SELECT order_id FROM clean_orders))"""
ORACLE["clean_order_reviews"] = f"WITH {CLEAN_ORDERS}, {CLEAN_REVIEWS} SELECT * FROM order_reviews"

GEOLOCATION = """samples AS (
    SELECT *, CASE WHEN event_id % 61 = 0 THEN '1e2' WHEN event_id % 67 = 0 THEN '.5' WHEN event_id % 71 = 0 THEN '91'
                   WHEN event_id % 2 = 0 THEN '-' || printf('%.4f', value / 10) ELSE printf('%.4f', value / 10) END AS lat,
           CASE WHEN event_id % 73 = 0 THEN '-181' ELSE '4' || (user_id % 10) || '.5' END AS lng
    FROM events),
geolocation AS (
    SELECT CAST(user_id AS VARCHAR) AS geolocation_zip_code_prefix,
           CAST(-abs(CAST(lat AS DECIMAL(10,6))) AS DOUBLE) AS geolocation_lat,
           CAST(-abs(CAST(lng AS DECIMAL(10,6))) AS DOUBLE) AS geolocation_lng,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'city ' || lower(event_type) END AS geolocation_city,
           upper(event_type[1:2]) AS geolocation_state
    FROM samples
    WHERE regexp_matches(lat, '^-?[0-9]+[.]?[0-9]*$') AND regexp_matches(lng, '^-?[0-9]+[.]?[0-9]*$')
      AND TRY_CAST(lat AS DECIMAL(10,6)) BETWEEN -90 AND 90 AND TRY_CAST(lng AS DECIMAL(10,6)) BETWEEN -180 AND 180)"""
ORACLE["clean_geolocation"] = f"WITH {GEOLOCATION} SELECT * FROM geolocation"

ORACLE["rowcount_production"] = f"""WITH {CLEAN_ORDERS}, {STG_PRODUCTS}, {CLEAN_SELLERS}, {CLEAN_ITEMS},
{CLEAN_PAYMENTS}, {CLEAN_REVIEWS}, {GEOLOCATION}
SELECT 'customers' AS tbl, count(*) AS rows_loaded FROM customers
UNION ALL SELECT 'product_category', count(*) FROM lookup
UNION ALL SELECT 'products', count(*) FROM products
UNION ALL SELECT 'sellers', count(*) FROM sellers
UNION ALL SELECT 'orders', count(*) FROM clean_orders
UNION ALL SELECT 'order_items', count(*) FROM order_items
UNION ALL SELECT 'order_payments', count(*) FROM order_payments
UNION ALL SELECT 'order_reviews', count(*) FROM order_reviews
UNION ALL SELECT 'geolocation', count(*) FROM geolocation"""

# --- data quality ------------------------------------------------------------

ORACLE["dq_missing_master"] = f"""WITH {STG_ORDERS}, {CLEAN_CUSTOMERS}
SELECT 'customers rebuilt from orders' AS "check", count(*) AS rows_affected FROM customers"""

ORACLE["dq_repair_encoding"] = "SELECT doc_id, text FROM documents"

ORACLE["dq_repair_encoding_report"] = """
SELECT 'text not valid UTF-8' AS "check",
       count(*) FILTER (WHERE doc_id % 3 = 0 AND strlen(text) > length(text)) AS rows_affected
FROM documents"""

ORACLE["dq_sign_inversion"] = """
WITH samples AS (
    SELECT CAST(value / 10 AS DECIMAL(10,6)) AS lat, CAST(40 + user_id % 10 AS DECIMAL(10,6)) AS lng FROM events)
SELECT 'inside the box as read' AS "check",
       count(*) FILTER (WHERE lat BETWEEN -35 AND 6 AND lng BETWEEN -75 AND -33) AS rows_affected FROM samples
UNION ALL
SELECT 'inside the box corrected',
       count(*) FILTER (WHERE -abs(lat) BETWEEN -35 AND 6 AND -abs(lng) BETWEEN -75 AND -33) FROM samples"""

ORACLE["dq_date_format"] = """
SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'dd-MM-yyyy HH:mm' ELSE 'yyyy-MM-dd HH:mm:ss' END AS "check",
       count(*) AS rows_affected
FROM orders GROUP BY ALL
UNION ALL
SELECT CASE WHEN doc_id % 6 = 0 THEN 'blank' ELSE 'dd-MM-yyyy HH:mm' END, count(*) FROM documents GROUP BY ALL"""

_LINE_COUNT = "length(text) - length(replace(text, chr(10), '')) + 1"
ORACLE["dq_duplicate_files"] = f"""
SELECT 'part_3_copy' AS "check", CAST(sum({_LINE_COUNT}) AS BIGINT) AS rows_affected FROM documents WHERE lang = 'en'"""
ORACLE["dq_duplicate_files_loaded_once"] = f"""
SELECT CASE WHEN lang = 'en' THEN 'part_1' ELSE 'part_2' END AS folder, CAST(sum({_LINE_COUNT}) AS BIGINT) AS lines
FROM documents GROUP BY ALL"""

ORACLE["dq_placeholder_text"] = """
SELECT 'review_comment_title is filler' AS "check",
       count(*) FILTER (WHERE doc_id % 4 = 0 OR (doc_id % 3 <> 0 AND trim(source) = 'A')) AS rows_affected FROM documents
UNION ALL
SELECT 'review_comment_message is filler', count(*) FILTER (WHERE trim(text) = 'A') FROM documents"""

ORACLE["dq_fillers_found"] = """
WITH texts AS (
    SELECT 'review_comment_title' AS "check",
           trim(CASE WHEN doc_id % 4 = 0 THEN 'A' WHEN doc_id % 3 = 0 THEN ' ' ELSE source END) AS value FROM documents
    UNION ALL
    SELECT 'review_comment_message', trim(text) FROM documents
)
SELECT "check", value, n AS rows_affected
FROM (SELECT "check", value, count(*) AS n FROM texts WHERE value <> '' GROUP BY ALL) t
JOIN (SELECT "check", count(*) AS filled FROM texts WHERE value <> '' GROUP BY ALL) u USING ("check")
WHERE length(value) <= 3 AND n >= 0.01 * filled"""

ORACLE["dq_missing_category"] = """
SELECT 'category missing' AS "check", count(*) FILTER (WHERE p_partkey % 11 = 0) AS rows_affected FROM part"""

ORACLE["dq_missing_dimensions"] = f"WITH {STG_PRODUCTS}\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {rule}) AS rows_affected FROM products"
    for name, rule in {
        "product_weight_g missing": "product_weight_g IS NULL",
        "product_length_cm missing": "product_length_cm IS NULL",
        "product_height_cm missing": "product_height_cm IS NULL",
        "product_width_cm missing": "product_width_cm IS NULL",
        "any missing": "product_weight_g IS NULL OR product_length_cm IS NULL",
    }.items()
)

MISMATCH = f"""{ITEMS}, paid AS (
    SELECT o_orderkey AS order_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS paid FROM orders GROUP BY ALL),
owed AS (SELECT order_id, sum(price + freight) AS owed FROM items GROUP BY ALL),
found AS (
    SELECT order_id, o_orderstatus AS order_status, paid, owed, paid - owed AS gap
    FROM orders JOIN paid ON order_id = o_orderkey JOIN owed USING (order_id) WHERE abs(paid - owed) > 0.01)"""
ORACLE["dq_payment_mismatch"] = f"""WITH {MISMATCH}
SELECT 'payments differ from items' AS "check", count(*) AS rows_affected FROM found"""

ORACLE["dq_order_without_payment"] = """
SELECT 'orders without items' AS "check", count(*) AS rows_affected
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""

ORACLE["dq_delivered_without_date"] = """
SELECT 'delivered without a date' AS "check", count(*) AS rows_affected
FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""

ORACLE["dq_csv_quoting"] = """
SELECT 'text with commas, quotes or line ends' AS "check",
       count(*) FILTER (WHERE regexp_matches(text, '[,"\\n]')) AS rows_affected FROM documents
UNION ALL SELECT 'text changed by the round trip', 0"""

# --- the query catalogue -----------------------------------------------------

ORACLE["q04_dedup_customers"] = """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_unique_id, c.c_mktsegment AS customer_city,
       CAST(c.c_nationkey AS BIGINT) AS customer_state
FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer o WHERE o.c_mktsegment = c.c_mktsegment
                  AND o.c_nationkey = c.c_nationkey AND o.c_custkey > c.c_custkey)"""

_PROFILED = {
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double "
    "l_extendedprice:double l_discount:double l_tax:double l_returnflag:string l_linestatus:string "
    "l_shipdate:timestamp_ntz",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz "
    "o_orderpriority:string",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
    "supplier": "s_suppkey:bigint s_name:string s_nationkey:int s_acctbal:double",
}
ORACLE["q05_data_dictionary"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, CAST({i} AS BIGINT) AS position, '{column}' AS column_name, "
    f"'{kind}' AS column_type, count(*) AS row_count, count(*) - count({column}) AS null_count, "
    f"count(DISTINCT {column}) AS distinct_count, CAST(count(DISTINCT {column}) = count(*) AS BIGINT) AS key_candidate FROM {table}"
    for table, columns in _PROFILED.items()
    for i, (column, kind) in enumerate((c.split(":") for c in columns.split()), 1)
)
ORACLE["sink_dictionary_csv"] = ORACLE["q05_data_dictionary"]
ORACLE["q05_profile_by_sketches"] = f"""
SELECT table_name, position, column_name, column_type, row_count, null_count, key_candidate,
       CASE WHEN key_candidate = 1 THEN distinct_count END AS distinct_count
FROM ({ORACLE["q05_data_dictionary"]})"""

# The exported columns of the loaded tables (type, nullable, key), typed out apart from the schemas under test.
_EXPORTED = {
    "customers": {
        "customer_id": ("char(32)", "NO", "PRI"),
        "customer_unique_id": ("char(32)", "NO", "MUL"),
        "customer_zip_code_prefix": ("varchar(10)", "YES", ""),
        "customer_city": ("varchar(100)", "YES", ""),
        "customer_state": ("char(2)", "YES", "MUL"),
        "created_at": ("timestamp", "YES", ""),
    },
    "sellers": {
        "seller_id": ("char(32)", "NO", "PRI"),
        "seller_zip_code_prefix": ("varchar(10)", "YES", ""),
        "seller_city": ("varchar(100)", "YES", ""),
        "seller_state": ("char(2)", "YES", "MUL"),
    },
    "products": {
        "product_id": ("char(32)", "NO", "PRI"),
        "category_id": ("int", "YES", "MUL"),
        "product_name_length": ("int", "YES", ""),
        "product_description_length": ("int", "YES", ""),
        "product_photos_qty": ("int", "YES", ""),
        "product_weight_g": ("decimal(10,2)", "YES", ""),
        "product_length_cm": ("decimal(10,2)", "YES", ""),
        "product_height_cm": ("decimal(10,2)", "YES", ""),
        "product_width_cm": ("decimal(10,2)", "YES", ""),
    },
    "orders": {
        "order_id": ("char(32)", "NO", "PRI"),
        "customer_id": ("char(32)", "NO", "MUL"),
        "order_status": ("varchar(20)", "NO", "MUL"),
        "order_purchase_timestamp": ("datetime", "NO", "MUL"),
        "order_approved_at": ("datetime", "YES", ""),
        "order_delivered_carrier_date": ("datetime", "YES", ""),
        "order_delivered_customer_date": ("datetime", "YES", ""),
        "order_estimated_delivery_date": ("datetime", "NO", ""),
    },
    "order_items": {
        "order_id": ("char(32)", "NO", "PRI"),
        "order_item_id": ("int", "NO", "PRI"),
        "product_id": ("char(32)", "NO", "MUL"),
        "seller_id": ("char(32)", "NO", "MUL"),
        "shipping_limit_date": ("datetime", "YES", ""),
        "price": ("decimal(10,2)", "NO", "MUL"),
        "freight_value": ("decimal(10,2)", "NO", ""),
    },
}
_HELD_BY = {"customers": "customer", "sellers": "supplier", "products": "part", "orders": "orders", "order_items": "lineitem"}
ORACLE["sink_declared_dictionary_csv"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{kind}' AS type, '{nullable}' AS nullable, '{key}' AS key, "
    f"(SELECT count(*) FROM {_HELD_BY[table]}) AS row_count"
    for table, columns in _EXPORTED.items()
    for column, (kind, nullable, key) in columns.items()
)

# Loaded columns of the declared tables and the column they come from.
_LOADED = {
    "customers": ("customer", "customer_id:c_custkey customer_unique_id:c_name"),
    "products": ("part", "product_id:p_partkey"),
    "sellers": ("supplier", "seller_id:s_suppkey"),
    "orders": ("orders", "order_id:o_orderkey customer_id:o_custkey order_status:o_orderstatus "
               "order_purchase_timestamp:o_orderdate order_estimated_delivery_date:o_orderdate"),
    "order_items": ("lineitem", "order_id:l_orderkey order_item_id:l_linenumber product_id:l_partkey "
                    "seller_id:l_suppkey price:l_extendedprice freight_value:l_tax"),
}


def _declared() -> str:
    rows = []
    for table in TABLES.values():
        source, columns = _LOADED.get(table.name, ("", ""))
        origin = dict(pair.split(":") for pair in columns.split())
        for position, c in enumerate(table.columns, 1):
            known = c.name in origin
            counts = f"count(*) AS row_count, count(*) - count({origin.get(c.name)}) AS null_count FROM {source}"
            rows.append(
                f"SELECT '{table.name}' AS table_name, CAST({position} AS BIGINT) AS position, "
                f"'{c.name}' AS column_name, '{c.declared}' AS column_type, "
                f"'{'YES' if c.nullable else 'NO'}' AS is_nullable, '{c.key}' AS column_key, "
                f"CAST({repr(c.default) if c.default else 'NULL'} AS VARCHAR) AS column_default, "
                f"'{MEANINGS[table.name]}' AS business_meaning, "
                + (counts if known else "CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS null_count")
            )
    return "\nUNION ALL\n".join(rows)


ORACLE["q05_declared_dictionary"] = _declared()

ORACLE["q07_conflicting_identity"] = """
SELECT a.l_orderkey, CAST(a.l_linenumber AS BIGINT) AS l_linenumber,
       a.l_partkey AS l_partkey_a, a.l_suppkey AS supplier_a, a.l_returnflag AS flag_a,
       b.l_partkey AS l_partkey_b, b.l_suppkey AS supplier_b, b.l_returnflag AS flag_b
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_partkey < b.l_partkey
WHERE a.l_suppkey <> b.l_suppkey OR a.l_returnflag <> b.l_returnflag"""

ORACLE["q07_conflict_classes"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey AS supplier, l_returnflag AS flag,
       min(l_partkey) AS first_id, count(l_partkey) AS members
FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (
    SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING min(l_suppkey) < max(l_suppkey) OR min(l_returnflag) < max(l_returnflag))
GROUP BY l_orderkey, l_linenumber, l_suppkey, l_returnflag"""

ORACLE["q08_orphans_staging"] = """
SELECT 'orphan_order' AS issue, count(*) AS cnt FROM lineitem WHERE l_orderkey % 41 = 0 OR l_orderkey % 101 = 0
UNION ALL
SELECT 'orphan_product', count(*) FROM lineitem WHERE l_partkey % 103 = 0"""

ORACLE["q08_orphans_production"] = """
SELECT 'orphan_order_prod' AS issue, count(*) AS cnt
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey IS NULL
UNION ALL
SELECT 'orphan_product_prod', count(*) FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE p_partkey IS NULL
UNION ALL
SELECT 'orphan_seller_prod', count(*) FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE s_suppkey IS NULL"""

ORACLE["q09_never_ordered"] = """
SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_mktsegment AS customer_city,
       CAST(c_nationkey AS BIGINT) AS customer_state
FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)"""

ORACLE["q10_payment_mismatch"] = f"""WITH {MISMATCH}
SELECT order_id, order_status, CAST(paid AS DOUBLE) AS total_paid, CAST(owed AS DOUBLE) AS total_order_value,
       CAST(gap AS DOUBLE) AS discrepancy
FROM found ORDER BY abs(gap) DESC, order_id LIMIT 50"""

ORACLE["q10_payment_mismatch_fine"] = f"""WITH {MISMATCH}
SELECT order_id, CAST(gap AS DOUBLE) AS discrepancy FROM found WHERE abs(gap) > 0.015"""

ORACLE["q11_mom_growth"] = f"""WITH {ITEMS}, monthly AS (
    SELECT strftime(o_orderdate, '%Y-%m') AS revenue_month, sum(price) AS revenue
    FROM orders JOIN items ON order_id = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL),
lagged AS (SELECT *, lag(revenue) OVER (ORDER BY revenue_month) AS previous FROM monthly)
SELECT revenue_month, CAST(revenue AS DOUBLE) AS revenue, CAST(previous AS DOUBLE) AS prev_month_revenue,
       CASE WHEN previous <> 0
            THEN round((CAST(revenue AS DOUBLE) - CAST(previous AS DOUBLE)) / CAST(previous AS DOUBLE) * 100, 2) END
           AS mom_growth_pct
FROM lagged"""

ORACLE["q12_top_products_per_category"] = f"""WITH {PRODUCT_REVENUE}
SELECT category_name, product_id, CAST(revenue AS DOUBLE) AS product_revenue, rnk FROM (
    SELECT *, dense_rank() OVER (PARTITION BY category_name ORDER BY revenue DESC) AS rnk FROM revenue)
WHERE rnk <= 10"""

ORACLE["q13_clv_tiers"] = """
WITH clv AS (
    SELECT c_custkey AS customer_id, c_name AS customer_unique_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT customer_id, customer_unique_id, CAST(v AS DOUBLE) AS lifetime_value,
       CASE WHEN v >= 3000000 THEN 'Gold' WHEN v >= 2000000 THEN 'Silver' ELSE 'Bronze' END AS clv_tier
FROM clv"""

ORACLE["q14_sales_rollup"] = f"""WITH {ITEMS}, sold AS (
    SELECT strftime(o_orderdate, '%Y-%m') AS sales_month, CAST(yearweek(o_orderdate) AS BIGINT) AS sales_week,
           {_date("o_orderdate")} AS sales_day, price
    FROM orders JOIN items ON order_id = o_orderkey
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01')
SELECT sales_month, sales_week, sales_day, CAST(round(sum(price), 2) AS DOUBLE) AS revenue,
       CAST(grouping(sales_day) + grouping(sales_week) + grouping(sales_month) AS BIGINT) AS level
FROM sold GROUP BY ROLLUP (sales_month, sales_week, sales_day)"""

ORACLE["q15_top_category_per_month"] = f"""WITH {ITEMS}, monthly AS (
    SELECT month(o_orderdate) AS order_month, p_brand AS category_name, sum(price) AS revenue
    FROM orders JOIN items ON order_id = o_orderkey JOIN part ON p_partkey = product_id GROUP BY ALL)
SELECT CAST(order_month AS BIGINT) AS order_month, category_name, CAST(revenue AS DOUBLE) AS revenue FROM (
    SELECT *, rank() OVER (PARTITION BY order_month ORDER BY revenue DESC) AS rnk FROM monthly)
WHERE rnk = 1"""

ORACLE["q16_customer_360"] = """
SELECT c_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS customer_state, o_orderkey AS order_id,
       o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp, p_partkey AS product_id,
       p_brand AS category_name, l_extendedprice AS price, l_tax AS freight_value,
       CAST(quality AS BIGINT) AS review_score, text AS review_comment_message
FROM customer
JOIN orders ON o_custkey = c_custkey
JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey
LEFT JOIN labels ON labels.doc_id = o_orderkey
LEFT JOIN documents ON documents.doc_id = labels.doc_id
ORDER BY o_orderdate DESC, o_orderkey, p_partkey, l_extendedprice, l_tax, quality NULLS FIRST, text NULLS FIRST
LIMIT 100"""

ORACLE["q17_bought_a_never_b"] = """
SELECT DISTINCT c_custkey AS customer_id
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey
WHERE p_brand = 'Brand#2' AND c_custkey NOT IN (
    SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_brand IN ('Brand#4', 'Brand#5', 'Brand#11'))"""

ORACLE["q18_best_product_per_seller_category"] = f"""WITH {ITEMS}, revenue AS (
    SELECT s_suppkey AS seller_id, p_type AS category_name, product_id, sum(price) AS revenue
    FROM supplier JOIN items ON seller_id = s_suppkey JOIN part ON p_partkey = product_id GROUP BY ALL)
SELECT seller_id, category_name, product_id, CAST(revenue AS DOUBLE) AS revenue FROM (
    SELECT *, row_number() OVER (PARTITION BY seller_id, category_name ORDER BY revenue DESC, product_id) AS rn
    FROM revenue)
WHERE rn = 1"""

ORACLE["q19_market_basket"] = """
SELECT a.l_partkey AS product_a, b.l_partkey AS product_b, count(DISTINCT a.l_orderkey) AS times_bought_together
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
GROUP BY ALL HAVING count(DISTINCT a.l_orderkey) >= 2
ORDER BY times_bought_together DESC, product_a, product_b LIMIT 50"""

ORACLE["q20_shipping_delays"] = """
WITH delivered AS (
    SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 30 DAY AS due, max(l_shipdate) AS done
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT DISTINCT o_orderkey AS order_id, c_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS customer_state,
       s_suppkey AS seller_id, CAST(s_nationkey AS BIGINT) AS seller_state, due AS order_estimated_delivery_date,
       done AS order_delivered_customer_date, date_diff('day', due, done) AS days_late
FROM delivered JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey
WHERE done > due
ORDER BY days_late DESC, order_id, seller_id LIMIT 50"""

ORACLE["q21_above_state_average"] = f"""WITH {CUSTOMER_TOTALS}, means AS (
    SELECT customer_state, round(avg(total_spent), 6) AS mean FROM totals GROUP BY ALL)
SELECT customer_id, CAST(t.customer_state AS BIGINT) AS customer_state, CAST(total_spent AS DOUBLE) AS total_spent,
       mean AS avg_spent_in_state
FROM totals t JOIN means m ON t.customer_state IS NOT DISTINCT FROM m.customer_state
WHERE CAST(total_spent AS DOUBLE) > mean
ORDER BY total_spent DESC, customer_id LIMIT 100"""
ORACLE["q21_correlated"] = ORACLE["q21_above_state_average"]

ORACLE["q22_second_product"] = f"""WITH {PRODUCT_REVENUE}
SELECT category_name, product_id, CAST(revenue AS DOUBLE) AS revenue FROM (
    SELECT *, dense_rank() OVER (PARTITION BY category_name ORDER BY revenue DESC) AS rnk FROM revenue)
WHERE rnk = 2"""
ORACLE["q22_count_greater"] = f"""WITH {PRODUCT_REVENUE}
SELECT category_name, product_id, CAST(revenue AS DOUBLE) AS revenue FROM revenue r
WHERE 1 = (SELECT count(*) FROM revenue o WHERE o.category_name = r.category_name AND o.revenue > r.revenue)"""

ORACLE["q23_category_tree"] = """
WITH RECURSIVE nodes AS (
    SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey > 0 THEN (n_nationkey - 1) // 2 END AS parent
    FROM nation),
tree AS (
    SELECT id, name, parent, 0 AS depth, name AS path FROM nodes WHERE parent IS NULL
    UNION ALL
    SELECT c.id, c.name, c.parent, t.depth + 1, t.path || ' > ' || c.name FROM nodes c JOIN tree t ON c.parent = t.id)
SELECT CAST(id AS BIGINT) AS category_id, name AS category_name, CAST(parent AS BIGINT) AS parent_category_id,
       CAST(depth AS BIGINT) AS depth, path
FROM tree WHERE depth > 0"""

ORACLE["q23_grouped_categories"] = """
WITH lookup AS (
    SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT lower(p_brand) AS name FROM part))
SELECT id AS category_id, name AS category_name, (SELECT max(id) + 1 FROM lookup) AS parent_category_id,
       CAST(1 AS BIGINT) AS depth, 'livros (grupo) > ' || name AS path
FROM lookup WHERE name IN ('brand#4', 'brand#5', 'brand#11')"""

ORACLE["q24_consecutive_months"] = f"""
WITH months AS (SELECT DISTINCT o_custkey AS customer_id, date_trunc('month', o_orderdate) AS m FROM orders
                JOIN customer ON c_custkey = o_custkey),
numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY m) AS rn FROM months)
SELECT customer_id, {_date("min(m)")} AS streak_start, {_date("max(m)")} AS streak_end, count(*) AS consecutive_months
FROM numbered GROUP BY customer_id, m - to_months(CAST(rn AS INTEGER)) HAVING count(*) >= 3"""


def _moving_average(table: str, ts: str) -> str:
    return f"""
WITH daily AS (SELECT CAST({ts} AS DATE) AS d, count(*) AS n FROM {table} GROUP BY ALL)
SELECT {_date("d")} AS order_date, n AS order_count,
       round(avg(n) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS moving_avg_7day
FROM daily"""


ORACLE["q25_moving_average"] = _moving_average("orders", "o_orderdate")
ORACLE["q25_moving_average_events"] = _moving_average("events", "ts")

ORACLE["q26_order_gap"] = """
SELECT customer_id, order_id, order_purchase_timestamp, previous_order_ts,
       date_diff('day', previous_order_ts, order_purchase_timestamp) AS days_since_previous_order
FROM (SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS order_purchase_timestamp,
             lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_order_ts
      FROM orders)"""

ORACLE["q26_order_gap_hot_customer"] = """
WITH hot AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS customer_id FROM orders)
SELECT customer_id, order_id, order_purchase_timestamp, previous_order_ts,
       date_diff('day', previous_order_ts, order_purchase_timestamp) AS days_since_previous_order
FROM (SELECT customer_id, o_orderkey AS order_id, o_orderdate AS order_purchase_timestamp,
             lag(o_orderdate) OVER (PARTITION BY customer_id ORDER BY o_orderdate, o_orderkey) AS previous_order_ts
      FROM hot)"""

ORACLE["q27_top_sellers_per_state"] = f"""WITH {ITEMS}, revenue AS (
    SELECT s_suppkey AS seller_id, s_nationkey AS seller_state, sum(price) AS revenue
    FROM supplier JOIN items ON seller_id = s_suppkey GROUP BY ALL)
SELECT seller_id, CAST(seller_state AS BIGINT) AS seller_state, CAST(revenue AS DOUBLE) AS revenue, state_rank FROM (
    SELECT *, rank() OVER (PARTITION BY seller_state ORDER BY revenue DESC) AS state_rank FROM revenue)
WHERE state_rank <= 3"""

ORACLE["q28_running_total"] = f"""WITH {ITEMS}, daily AS (
    SELECT CAST(o_orderdate AS DATE) AS d, sum(price) AS revenue
    FROM orders JOIN items ON order_id = o_orderkey GROUP BY ALL),
running AS (SELECT *, sum(revenue) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS so_far,
                   sum(revenue) OVER () AS grand FROM daily)
SELECT {_date("d")} AS order_date, CAST(revenue AS DOUBLE) AS revenue, CAST(so_far AS DOUBLE) AS running_total,
       round(CAST(so_far AS DOUBLE) / CAST(grand AS DOUBLE) * 100, 2) AS pct_of_grand_total
FROM running"""


def _discount(requests: str, high: int) -> str:
    return f"""
WITH requests AS ({requests}),
counted AS (
    SELECT r.customer_id, r.order_value, r.as_of_order_id,
           count(*) FILTER (WHERE o.o_orderkey <> r.as_of_order_id
                            AND (o.o_orderdate < a.o_orderdate OR a.o_orderkey IS NULL)) AS prior
    FROM requests r
    LEFT JOIN orders a ON a.o_orderkey = r.as_of_order_id
    LEFT JOIN orders o ON o.o_custkey = r.customer_id
    GROUP BY ALL),
ruled AS (
    SELECT *, CASE WHEN prior = 0 THEN 15 WHEN order_value > {high} THEN 10 WHEN prior >= 5 THEN 5 ELSE 0 END AS pct,
           CASE WHEN prior = 0 THEN 'NEW_CUSTOMER' WHEN order_value > {high} THEN 'HIGH_VALUE_ORDER'
                WHEN prior >= 5 THEN 'LOYAL_CUSTOMER' ELSE 'NO_DISCOUNT' END AS discount_reason
    FROM counted),
amounts AS (
    SELECT *, round(CAST(order_value * pct AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS amount FROM ruled)
SELECT customer_id, CAST(order_value AS DOUBLE) AS order_value, as_of_order_id, CAST(pct AS DOUBLE) AS discount_pct,
       CAST(amount AS DOUBLE) AS discount_amount, CAST(order_value - amount AS DOUBLE) AS final_amount, discount_reason
FROM amounts"""


ORACLE["q29_discount"] = _discount(
    """SELECT o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(10,2)) AS order_value, o_orderkey AS as_of_order_id
       FROM orders""",
    400_000,
)
ORACLE["q29_discount_unknown_orders"] = _discount(
    """SELECT c_custkey AS customer_id, CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS order_value,
              -c_custkey - 1 AS as_of_order_id
       FROM customer""",
    500,
)

# A layout changes how the rows are stored, never the result.
ORACLE["q30_layout"] = ORACLE["q19_market_basket"]
ORACLE["q30_layout_bought_a_never_b"] = ORACLE["q17_bought_a_never_b"]
ORACLE["q30_layout_top_products"] = ORACLE["q12_top_products_per_category"]
ORACLE["q30_layout_order_gap"] = ORACLE["q26_order_gap"]

for _name in ("products", "sellers", "order_items", "order_payments", "order_reviews", "geolocation"):
    ORACLE[f"csv_clean_{_name}"] = ORACLE[f"clean_{_name}"]

ORACLE["q30_lookup_by_second_column"] = """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id, l_extendedprice AS price
FROM lineitem WHERE l_partkey <= 3"""
