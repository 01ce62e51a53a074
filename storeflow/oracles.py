"""The same results as plain SQL over the sample tables, one text per query."""

from __future__ import annotations

from storeflow.plans.views import DOCUMENT_LINES

_OPENING = "TIMESTAMP '1998-01-01 00:00:00'"

# Lines of one status with the columns the queries use.
_LINES = """
SELECT l_orderkey AS source_id, l_linenumber AS line_no, l_shipdate AS event_time,
       l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS price
FROM lineitem WHERE l_linestatus = '{status}'
"""
_RECEIVED = _LINES.format(status="F")
_SOLD = _LINES.format(status="O")

_TILL = """
SELECT user_id AS customer_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS sold_at,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
       CAST(value AS DECIMAL(15,2)) AS price
FROM events WHERE event_type = 'purchase'
"""

_ORDER = "event_time, source_id, line_no, quantity, price"

_TIME_COLUMNS = """
       CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', sold_at) AS BIGINT) AS id,
       CAST(sold_at AS DATE) AS date,
       CAST(year(sold_at) AS INTEGER) AS year, CAST(month(sold_at) AS INTEGER) AS month,
       CAST(day(sold_at) AS INTEGER) AS day, CAST(hour(sold_at) AS INTEGER) AS hour,
       CAST(minute(sold_at) AS INTEGER) AS minute, CAST(second(sold_at) AS INTEGER) AS second,
       CAST(dayofweek(sold_at) + 1 AS INTEGER) AS weekday
"""

_UNITS_BY_PRODUCT = """
SELECT p_name AS product_name, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_sold
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linestatus = 'O' GROUP BY p_name
"""

_REVENUE_BY_PRODUCT = """
SELECT p_name AS product_name,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linestatus = 'O' GROUP BY p_name
"""

_SPEND_BY_CUSTOMER = """
SELECT c_name AS customer_name,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total_spent
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE l_linestatus = 'O' GROUP BY c_name
"""


def _share(totals: str, measure: str) -> str:
    # Tenths of a percent, rounded half up in whole numbers.
    cents = f"CAST({measure} * 100 AS HUGEINT)"
    tenths = f"((2000 * {cents} + SUM({cents}) OVER ()) // (2 * SUM({cents}) OVER ()))"
    pct = f"CAST({tenths} AS DECIMAL(18,1)) / 10"
    return f"""
    SELECT *, CAST(pct AS VARCHAR) || '%' AS pct_label
    FROM (SELECT *, CAST({pct} AS DECIMAL(5,1)) AS pct FROM ({totals}))
    """


_PRODUCT_DIM = """
SELECT DISTINCT p_partkey AS product_id, p_name AS product_name
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_linestatus = 'O')
"""

_CUSTOMER_DIM = """
SELECT DISTINCT c_custkey AS customer_id, c_name AS customer_name
FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'O')
"""

_SALES_FACT = f"""
SELECT product_id, customer_id,
       CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', sold_at) AS BIGINT) AS time_id,
       quantity, price AS sale_prices, price AS total_amount
FROM ({_TILL})
"""


def _folded(lines: str) -> str:
    """Lines per product: units, and the cost on the first line."""
    return f"""
    SELECT product_id, SUM(quantity) AS units,
           MIN(CASE WHEN place = 1 THEN price END) AS cost
    FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {_ORDER}) AS place
          FROM ({lines}))
    GROUP BY product_id
    """


_EARLY = f"SELECT * FROM ({_RECEIVED}) WHERE event_time < {_OPENING}"
_LATE = f"SELECT * FROM ({_RECEIVED}) WHERE event_time >= {_OPENING}"
_PRICED = "CAST({cost} * CAST(1.2 AS DECIMAL(2,1)) AS DECIMAL(15,2)) AS sale_prices"
_OPENING_STOCK = f"""
SELECT product_id, CAST(units AS BIGINT) AS quantity, {_PRICED.format(cost="cost")}
FROM ({_folded(_EARLY)})
"""

_STOCK_ON_HAND = f"""
WITH moves AS (
  SELECT l_partkey AS product_id, l_shipdate AS event_time, l_orderkey AS source_id,
         l_linenumber AS line_no,
         CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS price
  FROM lineitem WHERE l_linestatus IN ('F', 'O')),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {_ORDER}) AS place FROM moves),
opened AS (
  SELECT product_id, MIN(place) AS first_place FROM placed WHERE quantity > 0 GROUP BY product_id)
SELECT p.product_id, p_name AS product_name, CAST(SUM(p.quantity) AS BIGINT) AS quantity,
       {_PRICED.format(cost="MAX(CASE WHEN p.place = o.first_place THEN p.price END)")},
       CAST(50 AS INTEGER) AS reorder_level
FROM placed p JOIN opened o ON p.product_id = o.product_id AND p.place >= o.first_place
     JOIN part ON p.product_id = p_partkey
GROUP BY p.product_id, p_name
"""


# Lines in document order: the place of a line among those of its order.
def _document_lines(lines: str) -> str:
    return f"""
    SELECT *,
           CAST(row_number() OVER (PARTITION BY source_id
                ORDER BY line_no, product_id, quantity, price) - 1 AS INTEGER) AS pos,
           MAX(event_time) OVER (PARTITION BY source_id) AS shipped,
           CAST(SUM(price) OVER (PARTITION BY source_id) AS DECIMAL(15,2)) AS total
    FROM ({lines}) JOIN part ON product_id = p_partkey
    """


_IMPORT_LINES = f"""
SELECT CAST(source_id AS VARCHAR) AS import_id, pos AS line_no, shipped AS delivery_hour,
       CAST(product_id AS VARCHAR) AS product_id, p_name AS product_name, quantity, price,
       price AS total_amount, total AS total_invoice_amount
FROM ({_document_lines(_RECEIVED)})
"""

_PURCHASE_LINES = f"""
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       total AS total_invoice_amount, o_orderdate AS timestamp, pos AS line_no,
       CAST(product_id AS VARCHAR) AS product_id, p_name AS product_name, quantity, price,
       price AS total_price, source_id
FROM ({_document_lines(_SOLD)})
     JOIN orders ON source_id = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

_CLOCK_TEXT = "strftime(timestamp, '%Y-%m-%d %H:%M:%S')"


def _json(**fields: str) -> str:
    """JSON text of one object; money keeps both decimals, which to_json would not."""
    quoted = {"customer_id", "customer_name", "product_id", "product_name", "timestamp"}
    parts = []
    for name, value in fields.items():
        mark = '"' if name in quoted else ""
        parts.append(f"""'"{name}":{mark}' || {value} || '{mark}'""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_ITEM_FIELDS = {c: c for c in ("product_id", "product_name", "quantity", "price", "total_price")}
_HEAD_FIELDS = {c: c for c in ("customer_id", "customer_name")}
_TOTAL_FIELD = {"total_invoice_amount": "total_invoice_amount"}
_TIME_FIELD = {"timestamp": _CLOCK_TEXT}

_NOTIFICATIONS = f"""
SELECT {_json(**_HEAD_FIELDS, **_TOTAL_FIELD, **_TIME_FIELD, **_ITEM_FIELDS)} AS value
FROM ({_PURCHASE_LINES})
"""

_ITEMS = f"'[' || string_agg({_json(**_ITEM_FIELDS)}, ',' ORDER BY line_no) || ']'"
_DOCUMENT = _json(**_HEAD_FIELDS, purchased_items=_ITEMS, **_TOTAL_FIELD, **_TIME_FIELD)


def purchase_messages(document_lines: int) -> str:
    """One message per order and ``document_lines`` lines; those after the first say where they start."""
    first = f"line_no // {document_lines} * {document_lines}"
    return f"""
        SELECT customer_id AS key,
               CASE WHEN {first} = 0 THEN {_DOCUMENT}
                    ELSE rtrim({_DOCUMENT}, '}}') || ',"first_line":' || ({first}) || '}}' END AS value
        FROM ({_PURCHASE_LINES})
        GROUP BY source_id, customer_id, customer_name, total_invoice_amount, timestamp, {first}"""


# Movements as the two streams write them: receipts at their delivery, sales at
# their order; at the same time receipts come first.
_STREAM_STOCK = f"""
WITH moves AS (
  SELECT product_id, product_name, delivery_hour AS event_time, 0 AS kind,
         import_id AS id_text, CAST(0 AS BIGINT) AS id, line_no, quantity, price
  FROM ({_IMPORT_LINES})
  UNION ALL
  SELECT product_id, product_name, timestamp, 1, '', source_id, line_no, -quantity, price
  FROM ({_PURCHASE_LINES})),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY product_id
            ORDER BY event_time, kind, id_text, id, line_no) AS place
  FROM moves),
opened AS (
  SELECT product_id, MIN(place) AS first_place FROM placed WHERE quantity > 0 GROUP BY product_id)
SELECT p.product_id,
       MAX(CASE WHEN p.place = o.first_place THEN p.product_name END) AS product_name,
       CAST(SUM(p.quantity) AS BIGINT) AS quantity,
       {_PRICED.format(cost="MAX(CASE WHEN p.place = o.first_place THEN p.price END)")},
       CAST(50 AS INTEGER) AS reorder_level
FROM placed p JOIN opened o ON p.product_id = o.product_id AND p.place >= o.first_place
GROUP BY p.product_id
"""

_REJECTS = """
SELECT 'purchases-000000-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') AS source_id,
       '{"customer_id":"' || o_custkey || '","purchased_items":[],"timestamp":"'
         || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' AS payload,
       'no items' AS reason
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')
UNION ALL
SELECT 'texts-000000-' || lpad(CAST(doc_id AS VARCHAR), 19, '0'), coalesce(text, '{}'), 'unreadable'
FROM documents
"""

_RECEIVED_PRODUCTS = f"SELECT DISTINCT product_id FROM ({_RECEIVED})"
_TILL_PRODUCTS = f"SELECT DISTINCT product_id FROM ({_TILL})"

ORACLES: dict[str, str] = {
    "revenue_by_minute": f"""
        SELECT CAST(year(sold_at) AS INTEGER) AS year, CAST(month(sold_at) AS INTEGER) AS month,
               CAST(day(sold_at) AS INTEGER) AS day, CAST(hour(sold_at) AS INTEGER) AS hour,
               CAST(minute(sold_at) AS INTEGER) AS minute,
               CAST(SUM(price) AS DECIMAL(25,2)) AS total_revenue,
               CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold
        FROM ({_TILL}) GROUP BY ALL
        ORDER BY year DESC, month DESC, day DESC, hour DESC, minute""",
    "revenue_by_minute_weekend": f"""
        SELECT CAST(year(sold_at) AS INTEGER) AS year, CAST(month(sold_at) AS INTEGER) AS month,
               CAST(day(sold_at) AS INTEGER) AS day, CAST(hour(sold_at) AS INTEGER) AS hour,
               CAST(minute(sold_at) AS INTEGER) AS minute,
               CAST(SUM(price) AS DECIMAL(25,2)) AS total_revenue,
               CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold
        FROM ({_TILL}) WHERE dayofweek(sold_at) IN (0, 6) GROUP BY ALL
        ORDER BY year DESC, month DESC, day DESC, hour DESC, minute""",
    "units_by_product": _UNITS_BY_PRODUCT + "ORDER BY total_sold DESC, product_name",
    "top5_products": _UNITS_BY_PRODUCT + "ORDER BY total_sold DESC, product_name LIMIT 5",
    "revenue_by_product": _REVENUE_BY_PRODUCT + "ORDER BY total_revenue DESC, product_name",
    "spend_by_customer": _SPEND_BY_CUSTOMER + "ORDER BY total_spent DESC, customer_name",
    "revenue_share": _share(_REVENUE_BY_PRODUCT, "total_revenue"),
    "spend_share": _share(_SPEND_BY_CUSTOMER, "total_spent"),
    "spend_labels": f"""
        SELECT *, format('{{:,}}', CAST(total_spent AS BIGINT)) AS label
        FROM ({_SPEND_BY_CUSTOMER})""",
    "product_dim": _PRODUCT_DIM,
    "customer_dim": _CUSTOMER_DIM,
    "time_dim": f"SELECT {_TIME_COLUMNS} FROM (SELECT DISTINCT sold_at FROM ({_TILL}))",
    "max_time_key": f"SELECT MAX(time_id) AS max_id FROM ({_SALES_FACT})",
    "sales_fact": _SALES_FACT,
    "sales_fact_lookup": _SALES_FACT,
    "new_products": f"""
        SELECT * FROM ({_PRODUCT_DIM}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_TILL}) t WHERE t.product_id = n.product_id)""",
    "new_customers": f"""
        SELECT * FROM ({_CUSTOMER_DIM}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_TILL}) t WHERE t.customer_id = n.customer_id)""",
    "current_inventory": """
        SELECT product_id, quantity, sale_prices, last_updated FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id
                    ORDER BY last_updated DESC, quantity DESC, sale_prices DESC) AS place
          FROM (SELECT l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
                       CAST(l_extendedprice AS DECIMAL(15,2)) AS sale_prices,
                       l_shipdate AS last_updated FROM lineitem))
        WHERE place = 1""",
    "current_inventory_ties": """
        SELECT i.l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS sale_prices, l_shipdate AS last_updated
        FROM lineitem i
        JOIN (SELECT l_partkey, MAX(l_shipdate) AS newest FROM lineitem GROUP BY l_partkey) m
        ON i.l_partkey = m.l_partkey AND i.l_shipdate = m.newest""",
    "restock_from_empty": f"""
        SELECT product_id, p_name AS product_name, CAST(units AS BIGINT) AS quantity,
               {_PRICED.format(cost="cost")}, CAST(50 AS INTEGER) AS reorder_level
        FROM ({_folded(_RECEIVED)}) JOIN part ON product_id = p_partkey""",
    "restock_merge": f"""
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(COALESCE(s.quantity, 0) + COALESCE(i.units, 0) AS BIGINT) AS quantity,
               COALESCE(s.sale_prices,
                        CAST(i.cost * CAST(1.2 AS DECIMAL(2,1)) AS DECIMAL(15,2))) AS sale_prices,
               CAST(50 AS INTEGER) AS reorder_level
        FROM ({_OPENING_STOCK}) s FULL OUTER JOIN ({_folded(_LATE)}) i
             ON s.product_id = i.product_id
             JOIN part ON p_partkey = COALESCE(s.product_id, i.product_id)""",
    "sale_decrement": f"""
        SELECT s.product_id, p_name AS product_name,
               CAST(s.quantity - i.units AS BIGINT) AS quantity, s.sale_prices,
               CAST(50 AS INTEGER) AS reorder_level
        FROM ({_OPENING_STOCK}) s JOIN ({_folded(_SOLD)}) i ON s.product_id = i.product_id
             JOIN part ON p_partkey = s.product_id""",
    "stock_on_hand": _STOCK_ON_HAND,
    "stock_roll_forward": _STOCK_ON_HAND,
    "stock_reorder_levels": f"""
        SELECT s.* EXCLUDE (reorder_level), CAST(p_size * 2 AS INTEGER) AS reorder_level
        FROM ({_STOCK_ON_HAND}) s JOIN part ON s.product_id = p_partkey""",
    "low_stock": f"SELECT * FROM ({_STOCK_ON_HAND}) WHERE quantity <= reorder_level",
    "oversell_guard": f"""
        SELECT product_id, source_id, line_no, event_time, quantity, price, fulfilled FROM (
          SELECT r.*, CAST(LEAST(r.quantity, GREATEST(0, s.quantity - COALESCE(
                   SUM(r.quantity) OVER (PARTITION BY r.product_id
                     ORDER BY r.event_time, r.source_id, r.line_no, r.quantity, r.price
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS fulfilled
          FROM ({_SOLD}) r JOIN ({_OPENING_STOCK}) s ON r.product_id = s.product_id)
        WHERE fulfilled > 0""",
    "import_items": f"SELECT * EXCLUDE (total_invoice_amount) FROM ({_IMPORT_LINES})",
    "import_invoices": f"""
        SELECT DISTINCT import_id, delivery_hour, total_invoice_amount FROM ({_IMPORT_LINES})""",
    "import_rejects": """
        SELECT CAST(o_orderkey AS VARCHAR) AS source_id, 'no items' AS reason FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""",
    "purchase_lines": f"SELECT * EXCLUDE (source_id) FROM ({_PURCHASE_LINES})",
    "notifications": _NOTIFICATIONS,
    "purchase_messages": purchase_messages(DOCUMENT_LINES),
    "purchase_rejects": _REJECTS,
    "line_amounts": """
        SELECT l_partkey AS product_id, l_orderkey AS import_id, l_linenumber AS line_no,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS total_amount,
               CAST(p_retailprice AS DECIMAL(15,2)) AS price,
               CAST(CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(15,2))
                    AS DECIMAL(25,2)) AS expected_amount,
               CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(15,2))
                 = CAST(l_extendedprice AS DECIMAL(15,2)) AS amount_ok
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "invoice_totals": f"""
        SELECT o_orderkey AS import_id,
               CAST(o_totalprice AS DECIMAL(15,2)) AS total_invoice_amount, line_total,
               CAST(o_totalprice AS DECIMAL(15,2)) = line_total AS total_ok
        FROM orders JOIN (
          SELECT source_id, CAST(SUM(price) AS DECIMAL(25,2)) AS line_total
          FROM ({_RECEIVED}) GROUP BY source_id) ON source_id = o_orderkey""",
    "pk_violations": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "fk_orphans": f"""
        SELECT product_id, COUNT(*) AS lines FROM ({_RECEIVED})
        WHERE product_id NOT IN ({_TILL_PRODUCTS}) GROUP BY product_id""",
    "null_violations": f"""
        WITH r AS ({_RECEIVED_PRODUCTS}), t AS ({_TILL_PRODUCTS}),
        missing AS (SELECT COUNT(*) AS n FROM r WHERE product_id NOT IN (SELECT product_id FROM t))
        SELECT 'product_id' AS column_name, CAST(0 AS BIGINT) AS nulls
        UNION ALL SELECT 'product_name', n FROM missing
        UNION ALL SELECT 'last_sold', n FROM missing""",
    "stream_import_items": f"""
        SELECT import_id, product_id, product_name, quantity, price, total_amount
        FROM ({_IMPORT_LINES})""",
    "stream_import_invoices": f"""
        SELECT DISTINCT import_id, delivery_hour, total_invoice_amount FROM ({_IMPORT_LINES})""",
    "stream_sales_fact": f"""
        SELECT product_id, customer_id,
               CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', timestamp) AS BIGINT) AS time_id,
               quantity, price AS sale_prices, total_price AS total_amount
        FROM ({_PURCHASE_LINES})""",
    "stream_star_reports": _SPEND_BY_CUSTOMER,
    "stream_revenue_by_minute": f"""
        SELECT CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
               CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour,
               CAST(minute(timestamp) AS INTEGER) AS minute,
               CAST(SUM(total_price) AS DECIMAL(25,2)) AS total_revenue,
               CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold
        FROM ({_PURCHASE_LINES}) GROUP BY ALL""",
    "stream_rejects": _REJECTS,
    "stream_stock": _STREAM_STOCK,
    "stream_inventory": _STREAM_STOCK,
    "stream_inventory_late": _STREAM_STOCK,
    "stream_notifications": _NOTIFICATIONS,
    "stream_archive": f"SELECT * EXCLUDE (total_invoice_amount) FROM ({_IMPORT_LINES})",
    "stream_oversell": f"""
        SELECT source_id, line_no, customer_id, product_id, quantity, fulfilled FROM (
          SELECT 'purchases-' || lpad(CAST(r.line_no // {DOCUMENT_LINES} AS VARCHAR), 6, '0') || '-'
                   || lpad(CAST(r.source_id AS VARCHAR), 19, '0') AS source_id,
                 r.line_no, r.customer_id, r.product_id, r.quantity,
                 CAST(LEAST(r.quantity, GREATEST(0, s.quantity - COALESCE(
                   SUM(r.quantity) OVER (PARTITION BY r.product_id
                     ORDER BY r.line_no // {DOCUMENT_LINES}, r.source_id, r.line_no
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS fulfilled
          FROM ({_PURCHASE_LINES}) r JOIN ({_OPENING_STOCK}) s ON r.product_id = CAST(s.product_id AS VARCHAR))
        WHERE fulfilled > 0""",
}
