"""Independent SQL (DuckDB dialect) for every query in ``stellate.queries``.

Each statement computes the operator's expected result directly from the
supplied tables, with the same stand-ins, slices and column names as the
Spark side. Dense keys are ``row_number()`` in business-key order; a
continued sequence adds the earlier row count.
"""

from __future__ import annotations

# Stand-in staging tables (twins of stellate.standins).
COUNTRY = """SELECT CAST(n.n_nationkey AS VARCHAR) AS country_code, n.n_name AS country_name, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""
CUSTOMER = """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
  CAST(c_nationkey AS VARCHAR) AS country_code, c_mktsegment AS customer_type FROM customer"""
PRODUCT = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS standard_price, p_size FROM part"""
SALES = """SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) || '-'
    || CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
  CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS transaction_date,
  CAST(o.o_custkey AS VARCHAR) AS customer_id, CAST(l.l_partkey AS VARCHAR) AS product_id,
  CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS quantity,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
  l.l_returnflag AS payment_mode
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

PRODUCT_COLS = "product_id, product_name, category, standard_price"
URL = "'https://archive.example/player/'"
EPOCH = "date_diff('second', TIMESTAMP '1970-01-01', {})"


def _epoch(c: str) -> str:
    return EPOCH.format(c)


# Orders summed per customer id first, names merged afterwards.
CUSTOMER_TOTALS = """WITH per_id AS (
  SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY o_custkey),
named AS (SELECT c_name AS who, SUM(amount) AS spent FROM customer, per_id WHERE c_custkey = o_custkey GROUP BY c_name)"""

DIMS_FOR_LOOKUP = f"""co AS (SELECT *, row_number() OVER (ORDER BY country_code) AS country_key
        FROM ({COUNTRY}) x WHERE region <> 'ASIA'),
  cu AS (SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key
        FROM ({CUSTOMER}) x WHERE customer_type <> 'BUILDING'),
  pr AS (SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM ({PRODUCT}) x)"""

LOOKUP_JOINS = """LEFT JOIN cu ON {s}.customer_id = cu.customer_id
  LEFT JOIN pr ON {s}.product_id = pr.product_id
  LEFT JOIN co ON cu.country_code = co.country_code"""

ARCHIVE_GAMES = f"""SELECT {URL} || c.c_name || '/games/' || strftime(o.o_orderdate, '%Y/%m') AS url,
    strftime(o.o_orderdate, '%Y/%m') AS month, o.o_orderkey AS game_id,
    {_epoch('o.o_orderdate')} AS end_time_epoch, o.o_orderstatus AS result
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

FACT_COLS = ["transaction_date", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
             "payment_mode", "customer_key", "product_key", "country_key"]


def _case_cols(cols, s="s", t="t", key="transaction_id"):
    return ",\n  ".join(f"CASE WHEN {s}.{key} IS NOT NULL THEN {s}.{c} ELSE {t}.{c} END AS {c}" for c in cols)


ORACLE: dict[str, str] = {
    "above_average_customers": CUSTOMER_TOTALS + """
SELECT who AS "Customer Name", CAST(spent AS DECIMAL(38,2)) AS "Total Sales"
FROM (SELECT who, spent, AVG(spent) OVER () AS middle FROM named) WHERE spent > middle""",

    "sales_by_customer": CUSTOMER_TOTALS + """
SELECT who AS "Customer Name", CAST(spent AS DECIMAL(38,2)) AS "Total Sales" FROM named""",

    "report_precision": """WITH exact AS (
  SELECT o_custkey, SUM(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(28,6)) * CAST(0.001 AS DECIMAL(4,3))) AS amount
  FROM orders GROUP BY o_custkey)
SELECT c_name AS "Customer Name", CAST(SUM(amount) AS DECIMAL(38,6)) AS "Total Sales"
FROM customer, exact WHERE c_custkey = o_custkey GROUP BY c_name""",

    "top_product": """SELECT what AS "Product Name", CAST(earned AS DECIMAL(38,2)) AS "Total Sales" FROM (
  SELECT what, earned, rank() OVER (ORDER BY earned DESC NULLS FIRST, what) AS place FROM (
    SELECT p_name AS what, SUM(part_total) AS earned FROM part, (
      SELECT l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS part_total FROM lineitem GROUP BY l_partkey)
    WHERE p_partkey = l_partkey GROUP BY p_name)) WHERE place = 1""",

    "sales_by_country": """SELECT c.c_nationkey AS "CountryName",
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS "Total Sales"
FROM customer c INNER JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_nationkey ORDER BY "Total Sales" DESC NULLS FIRST""",

    "frequent_buyers": """WITH bought AS (
  SELECT o_custkey, SUM(CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END) AS times FROM orders GROUP BY o_custkey)
SELECT who AS "Customer Name", CAST(times AS BIGINT) AS "Number Of Purchase" FROM (
  SELECT c_name AS who, SUM(times) AS times FROM bought, customer WHERE o_custkey = c_custkey GROUP BY c_custkey, c_name)
WHERE times > 5 ORDER BY times DESC""",

    "report_lines": CUSTOMER_TOTALS + """
SELECT printf('%-15s %10s', who, CAST(CAST(spent AS DECIMAL(38,2)) AS VARCHAR)) AS line
FROM (SELECT who, spent, AVG(spent) OVER () AS middle FROM named) WHERE spent > middle""",

    "strict_cast": """SELECT o_orderkey,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DECIMAL(18,2)) AS amount FROM orders""",

    "csv_short_rows": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
  CASE WHEN c_acctbal < 0 OR c_acctbal IS NULL THEN NULL WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment
FROM customer""",

    "csv_scan": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents""",

    "staging_replace": f"SELECT customer_id, customer_name, country_code, customer_type FROM ({CUSTOMER}) c",

    "staging_append": f"""WITH c AS ({CUSTOMER})
SELECT * FROM c UNION ALL SELECT * FROM c
UNION ALL SELECT customer_id, lower(customer_name), country_code, customer_type FROM c""",

    "lineage_columns": """SELECT COUNT(*) AS n_rows, COUNT(*) AS n_row_ids, CAST(1 AS BIGINT) AS n_load_ids
FROM customer""",

    "load_report": f"""SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'product', COUNT(*) FROM part
UNION ALL SELECT 'country', COUNT(*) FROM ({COUNTRY}) x""",

    "dim_surrogate_key": f"""SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM ({CUSTOMER}) c""",

    "fact_lookup": f"""WITH {DIMS_FOR_LOOKUP},
  st AS ({SALES})
SELECT st.*, cu.customer_key, pr.product_key, co.country_key,
  CAST(1 AS BIGINT) AS first_key, TRUE AS keys_dense
FROM st {LOOKUP_JOINS.format(s='st')}""",

    "key_continuation": f"""WITH p AS ({PRODUCT}),
  old AS (SELECT {PRODUCT_COLS}, row_number() OVER (ORDER BY product_id) AS product_key FROM p WHERE p_size <= 25)
SELECT * FROM old
UNION ALL
SELECT {PRODUCT_COLS}, (SELECT COUNT(*) FROM old) + row_number() OVER (ORDER BY product_id) FROM p WHERE p_size > 25""",

    "rebuild_table": f"""SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM ({CUSTOMER}) c""",

    "pk_violations": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",

    "fk_violations": """SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = o.o_custkey)""",

    "required_columns": """WITH o AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus
  FROM orders)
SELECT 'o_orderkey' AS column_name, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS n_nulls FROM o
UNION ALL SELECT 'o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM o
UNION ALL SELECT 'o_orderstatus', COUNT(*) FILTER (WHERE o_orderstatus IS NULL) FROM o""",

    "full_load_dim": f"""SELECT {PRODUCT_COLS},
  COUNT(*) OVER () + row_number() OVER (ORDER BY product_id) AS product_key FROM ({PRODUCT}) p""",

    "full_load_fact": f"""WITH co AS (SELECT *, COUNT(*) OVER () + row_number() OVER (ORDER BY country_code) AS country_key
        FROM ({COUNTRY}) x WHERE region <> 'ASIA'),
  cu AS (SELECT *, COUNT(*) OVER () + row_number() OVER (ORDER BY customer_id) AS customer_key
        FROM ({CUSTOMER}) x WHERE customer_type <> 'BUILDING'),
  pr AS (SELECT product_id, COUNT(*) OVER () + row_number() OVER (ORDER BY product_id) AS product_key
        FROM ({PRODUCT}) x),
  st AS ({SALES})
SELECT st.*, cu.customer_key, pr.product_key, co.country_key,
  COUNT(*) OVER () + 1 AS first_key, TRUE AS keys_dense
FROM st {LOOKUP_JOINS.format(s='st')}""",

    "truncate_table": """SELECT 'dwh.customers_dim' AS table_name, COUNT(*) AS row_count
FROM customer WHERE FALSE""",

    "merge_dim": f"""WITH p AS ({PRODUCT}),
  t AS (SELECT {PRODUCT_COLS}, row_number() OVER (ORDER BY product_id) AS product_key FROM p WHERE p_size <= 35),
  s AS (SELECT product_id, upper(product_name) AS product_name, category,
          CAST(CAST(CAST(standard_price AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)) AS VARCHAR) AS standard_price
        FROM p WHERE p_size >= 15)
SELECT t.product_id,
  {_case_cols(['product_name', 'category', 'standard_price'], key='product_id')},
  t.product_key
FROM t LEFT JOIN s ON t.product_id = s.product_id
UNION ALL
SELECT s.product_id, s.product_name, s.category, s.standard_price,
  (SELECT COUNT(*) FROM t) + row_number() OVER (ORDER BY s.product_id)
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.product_id = s.product_id)""",

    "merge_fact": f"""WITH {DIMS_FOR_LOOKUP},
  st AS ({SALES}),
  sa AS (SELECT * FROM st WHERE transaction_date < '1998-01-01'),
  sb AS (SELECT transaction_id, transaction_date, customer_id, product_id, quantity, unit_price, total_amount,
           lower(payment_mode) AS payment_mode FROM st WHERE transaction_date >= '1997-01-01'),
  ka AS (SELECT sa.*, cu.customer_key, pr.product_key, co.country_key
         FROM sa {LOOKUP_JOINS.format(s='sa')}),
  kb AS (SELECT sb.*, cu.customer_key, pr.product_key, co.country_key
         FROM sb {LOOKUP_JOINS.format(s='sb')})
SELECT t.transaction_id,
  {_case_cols(FACT_COLS)},
  CAST(1 AS BIGINT) AS first_key, TRUE AS keys_dense
FROM ka t LEFT JOIN kb s ON t.transaction_id = s.transaction_id
UNION ALL
SELECT kb.*, CAST(1 AS BIGINT) AS first_key, TRUE AS keys_dense
FROM kb WHERE NOT EXISTS (SELECT 1 FROM sa WHERE sa.transaction_id = kb.transaction_id)""",

    "merge_null_keys": f"""WITH c AS ({CUSTOMER})
SELECT customer_name, country_code, customer_type FROM c WHERE customer_type = 'AUTOMOBILE'
UNION ALL
SELECT customer_name, country_code, customer_type FROM c WHERE customer_type = 'AUTOMOBILE'""",

    "merge_duplicate_check": f"""WITH c AS ({CUSTOMER}),
  src AS (SELECT * FROM c UNION ALL SELECT * FROM c WHERE customer_type IN ('MACHINERY', 'HOUSEHOLD')),
  tgt AS (SELECT * FROM c WHERE customer_type <> 'HOUSEHOLD')
SELECT customer_id, COUNT(*) AS n FROM src GROUP BY customer_id
HAVING COUNT(*) > 1 AND customer_id IN (SELECT customer_id FROM tgt)""",

    "error_log_summary": """SELECT * FROM (VALUES
  ('report.CAST_CUSTOMER_NAME', '22018', CAST(1 AS BIGINT)),
  ('report.PRICE_RATIO', '22012', CAST(1 AS BIGINT)),
  ('fullload.LOAD_SALES_TRANSACTIONS_FACT', '42P01', CAST(1 AS BIGINT))
) AS v(procedure_name, error_code, n_errors)""",

    "star_row_counts": f"""SELECT 'countries_dim' AS table_name, COUNT(*) AS row_count FROM ({COUNTRY}) x
UNION ALL SELECT 'customers_dim', COUNT(*) FROM customer
UNION ALL SELECT 'products_dim', COUNT(*) FROM part
UNION ALL SELECT 'sales_transactions_fact', COUNT(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",

    "job_group_counts": f"""WITH f AS (SELECT COUNT(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT 'fullload.LOAD_COUNTRY_DIM' AS job, COUNT(*) AS row_count FROM ({COUNTRY}) x
UNION ALL SELECT 'fullload.LOAD_CUSTOMER_DIM', COUNT(*) FROM customer
UNION ALL SELECT 'fullload.LOAD_PRODUCT_DIM', COUNT(*) FROM part
UNION ALL SELECT 'fullload.LOAD_SALES_TRANSACTIONS_FACT', n FROM f
UNION ALL SELECT 'merge_load.MERGE_' || t, 0 FROM (VALUES ('COUNTRY_DIM'), ('CUSTOMER_DIM'), ('PRODUCT_DIM'), ('SALES_TRANSACTIONS_FACT')) v(t)
UNION ALL SELECT 'rows of the fact', n FROM f""",

    "profiles": f"""SELECT 'user_' || CAST(user_id AS VARCHAR) AS username,
  MAX({_epoch('ts')}) AS last_online_epoch, MIN({_epoch('ts')}) AS joined_epoch
FROM events GROUP BY user_id""",

    "archive_listing": f"""SELECT DISTINCT c.c_name AS username,
  {URL} || c.c_name || '/games/' || strftime(o.o_orderdate, '%Y/%m') AS url
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",

    "month_range": f"""SELECT o_orderkey,
  {URL} || CAST(o_custkey AS VARCHAR) || '/games/' || strftime(o_orderdate, '%Y/%m') AS url
FROM orders WHERE strftime(o_orderdate, '%Y/%m') BETWEEN '1997/01' AND '1997/06'""",

    "bad_months": """WITH m AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y') || CASE WHEN month(o_orderdate) % 3 = 0 THEN '-' ELSE '/' END
    || strftime(o_orderdate, '%m') AS month FROM orders)
SELECT o_orderkey, month FROM m WHERE length(month) > 0 AND COALESCE(substr(month, 5, 1), '') <> '/'""",

    "games_incremental": f"""SELECT url, game_id, end_time_epoch, result FROM ({ARCHIVE_GAMES}) g
WHERE month BETWEEN '1997/01' AND '1997/06' AND month <> '1997/03'""",

    "archive_ledger": f"""SELECT DISTINCT url FROM ({ARCHIVE_GAMES}) g WHERE month BETWEEN '1997/01' AND '1997/06'""",

    "missing_archives": f"""SELECT url, CAST(CASE WHEN month = '1997/03' THEN 0 ELSE COUNT(*) END AS BIGINT) AS n_games
FROM ({ARCHIVE_GAMES}) g WHERE month BETWEEN '1997/01' AND '1997/06' GROUP BY url, month""",

    "json_source_tables": f"""WITH n AS (SELECT COUNT(*) AS customers FROM customer),
a AS (SELECT COUNT(DISTINCT CAST(o_custkey AS VARCHAR) || strftime(o_orderdate, '%Y/%m')) AS archives
      FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)),
g AS (SELECT COUNT(*) AS games FROM ({ARCHIVE_GAMES}) x WHERE month BETWEEN '1997/01' AND '1997/06' AND month <> '1997/03')
SELECT * FROM (
  SELECT 'landing.players_profiles' AS table_name, customers AS row_count, customers AS row_ids, CAST(1 AS BIGINT) AS loads FROM n
  UNION ALL SELECT 'landing.players_profiles__clubs', 2 * customers, 2 * customers, 1 FROM n
  UNION ALL SELECT 'landing.players_archives', archives, archives, 1 FROM a
  UNION ALL SELECT 'landing.players_games', games, games, 2 FROM g
  UNION ALL SELECT 'landing.players_online_status', 2 * customers, 2 * customers, 2 FROM n)""",

    "json_child_tables": """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS position,
  turn, role, text FROM conversations""",

    "online_status": f"""SELECT 'user_' || CAST(user_id AS VARCHAR) AS username, arg_max(event_type, ts) AS online_status,
  MAX({_epoch('ts')}) AS last_login_date
FROM events GROUP BY user_id""",

    "online_status_stream": f"""SELECT 'user_' || CAST(user_id AS VARCHAR) AS username, event_type AS online_status,
  {_epoch('ts')} AS last_login_date FROM events""",

    "stream_replays": """SELECT event_id, user_id, event_type FROM events""",

    "atomic_publish": """SELECT 'dwh.orders' AS table_name, COUNT(*) AS row_count, CAST(SUM(o_custkey) AS BIGINT) AS key_sum, CAST(1 AS BIGINT) AS refused
FROM orders UNION ALL SELECT 'dwh.customers', COUNT(*), CAST(SUM(c_custkey) AS BIGINT), 1 FROM customer""",

    "namespaces": """SELECT 'buyers' AS namespace, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'sellers', s_suppkey, s_name FROM supplier""",

    "source_location": """SELECT 'region' AS source, CAST(r_regionkey AS VARCHAR) AS key, r_name AS name FROM region
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation""",

    "flatten_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k, user_id FROM events""",

    "child_table": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
  turn, role, text FROM conversations""",

    "missing_lists": """WITH c AS (
  SELECT conv_id, role, text, COUNT(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT conv_id, role, text FROM c WHERE n > 2""",

    "snake_case_columns": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",

    "schema_growth": """SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",

    "tracked_users": """SELECT event_id, 'user_' || CAST(user_id AS VARCHAR) AS username FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""",
}

# Same rows as the plain merge: only the physical layout of the fact differs.
ORACLE["merge_fact_partitioned"] = ORACLE["merge_fact"]
_EMPTY = "CASE payment_mode WHEN 'R' THEN '' WHEN 'A' THEN NULL ELSE transaction_date END AS transaction_date"
ORACLE["merge_fact_empty_dates"] = (
    ORACLE["merge_fact"].replace("sa AS (SELECT * FROM st", f"sa AS (SELECT * REPLACE ({_EMPTY}) FROM st")
    .replace("sb AS (SELECT transaction_id, transaction_date,", f"sb AS (SELECT transaction_id, {_EMPTY},")
    .replace("FROM st WHERE transaction_date", "FROM st WHERE st.transaction_date"))
ORACLE["enforced_constraints"] = f"""WITH cu AS (SELECT * FROM ({CUSTOMER}) x WHERE customer_type <> 'BUILDING'), s AS ({SALES}),
  a AS (SELECT count(*) AS fact_rows, count(DISTINCT s.customer_id) FILTER (s.customer_id IN (SELECT customer_id FROM cu)) AS used,
               count(*) FILTER (s.payment_mode = 'R') AS wrong FROM s)
SELECT attempt, sqlstate, CAST(violations AS BIGINT) AS violations, fact_rows, CAST(first_customer_key AS BIGINT) AS first_customer_key FROM (
  SELECT 'a dimension loaded anew without the fact' AS attempt, '23503' AS sqlstate, used AS violations, fact_rows, 1 AS first_customer_key FROM a
  UNION ALL SELECT 'merged rows with unknown keys', '23503', wrong, fact_rows, 1 FROM a
  UNION ALL SELECT 'a group whose third job fails', '42703', 0, fact_rows, 1 FROM a
  UNION ALL SELECT 'a group of full loads', '00000', 0, fact_rows, (SELECT count(*) FROM cu) + 1 FROM a)"""
ORACLE["schema_type_change"] = """SELECT CAST(o_orderkey AS BIGINT) AS id,
  CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS BIGINT) WHEN 'O' THEN CAST(o_custkey AS BIGINT) + 5000000000 ELSE 7 END AS n,
  CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(24,4))
       WHEN 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(24,4)) ELSE CAST(o_custkey AS DECIMAL(24,4)) END AS price,
  CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN CAST(o_custkey AS VARCHAR) ELSE 'true' END AS note,
  CASE o_orderstatus WHEN 'O' THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS customer,
  CASE o_orderstatus WHEN 'O' THEN 'C' || CAST(o_custkey AS VARCHAR) END AS customer__v_string
FROM orders"""
