"""Oracle SQL (DuckDB) per registered query key: the analyses of
``oracle_analyses.py`` and the operator-level catalog; see ``oracle.py``."""

from __future__ import annotations

from mktlens.plans.oracle import half_up_div, with_bindings
from mktlens.plans.oracle_analyses import COSTED, EVENT, EVENTS_LOOKUP
from mktlens.plans.oracle_analyses import SQL as ANALYSES

SQL: dict[str, str] = dict(ANALYSES)


# ---------------------------------------------------------------------------
# Operator-level catalog
# ---------------------------------------------------------------------------
_MP = '@([a-zA-Z0-9_.]+)'
SQL.update({
    "scan_tables": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "view_sink": "SELECT o_custkey AS customer_id, COUNT(*) AS n_orders FROM orders GROUP BY 1",
    "ctas_sink": SQL["campaign_catalogue"],
    "project_alias": """SELECT o_orderkey AS order_name, o_custkey AS customer_id,
                               CAST(o_totalprice AS DECIMAL(18,2)) AS order_gross_sales FROM orders""",
    "project_star": "SELECT *, c_acctbal > 0 AS in_credit FROM customer",
    "cte_chain": with_bindings(["items_sold"], [], """
        SELECT customer_id, CAST(SUM(cost_of_goods_gbp) AS DECIMAL(38,2)) AS cogs FROM items_sold GROUP BY customer_id"""),
    "nested_cte": """
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
        dupes AS (SELECT o_custkey FROM o GROUP BY o_custkey, d HAVING COUNT(*) > 1)
        SELECT o_orderkey, o_custkey FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM dupes)""",
    "derived_table": """
        SELECT o.o_orderkey, f.first_order_date FROM orders o
        LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order_date FROM orders GROUP BY 1) f
          ON f.o_custkey = o.o_custkey""",
    "lateral_alias": """SELECT o_orderkey, year(CAST(o_orderdate AS DATE)) AS order_year,
                               order_year - order_year % 10 AS order_decade FROM orders""",
    "ratio_of_aggregates": f"""
        SELECT o_custkey AS customer_id, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
               COUNT(*) AS total_orders,
               CAST({half_up_div('total_revenue', 2, 'total_orders', 4)} AS DECIMAL(38,4)) AS aov
        FROM orders GROUP BY 1""",
    "alias_predicate": "SELECT o_orderkey, year(o_orderdate) AS order_year FROM orders WHERE order_year = 1997",
    "quoted_identifier": with_bindings(["organic_social_content"], [], 'SELECT content_id, "date" FROM organic_social_content'),
    "case_bucket": """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid'
                             ELSE NULL END AS bucket FROM orders""",
    "filter_compare": """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 5 AND l_discount >= 0.05
                         AND l_linenumber <= 3 AND l_tax > 0 AND l_returnflag = 'R'""",
    "filter_between_dates": "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'",
    "filter_between_ints": """SELECT o_orderkey, date_diff('month', DATE '1998-06-01', CAST(o_orderdate AS DATE)) AS m FROM orders
                              WHERE m BETWEEN -12 AND 12""",
    "between_flag": """
        SELECT event_id, CASE WHEN ts BETWEEN prev_ts AND prev_ts + INTERVAL 1 HOUR THEN 'Y' ELSE 'N' END AS flag
        FROM (SELECT event_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events)""",
    "filter_in_list": "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "semi_join": """SELECT l_orderkey, l_linenumber FROM lineitem
                    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "null_aware_anti_join": """SELECT c_custkey FROM customer
                               WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""",
    "filter_nulls": with_bindings(["halo_sessions_source"], [], """
        SELECT visit_key, visitor_id FROM halo_sessions_source WHERE customer_id IS NULL AND geonetwork_city IS NOT NULL"""),
    "filter_like": "SELECT p_partkey FROM part WHERE lower(p_name) LIKE '%widget%' OR lower(p_name) LIKE 'red%'",
    "filter_not_like": "SELECT c_custkey FROM customer WHERE c_name NOT LIKE 'Customer#0000001%'",
    "filter_boolean_tree": """SELECT l_orderkey, l_linenumber FROM lineitem
                              WHERE (l_returnflag = 'R' AND l_quantity > 40) OR (l_returnflag = 'A' AND l_discount = 0)
                                 OR (l_linestatus = 'O' AND l_tax > 0.07)""",
    "filter_contains": "SELECT doc_id FROM documents WHERE contains(text, '@')",
    "filter_length": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9",
    "having": "SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1 HAVING n_orders > 12",
    "left_equi_join": "SELECT o.o_orderkey, c.c_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "multi_key_join": """SELECT l.l_orderkey, l.l_linenumber, p.n_pair FROM lineitem l
                         LEFT JOIN (SELECT l_partkey, l_suppkey, COUNT(*) AS n_pair FROM lineitem GROUP BY 1, 2) p
                           ON l.l_partkey = p.l_partkey AND l.l_suppkey = p.l_suppkey""",
    "using_join": with_bindings(["customer_details"], [], """
        SELECT customer_id, o.order_name, c.customer_gender
        FROM (SELECT o_custkey AS customer_id, o_orderkey AS order_name FROM orders) o
        LEFT JOIN customer_details c USING (customer_id)"""),
    "function_key_join": with_bindings(["journey_orders", "regional_index"], [], """
        SELECT o.wix_order_name, r.region FROM journey_orders o
        LEFT JOIN regional_index r ON upper(o.shipping_country) = r.shipping_country"""),
    "constant_row_join": with_bindings([], [("events_lookup", EVENTS_LOOKUP), ("event", EVENT)],
                                       "SELECT o.o_orderkey, e.event_name FROM orders o LEFT JOIN event e ON TRUE"),
    "acquisition_cohort_filter": """
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT o.o_orderkey, q.acquisition_date FROM o
        JOIN (SELECT o_custkey, MIN(d) AS acquisition_date FROM o GROUP BY 1) q ON q.o_custkey = o.o_custkey
        WHERE q.acquisition_date BETWEEN DATE '1995-01-01' AND DATE '1995-01-31'""",
    "group_by_ordinal": "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2",
    "group_by_named": """SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
                         FROM lineitem GROUP BY l_suppkey""",
    "agg_sum": """SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
                         CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty FROM lineitem GROUP BY 1""",
    "agg_min": "SELECT o_custkey, MIN(o_orderdate) AS first_ts FROM orders GROUP BY 1",
    "agg_max": """SELECT o_custkey, MAX(o_orderpriority) AS max_priority, MAX(o_orderstatus) AS max_status,
                         MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS max_price FROM orders GROUP BY 1""",
    "agg_avg": with_bindings(["customer_ratings"], [],
                             "SELECT customer_id, round(avg(rating), 1) AS avg_rating FROM customer_ratings GROUP BY 1"),
    "agg_count_star": "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1",
    "agg_count_col": with_bindings(["halo_sessions_source"], [],
                                   "SELECT geonetwork_city, COUNT(customer_id) AS n_known FROM halo_sessions_source GROUP BY 1"),
    "agg_count_distinct": """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_suppkey) AS suppliers
                             FROM lineitem GROUP BY 1""",
    "agg_count_row_nonnull": with_bindings(["halo_sessions_source"], [], """
        SELECT transactions, COUNT(CASE WHEN customer_id IS NOT NULL AND visitor_id IS NOT NULL
                                         AND geonetwork_city IS NOT NULL THEN 1 END) AS full_rows
        FROM halo_sessions_source GROUP BY 1"""),
    "agg_conditional_sum": """SELECT l_orderkey, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) END) AS BIGINT)
                                     AS returned_qty FROM lineitem GROUP BY 1""",
    "agg_conditional_count": """
        SELECT o_custkey, COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS urgent_orders,
               COUNT(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus END) AS urgent_statuses
        FROM orders GROUP BY 1""",
    "agg_guarded_ratio_sum": with_bindings(["items_sold"], [("costed", COSTED)],
                                           "SELECT order_name, CAST(round(returns, 2) AS DECIMAL(38,2)) AS returns FROM costed"),
    "agg_coalesce": with_bindings(["halo_sessions_source"], [], """
        SELECT geonetwork_city, CAST(SUM(COALESCE(customer_id, 0)) AS BIGINT) AS sum_of_coalesced,
               CAST(COALESCE(SUM(customer_id), 0) AS BIGINT) AS coalesced_sum
        FROM halo_sessions_source GROUP BY 1"""),
    "agg_listagg": "SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1",
    "distinct_rows": "SELECT DISTINCT p_name, p_type FROM part",
    "presence_flag": """
        SELECT c.c_custkey, CASE WHEN l.c_custkey IS NOT NULL THEN 'Y' ELSE 'N' END AS ordered_2001
        FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE year(o_orderdate) = 2001) l
          ON c.c_custkey = l.c_custkey""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(l_partkey) AS n FROM lineitem GROUP BY 1, 2
                         HAVING COUNT(l_partkey) > 1""",
    "first_order_date": "SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS acquisition_date FROM orders GROUP BY 1",
    "window_lag": with_bindings(["customer_orders"], [], """
        SELECT customer_id, order_name, CASE WHEN order_sequence > 1 THEN
               LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_sequence) END AS prior_order_date
        FROM customer_orders"""),
    "window_gap_days": with_bindings(["customer_orders"], [], """
        SELECT customer_id, order_name,
               date_diff('day', LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_sequence), order_date) AS gap_days
        FROM customer_orders"""),
    "window_row_number": with_bindings(["customer_orders"], [], """
        SELECT customer_id, order_name,
               ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_gross_sales DESC, order_name) AS rank_by_value,
               order_sequence - rank_by_value AS drift
        FROM customer_orders"""),
    "window_moving_avg": with_bindings(["customer_orders_geo"], [], """
        SELECT shipping_city, month, n_orders,
               round(avg(n_orders) OVER (PARTITION BY shipping_city ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2)
                   AS avg_l3m
        FROM (SELECT shipping_city, CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS n_orders
              FROM customer_orders_geo GROUP BY 1, 2)"""),
    "order_by": "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2",
    "union_all": """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
                    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""",
    "union_variants": SQL["name_variants"],
    "fn_case_fold": "SELECT c_custkey, lower(c_name) AS lower_name, upper(c_mktsegment) AS seg FROM customer",
    "fn_left": with_bindings(["purchase_orders"], [],
                             "SELECT purchaseorder_id, left(date_created, 4) AS y, left(date_created, 7) AS ym FROM purchase_orders"),
    "fn_concat": "SELECT p_partkey, p_name || ' - ' || CASE WHEN p_size > 25 THEN p_brand END AS label FROM part",
    "fn_replace": "SELECT p_partkey, replace(p_name, ' ', '') AS squeezed FROM part",
    "fn_length": "SELECT doc_id, length(text) AS n_chars_text FROM documents",
    "fn_contains": "SELECT page_id, contains(html, '@') AS has_at FROM pages",
    "fn_regexp_first": with_bindings(["organic_social_content"], [],
                                     f"SELECT content_id, regexp_extract_all(lower(caption), '{_MP}')[1] AS m1 FROM organic_social_content"),
    "fn_regexp_nth": with_bindings(["organic_social_content"], [], f"""
        SELECT content_id, regexp_extract_all(lower(caption), '{_MP}')[2] AS m2,
               regexp_extract_all(lower(caption), '{_MP}')[5] AS m5,
               regexp_extract_all(lower(caption), '{_MP}')[9] AS m9 FROM organic_social_content"""),
    "fn_regexp_delete": with_bindings(["organic_social_content"], [],
                                      "SELECT content_id, regexp_replace(caption, '@', '', 'g') AS no_at FROM organic_social_content"),
    "fn_array_join": with_bindings(["sessions_master"], [],
                                   "SELECT visit_key, array_to_string(all_subdomains, ' , ') AS subdomains FROM sessions_master"),
    "fn_datediff_day": """SELECT l.l_orderkey, l.l_linenumber, date_diff('day', o.o_orderdate, l.l_shipdate) AS days_to_ship
                          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "fn_datediff_month": """SELECT l.l_orderkey, l.l_linenumber, date_diff('month', o.o_orderdate, l.l_shipdate) AS months_to_ship
                            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "fn_current_date": "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), current_date) AS age_days FROM orders",
    "fn_date_literal": "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2000-12-31'",
    "fn_arithmetic": f"""
        SELECT l_orderkey, l_linenumber,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS net,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_extendedprice AS DECIMAL(18,2))
                    - CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS same,
               CAST({half_up_div('CAST(l_extendedprice AS DECIMAL(18,2))', 2, 'CAST(l_quantity AS INTEGER)', 2)}
                    AS DECIMAL(38,2)) AS unit_price
        FROM lineitem""",
    "fn_round": """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,0)) AS r0,
                          CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), -3) AS DECIMAL(38,0)) AS r_thousands FROM orders""",
    "fn_null_handling": """SELECT l_orderkey, l_linenumber, NULLIF(l_tax, 0.0) AS tax_or_null,
                                  IFNULL(NULLIF(l_discount, 0.0), -1.0) AS disc_or_minus,
                                  COALESCE(NULLIF(l_returnflag, 'N'), 'none') AS flag FROM lineitem""",
    "fn_case_coalesce": with_bindings(["halo_sessions_source"], [], """
        SELECT visit_key, CASE WHEN customer_id IS NULL THEN visitor_id ELSE CAST(customer_id AS VARCHAR) END AS visitor
        FROM halo_sessions_source"""),
    "fn_earlier_date": with_bindings(["journey_orders"], [], """
        SELECT wix_order_name, CASE WHEN order_date > order_date_nam THEN order_date_nam ELSE order_date END AS order_date_local
        FROM journey_orders"""),
})
