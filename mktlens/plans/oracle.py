"""DuckDB SQL oracles.

An independent, plain-SQL statement of every registered query, run by the
driver on the same parquet tables (pre-registered as views named after the
tables).  The bindings of ``mktlens.sources.bindings`` are restated here as
CTEs; each query is ``WITH <the bindings it needs> <its own CTEs> SELECT``.

SQL dialect notes (DuckDB 2.0): ``/`` on DECIMAL yields DOUBLE, ``concat``
skips NULLs (``||`` propagates them), ``date_diff('day'|'month')`` counts
boundaries, ``sum(int)`` is HUGEINT (cast to BIGINT).
"""

from __future__ import annotations

# Fixed values of the bound data, stated here on their own (none is imported
# from the bindings, so the two sides check each other).
PO_CATEGORIES = [
    "Influencer Team : Monthly Salary Payments",
    "Influencer Team : Ambassador Monthly Salary Payments",
    "Influencer Team : Influencer Team : Influencer Campaigns",
    "Influencer Team : Influencer Team : Fixed One Year Fees",
    "Influencer Team : Influencer Team : Fixed Three Month Fees",
    "Influencer Team : Influencer Team : Commissions",
    "Influencer Team : Influencer Team : Bonus",
    "Operations : Office Supplies",
]
CHANNELS = ["Direct", "Organic Search", "Paid Social", "Email", "Referral"]
COGS_RATIO = "0.6"
NET_RATIO = "0.8"
COMPANY_MENTION = "@companynameuk"
EMAIL_DOMAIN = "@mail.example"


def _case_pick(values, index_sql: str) -> str:
    arms = " ".join(f"WHEN {index_sql} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


MONEY = "DECIMAL(18,2)"
LINE_NET = "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DECIMAL(18,2))"
LINE_COGS = f"CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST({COGS_RATIO} AS DECIMAL(2,1)), 2) AS DECIMAL(18,2))"
HANDLE = "upper(substr({n}, 1, 1)) || substr(replace({n}, ' ', '_'), 2)"
# zero-padded to nine digits; longer numbers are left whole
PADDED = "repeat('0', greatest(0, 9 - length(CAST({n} AS VARCHAR)))) || CAST({n} AS VARCHAR)"
EVK = "TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER)"


def half_up_div(num: str, num_scale: int, den: str, scale: int) -> str:
    """``round(num / den, scale)`` exactly (HALF_UP), as DECIMAL(38,scale).
    DuckDB divides decimals in DOUBLE, which misrounds exact halves."""
    a = f"(CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {10 ** scale})"
    b = f"(CAST(({den}) AS HUGEINT) * {10 ** num_scale})"
    q = f"(sign({a}) * ((2 * abs({a}) + {b}) // (2 * {b})))"
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST({q} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL(38,{scale})) END)"


def _email(user: str) -> str:
    return f"'customer.' || {PADDED.format(n=user)} || '{EMAIL_DOMAIN}'"


BINDINGS: dict[str, str] = {
    "order_items": f"""
        SELECT l_orderkey AS order_name,
               CAST(SUM(CAST(l_quantity AS INTEGER)) AS INTEGER) AS item_quantity,
               CAST(SUM({LINE_NET}) AS DECIMAL(18,2)) AS order_net_sales,
               SUM({LINE_COGS}) AS cogs,
               COALESCE(SUM(NULLIF({LINE_NET}, 0) / NULLIF(CAST(l_quantity AS INTEGER), 0)
                            * CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END), 0) AS returns,
               COALESCE(SUM(NULLIF({LINE_COGS}, 0) / NULLIF(CAST(l_quantity AS INTEGER), 0)
                            * CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END), 0) AS cost_of_goods_returns
        FROM lineitem GROUP BY l_orderkey""",
    "items_sold": f"""
        SELECT l.l_orderkey AS order_name, o.o_custkey AS customer_id,
               {LINE_COGS} AS cost_of_goods_gbp, {LINE_NET} AS item_net_rev,
               CAST(l.l_quantity AS INTEGER) AS item_quantity,
               CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END AS items_returned
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "customer_orders": """
        SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_name, CAST(o.o_orderdate AS DATE) AS order_date,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS order_gross_sales,
               i.item_quantity, i.order_net_sales, i.cogs, i.returns, i.cost_of_goods_returns,
               MIN(CAST(o.o_orderdate AS DATE)) OVER (PARTITION BY o.o_custkey) AS acquisition_date,
               ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY CAST(o.o_orderdate AS DATE), o.o_orderkey) AS order_sequence
        FROM orders o LEFT JOIN order_items i ON i.order_name = o.o_orderkey""",
    "customer_orders_geo": """
        SELECT co.*, n.n_name AS shipping_city, r.r_name AS order_shipping_county
        FROM customer_orders co
        LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                   JOIN region r ON n.n_regionkey = r.r_regionkey) ON c.c_custkey = co.customer_id""",
    "customer_database": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS infilled_gender
        FROM customer""",
    "halo_sessions_source": """
        SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey) AS visit_key,
               'v' || CAST(l.l_partkey AS VARCHAR) AS visitor_id,
               CASE WHEN l.l_linestatus = 'F' THEN l.l_suppkey END AS customer_id,
               CAST(l.l_shipdate AS DATE) AS visit_date, l.l_shipdate AS visit_start_time,
               g.geonetwork_city,
               CASE WHEN l.l_returnflag = 'N' THEN 1 ELSE 0 END AS transactions
        FROM lineitem l LEFT JOIN (SELECT s.s_suppkey, n.n_name AS geonetwork_city
                                   FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) g
               ON l.l_suppkey = g.s_suppkey""",
    "influencer_database": f"""
        SELECT influencer_id, influencer_id AS influencer_id2, influencer_name,
               'Customer#' || {PADDED.format(n='influencer_id // 4')} AS finance_number,
               'Publisher ' || CAST(influencer_id % 5 AS VARCHAR) AS publisher_name,
               'CR' || CAST(influencer_id AS VARCHAR) AS creator_number
        FROM (SELECT p_name AS influencer_name, MIN(p_partkey) * 2 AS influencer_id FROM part GROUP BY p_name
              UNION ALL
              SELECT split_part(p_name, ' ', 2) AS influencer_name, MIN(p_partkey) * 2 + 1 AS influencer_id
              FROM part GROUP BY split_part(p_name, ' ', 2))""",
    "content_posted": f"""
        SELECT influencer_id2, {HANDLE.format(n='influencer_name')} AS social_handle FROM influencer_database""",
    "purchase_orders": f"""
        SELECT o.o_orderkey AS purchaseorder_id, o.o_orderpriority AS item_title,
               CASE WHEN o.o_orderpriority = '5-LOW' THEN 'misc work ' || CAST(o.o_orderkey AS VARCHAR)
                    WHEN o.o_orderkey % 3 = 0 THEN 'Fees ' || monthname(CAST(o.o_orderdate AS DATE)) || ' '
                         || CAST(year(o.o_orderdate) AS VARCHAR) || ' ' || p.p_name
                    WHEN o.o_orderkey % 3 = 1 THEN p.p_name || ' ' || lower(substr(monthname(CAST(o.o_orderdate AS DATE)), 1, 3))
                         || ' ' || substr(CAST(year(o.o_orderdate) AS VARCHAR), 3, 2) || ' invoice'
                    ELSE 'Black Friday ' || p.p_name END AS payment_description,
               c.c_name || ' LTD' AS finance_name,
               CAST(o.o_totalprice AS {MONEY}) AS amount_gbp,
               'Marketing' AS department,
               {_case_pick(PO_CATEGORIES, f"o.o_orderkey % {len(PO_CATEGORIES)}")} AS purchase_order_description,
               o.o_orderstatus AS status,
               CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS date_created,
               CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS shipment_received,
               CAST(o.o_totalprice AS {MONEY}) AS amount_foreign,
               'GBP' AS currency, 'UK' AS country,
               'T' || CAST(o.o_orderkey AS VARCHAR) AS transaction_id
        FROM orders o
        LEFT JOIN part p ON o.o_orderkey % (SELECT COUNT(*) FROM part) = p.p_partkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "organic_social_content": f"""
        SELECT o.o_orderkey AS content_id,
               CASE WHEN o.o_orderkey % 2 = 0 THEN 'instagram' ELSE 'tiktok' END AS provider_name,
               x.caption, o.o_orderdate AS published_at, CAST(o.o_orderdate AS DATE) AS "date",
               'https://social.example/p/' || CAST(o.o_orderkey AS VARCHAR) AS post_url,
               x.lifetime_engagement, x.lifetime_reach, x.lifetime_engagement_rate, x.video_views_lifetime
        FROM (SELECT l.l_orderkey,
                     string_agg(CASE WHEN l.l_linenumber % 4 = 2 THEN '{COMPANY_MENTION}'
                                     ELSE '@' || {HANDLE.format(n='p.p_name')} END, ' '
                                ORDER BY l.l_linenumber,
                                         CASE WHEN l.l_linenumber % 4 = 2 THEN '{COMPANY_MENTION}'
                                              ELSE '@' || {HANDLE.format(n='p.p_name')} END) AS caption,
                     CAST(SUM(l.l_quantity) AS BIGINT) AS lifetime_engagement,
                     COUNT(*) * 100 AS lifetime_reach,
                     MAX(l.l_discount) AS lifetime_engagement_rate,
                     CAST(trunc(MAX(l.l_extendedprice)) AS BIGINT) AS video_views_lifetime
              FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
              GROUP BY l.l_orderkey) x
        JOIN orders o ON x.l_orderkey = o.o_orderkey""",
    "paid_social_campaigns": f"""
        SELECT upper(substr(p.p_name, 1, 1)) || substr(p.p_name, 2) || ' | ' || p.p_type || ' | ' || p.p_brand AS campaign,
               'C' || CAST(p.p_partkey AS VARCHAR) AS campaign_id,
               CASE WHEN l.l_suppkey % 2 = 0 THEN 'meta' ELSE 'tiktok' END AS platform,
               'acct_' || CAST(l.l_suppkey % 3 AS VARCHAR) AS account_name,
               CAST(l.l_shipdate AS DATE) AS "date",
               l.l_returnflag AS territory, l.l_linestatus AS channel,
               CAST(l.l_quantity AS BIGINT) * 100 AS impressions,
               CAST(l.l_extendedprice AS {MONEY}) AS spend,
               CAST(l.l_quantity AS BIGINT) AS clicks,
               {LINE_NET} AS ad_revenue
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    # --- journey: everything from the event log --------------------------
    "ev": f"""SELECT *, {EVK} AS k FROM events""",
    "fiscal_dates": """
        SELECT CAST(d AS DATE) AS cal_date, 'FY' || CAST(year(d + INTERVAL 9 MONTH) AS VARCHAR) AS fiscal_year
        FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM (SELECT CAST(MIN(ts) AS DATE) AS lo, CAST(MAX(ts) AS DATE) AS hi FROM events))""",
    "journey_orders": f"""
        SELECT e.user_id AS customer_id,
               ROW_NUMBER() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS order_sequence,
               CAST(e.ts AS DATE) AS order_date,
               CAST(e.ts - INTERVAL 8 HOUR AS DATE) AS order_date_nam,
               e.ts AS wix_order_stamp, e.event_id AS wix_order_name, e.event_id AS wix_order_id,
               e.k % 4 + 1 AS item_quantity,
               CAST(e.value AS DECIMAL(18,2)) AS order_gross_total_gbp,
               e.k % 3 AS order_flag_id,
               CASE WHEN e.k % 3 = 0 AND e.k % 5 >= e.k % 4 THEN 'Y' ELSE 'N' END AS fully_returned,
               CAST(round(CAST(e.value AS DECIMAL(18,2)) * CAST({NET_RATIO} AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS order_net_sales_gbp,
               CASE WHEN e.k % 2 = 0 THEN 'web' ELSE 'app' END AS order_store,
               g.shipping_country
        FROM ev e LEFT JOIN (SELECT c.c_custkey, lower(n.n_name) AS shipping_country
                             FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) g
                  ON e.user_id = g.c_custkey
        WHERE e.event_type = 'purchase'""",
    "regional_index": """
        SELECT upper(n.n_name) AS shipping_country, r.r_name AS region,
               'G' || CAST(n.n_regionkey % 2 AS VARCHAR) AS global_group
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "refunded_items": """
        SELECT event_id AS wix_order_id, k % 5 + 1 AS quantity_returned,
               CAST(ts + INTERVAL 7 DAY AS VARCHAR) AS refund_date
        FROM ev WHERE event_type = 'purchase' AND k % 3 = 0""",
    "customer_ratings": """
        SELECT user_id AS customer_id, ts + INTERVAL 1 DAY AS submitted_at, CAST(k % 5 + 1 AS DOUBLE) AS rating
        FROM ev WHERE event_type = 'purchase'""",
    "customer_details": f"""
        SELECT c_custkey AS customer_id, {_email('c_custkey')} AS email_address, {_email('c_custkey')} AS email,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS customer_gender,
               CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS mail_control
        FROM customer""",
    "opt_in_log": f"""
        SELECT {_email('user_id')} AS email_address,
               CASE WHEN k % 2 = 0 THEN 'N' ELSE 'Y' END AS previous_opt_in,
               CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS new_opt_in,
               ts AS updated_on
        FROM ev WHERE event_type = 'signup'""",
    "account_status_log": f"""
        SELECT {_email('user_id')} AS email, ts AS updated_at,
               CASE WHEN k % 3 = 0 THEN 'suspended' ELSE 'activated' END AS new_account_state
        FROM ev WHERE event_type = 'signup'""",
    "ecom_app_visits": """SELECT user_id AS customer_id, CAST(ts AS DATE) AS session_date FROM events WHERE event_type = 'click'""",
    "train_app_visits": """SELECT user_id AS customer_id, CAST(ts AS DATE) AS session_date FROM events WHERE event_type = 'error'""",
    "sessions_master": f"""
        SELECT CAST(event_id AS VARCHAR) AS visit_key, 'u' || CAST(user_id AS VARCHAR) AS visitor_id,
               CAST(event_id AS VARCHAR) AS visit_id, user_id AS customer_id, CAST(ts AS DATE) AS visit_date,
               ts AS visit_start_time,
               ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS web_visit_number,
               CASE WHEN event_type = 'purchase' THEN event_id END AS wix_order_name,
               {_case_pick(CHANNELS, f"k % {len(CHANNELS)}")} AS channel_grouping,
               CASE WHEN k % 4 = 0 THEN ['www', 'central'] ELSE ['www', 'shop'] END AS all_subdomains,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS transactions,
               event_type
        FROM ev""",
    "wishlist_logging": """
        SELECT 'u' || CAST(user_id AS VARCHAR) AS visitor_id, CAST(event_id AS VARCHAR) AS visitid,
               CAST(ts AS DATE) AS dates, 'SKU-' || CAST(k % 10 AS VARCHAR) AS productsku
        FROM ev WHERE event_type = 'signup'""",
    "product_interactions": """
        SELECT CAST(event_id AS VARCHAR) AS visit_key, ts AS visit_start_time,
               CASE WHEN k % 2 = 0 THEN 'Added_To_Cart' ELSE 'Viewed' END AS event_action
        FROM ev WHERE event_type = 'click'""",
    "session_bounces": """
        SELECT user_id AS customer_id, ts AS visit_start_time,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bounces
        FROM events WHERE event_type IN ('view', 'error')""",
}

# binding -> bindings it reads
DEPENDS = {
    "customer_orders": ["order_items"],
    "customer_orders_geo": ["customer_orders"],
    "content_posted": ["influencer_database"],
    "journey_orders": ["ev"], "refunded_items": ["ev"], "customer_ratings": ["ev"],
    "opt_in_log": ["ev"], "account_status_log": ["ev"], "sessions_master": ["ev"],
    "wishlist_logging": ["ev"], "product_interactions": ["ev"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPENDS.get(n, []):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_bindings(names: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    """``WITH <bindings in dependency order>, <ctes> <final>``."""
    parts = [f"{n} AS ({BINDINGS[n]})" for n in _closure(names)]
    parts += [f"{n} AS ({body})" for n, body in ctes]
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + final
