"""Oracle SQL (DuckDB) of the six analyses and their steps.

Written from the operators' definitions with a structure of its own: pattern
rules and horizons are rows of small tables, attribution is a ranking of
candidates, mentions are one unnest, the journey's features are one long
relation.  Every constant is stated here and none is imported from the plans,
so a wrong entry on either side turns its row red.
"""

from __future__ import annotations

from mktlens.plans.oracle import half_up_div, with_bindings

SQL: dict[str, str] = {}


def _table(columns: str, rows) -> str:
    """``SELECT * FROM (VALUES ...) t(columns)``."""
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


def _add(bindings, ctes, finals: dict[str, str]) -> None:
    for key, final in finals.items():
        SQL[key] = with_bindings(bindings, ctes, final)


# ---------------------------------------------------------------------------
# Value: one fact per order and cost row, one row per customer and horizon
# ---------------------------------------------------------------------------
# Horizon labels and their days; days after which a customer is
# retained; the cut-off day of eligibility.
_SPANS = [("24m", 731), ("12m", 366)]
_RETAINED, _CUTOFF = 365, "1996-06-30"


def _given_back(value: str) -> str:
    """Value of the returned pieces, unit value times pieces."""
    return f"COALESCE(SUM(CASE WHEN item_quantity <> 0 AND {value} <> 0 THEN {value} / item_quantity * items_returned END), 0)"


COSTED = f"""
    SELECT order_name, customer_id, SUM(cost_of_goods_gbp) AS cogs, {_given_back('item_net_rev')} AS returns,
           {_given_back('cost_of_goods_gbp')} AS cost_of_goods_returns
    FROM items_sold GROUP BY order_name, customer_id"""


def _value(same_order: bool) -> str:
    facts = f"""
        SELECT o.customer_id, c.infilled_gender, o.acquisition_date, o.order_name, o.item_quantity,
               date_diff('day', o.acquisition_date, o.order_date) AS age,
               o.order_gross_sales AS gross, o.order_net_sales AS net,
               o.order_net_sales - i.cogs - i.returns + i.cost_of_goods_returns AS profit
        FROM customer_orders o LEFT JOIN customer_database c USING (customer_id)
        LEFT JOIN costed i ON i.customer_id = o.customer_id {'AND i.order_name = o.order_name' if same_order else ''}"""
    per_span = """
        SELECT f.customer_id, s.label, CAST(SUM(gross) AS DECIMAL(38,2)) AS gross, COUNT(order_name) AS n_orders,
               CAST(SUM(item_quantity) AS BIGINT) AS pieces, CAST(SUM(net) AS DECIMAL(38,2)) AS net,
               CAST(round(SUM(profit), 2) AS DECIMAL(38,2)) AS profit
        FROM facts f JOIN spans s ON f.age < s.days GROUP BY f.customer_id, s.label"""
    people = f"""
        SELECT customer_id, infilled_gender, acquisition_date, MAX(CASE WHEN age > {_RETAINED} THEN 1 END) AS retained_customer
        FROM facts GROUP BY ALL"""
    cols, joins = [], []
    for label, _ in _SPANS:
        x = f"s{label}"
        joins.append(f"LEFT JOIN per_span {x} ON {x}.customer_id = p.customer_id AND {x}.label = '{label}'")
        cols += [f"{x}.gross AS total_revenue_{label}", f"COALESCE({x}.n_orders, 0) AS total_orders_{label}",
                 f"{x}.pieces AS total_items_{label}",
                 f"CAST({half_up_div(f'{x}.gross', 2, f'{x}.n_orders', 4)} AS DECIMAL(38,4)) AS AOV_{label}",
                 f"CAST({half_up_div(f'{x}.pieces', 0, f'{x}.n_orders', 1)} AS DECIMAL(38,1)) AS items_per_order_{label}",
                 f"{x}.net AS total_order_net_revenue_{label}", f"{x}.profit AS GP1_{label}"]
    final = f"""
        SELECT p.*, {', '.join(cols)},
               CASE WHEN date_diff('day', p.acquisition_date, DATE '{_CUTOFF}') > {_RETAINED} THEN 1 END AS retained_eligible_customer
        FROM people p {' '.join(joins)}"""
    return with_bindings(["customer_orders", "customer_database", "items_sold"],
                         [("costed", COSTED), ("spans", _table("label, days", _SPANS)), ("facts", facts),
                          ("per_span", per_span), ("people", people)], final)


SQL["customer_value_metrics"] = _value(True)
SQL["customer_value_metrics_literal"] = _value(False)
_add(["items_sold"], [("costed", COSTED)], {"item_costs": """
    SELECT order_name, customer_id, cogs, CAST(round(returns, 2) AS DECIMAL(38,2)) AS returns,
           CAST(round(cost_of_goods_returns, 2) AS DECIMAL(38,2)) AS cost_of_goods_returns FROM costed"""})
_add(["customer_orders"], [], {"retention_flags": f"""
    SELECT customer_id, acquisition_date,
           CASE WHEN MAX(order_date) - acquisition_date > {_RETAINED} THEN 1 END AS retained_customer,
           CASE WHEN DATE '{_CUTOFF}' - acquisition_date > {_RETAINED} THEN 1 END AS retained_eligible_customer
    FROM customer_orders GROUP BY customer_id, acquisition_date"""})


# ---------------------------------------------------------------------------
# Halo: towns resolved once per nation, months as numbers
# ---------------------------------------------------------------------------
# Town patterns in the order the first match is taken, the
# county that guards them, the event, the months around it.
_TOWNS = [(1, "%nation_6%", "NATION_6"), (2, "%nation_21%", "NATION_21"), (3, "%nation_11%", "NATION_11"),
          (4, "%nation_1%", "NATION_1")]
_COUNTY, _EVENT_NAME, _MONTHS = "america", "AMERICA_MARKET", 12
EVENTS_LOOKUP = """
    SELECT r.r_name || '_MARKET' AS event_name, make_date(1998, r.r_regionkey + 1, 1) AS event_start_date,
           lower(n.n_name) AS town
    FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey
    WHERE n.n_nationkey = (SELECT MIN(x.n_nationkey) FROM nation x WHERE x.n_regionkey = r.r_regionkey)"""
EVENT = f"SELECT event_name, event_start_date FROM events_lookup WHERE event_name = '{_EVENT_NAME}'"


def _offset(day: str) -> str:
    return f"(12 * year({day}) + month({day}) - 12 * year(e.event_start_date) - month(e.event_start_date))"


_HALO = [
    ("events_lookup", EVENTS_LOOKUP), ("event", EVENT), ("towns", _table("rank, pattern, label", _TOWNS)),
    ("places", """SELECT n_name AS place, arg_min(label, rank) AS town FROM nation, towns
                  WHERE lower(n_name) LIKE pattern GROUP BY n_name"""),
    ("near_orders", f"""
        SELECT e.event_name, p.town AS shipping_city, {_offset('o.order_date')} AS months_to_popup_event,
               o.customer_id, o.order_name, o.order_net_sales, o.order_sequence = 1 AS is_first
        FROM customer_orders_geo o JOIN places p ON p.place = o.shipping_city, event e
        WHERE lower(o.order_shipping_county) = '{_COUNTY}' AND o.item_quantity > 0
          AND abs(months_to_popup_event) <= {_MONTHS}"""),
    ("sales", """
        SELECT event_name, shipping_city, months_to_popup_event, COUNT(DISTINCT customer_id) AS distinct_customers,
               COUNT(DISTINCT customer_id) FILTER (is_first) AS new_customers,
               CAST(SUM(order_net_sales) AS DECIMAL(38,2)) AS total_sales,
               CAST(SUM(order_net_sales) FILTER (is_first) AS DECIMAL(38,2)) AS new_customer_sales,
               COUNT(order_name) AS total_orders, COUNT(order_name) FILTER (is_first) AS new_customer_orders
        FROM near_orders GROUP BY ALL"""),
    ("near_visits", f"""
        SELECT e.event_name, p.town AS browsing_city, {_offset('s.visit_date')} AS months_to_popup_event,
               s.visit_key, s.transactions, COALESCE(CAST(s.customer_id AS VARCHAR), s.visitor_id) AS visitor
        FROM halo_sessions_source s JOIN places p ON p.place = s.geonetwork_city, event e
        WHERE abs(months_to_popup_event) <= {_MONTHS}"""),
    ("traffic", f"""
        SELECT event_name, browsing_city, months_to_popup_event, COUNT(visit_key) AS total_sessions,
               COUNT(DISTINCT visitor) AS total_visitors_estimate, CAST(SUM(transactions) AS BIGINT) AS total_orders_ga,
               CAST({half_up_div('SUM(transactions)', 0, 'COUNT(visit_key)', 3)} AS DECIMAL(38,3)) AS ga_cvr_approx
        FROM near_visits GROUP BY ALL"""),
]


def _halo(window: str) -> str:
    return f"""
        SELECT c.*, t.total_sessions, t.total_visitors_estimate, t.total_orders_ga, t.ga_cvr_approx,
               round(AVG(t.total_visitors_estimate) OVER recent) AS avg_visitors_l3m,
               round(AVG(c.new_customers) OVER recent) AS avg_new_customers_l3m,
               CAST({half_up_div('SUM(c.total_sales) OVER recent', 2, 'COUNT(c.total_sales) OVER recent', 2)}
                    AS DECIMAL(38,2)) AS avg_net_sales_l3m
        FROM sales c LEFT JOIN traffic t ON t.event_name = c.event_name AND t.browsing_city = c.shipping_city
                                        AND t.months_to_popup_event = c.months_to_popup_event
        WINDOW recent AS ({window} ROWS 2 PRECEDING)"""


_add(["customer_orders_geo", "halo_sessions_source"], _HALO, {
    "event_halo_effect": _halo("PARTITION BY c.event_name, c.shipping_city ORDER BY c.months_to_popup_event"),
    "event_halo_effect_literal_window": _halo("PARTITION BY c.event_name ORDER BY c.months_to_popup_event, c.shipping_city"),
    "halo_commercial": "SELECT * FROM sales",
    "halo_sessions": "SELECT * FROM traffic",
    "months_to_event": f"""
        SELECT o.customer_id, o.order_name, o.order_date, e.event_name, {_offset('o.order_date')} AS months_to_popup_event
        FROM customer_orders_geo o, event e WHERE abs(months_to_popup_event) <= {_MONTHS}""",
    "town_bucket": f"""
        SELECT o.order_name, o.shipping_city, p.town AS town_bucket
        FROM customer_orders_geo o LEFT JOIN places p ON p.place = o.shipping_city
        WHERE lower(o.order_shipping_county) = '{_COUNTY}'""",
    "event_lookup": "SELECT * FROM event",
    "top_k": """
        SELECT * FROM halo_sessions_source
        ORDER BY customer_id, visit_start_time, visit_key, visitor_id, visit_date, geonetwork_city, transactions
        LIMIT 10000""",
})


# ---------------------------------------------------------------------------
# Spend: pattern rows with ranks, candidates by stage, the best stage wins
# ---------------------------------------------------------------------------
# The categories kept, and the month and year patterns with
# their ranks (the lowest rank found wins).
_CATEGORIES = [
    "Influencer Team : Monthly Salary Payments",
    "Influencer Team : Ambassador Monthly Salary Payments",
    "Influencer Team : Influencer Team : Influencer Campaigns",
    "Influencer Team : Influencer Team : Fixed One Year Fees",
    "Influencer Team : Influencer Team : Fixed Three Month Fees",
    "Influencer Team : Influencer Team : Commissions",
    "Influencer Team : Influencer Team : Bonus",
]
_MONTH_WORDS = [
    (1, "january", "01"), (1, "jan ", "01"),
    (2, "february", "02"), (2, "febraury", "02"), (2, "feb", "02"),
    (3, "march", "03"), (3, "mar ", "03"),
    (4, "april", "04"), (4, "apr ", "04"),
    (5, "may ", "05"),
    (6, "june", "06"), (6, "jun ", "06"),
    (7, "july", "07"), (7, "jul ", "07"),
    (8, "august", "08"), (8, "aug ", "08"),
    (9, "september", "09"), (9, "sep", "09"), (9, "sept ", "09"),
    (10, "october", "10"), (10, "oct", "10"),
    (11, "november", "11"), (11, "nov", "11"), (11, "black friday", "11"), (11, "bf", "11"),
    (12, "december", "12"), (12, "dec", "12"),
]
_YEAR_WORDS = [
    (1, "2019", "2019"), (1, "19", "2019"),
    (2, "2020", "2020"),
    (3, "2021", "2021"), (3, "21", "2021"),
    (4, "2022", "2022"), (4, "22", "2022"),
    (5, "2023", "2023"), (5, "23", "2023"),
    (6, "2024", "2024"), (6, "24", "2024"),
    (7, "2025", "2025"), (7, "25", "2025"),
    (8, "2026", "2026"), (8, "26", "2026"),
]
_GAP = "PO MISSING FROM DATABASE - "
SPEND_BINDINGS = ["purchase_orders", "influencer_database"]


def spend_ctes(in_text: str) -> list[tuple[str, str]]:
    """``in_text`` is the condition that name ``n`` occurs in order ``d``'s text."""
    def first_word(words: str) -> str:
        return f"""SELECT k.purchaseorder_id, arg_min(w.part, w.rank) AS part FROM kept k
                   JOIN {words} w ON contains(lower(k.payment_description), w.word) GROUP BY k.purchaseorder_id"""
    return [
        ("categories", _table("category", _CATEGORIES)),
        ("month_words", _table("rank, word, part", _MONTH_WORDS)),
        ("year_words", _table("rank, word, part", _YEAR_WORDS)),
        ("kept", "SELECT p.* FROM purchase_orders p SEMI JOIN categories c ON c.category = p.purchase_order_description"),
        ("month_found", first_word("month_words")),
        ("year_found", first_word("year_words")),
        ("dated", """
            SELECT k.*, m.part AS month_part, y.part AS year_part,
                   COALESCE(y.part, left(k.date_created, 4)) || '-' || m.part AS year_month_concat,
                   CASE WHEN year_month_concat IS NULL THEN left(k.date_created, 7) END AS year_month_created,
                   COALESCE(year_month_concat, year_month_created) AS year_month_inferred
            FROM kept k LEFT JOIN month_found m ON m.purchaseorder_id = k.purchaseorder_id
            LEFT JOIN year_found y ON y.purchaseorder_id = k.purchaseorder_id"""),
        ("names", "SELECT DISTINCT influencer_name, influencer_id FROM influencer_database WHERE influencer_name IS NOT NULL"),
        ("by_text", f"SELECT d.purchaseorder_id, n.influencer_name, n.influencer_id, 1 AS stage FROM dated d JOIN names n ON {in_text}"),
        ("sole_numbers", """
            SELECT any_value(influencer_name) AS influencer_name, any_value(influencer_id) AS influencer_id, finance_number
            FROM influencer_database GROUP BY finance_number HAVING COUNT(finance_number) = 1"""),
        ("by_number", """
            SELECT d.purchaseorder_id, s.influencer_name, s.influencer_id, 2 AS stage
            FROM dated d JOIN sole_numbers s ON s.finance_number = split_part(d.finance_name, ' ', 1)"""),
        ("best", """
            SELECT * FROM (FROM by_text UNION ALL FROM by_number)
            QUALIFY stage = MIN(stage) OVER (PARTITION BY purchaseorder_id)"""),
        ("order_rows", "SELECT * EXCLUDE (month_part, year_part, year_month_concat, year_month_created) FROM dated"),
    ]


SPEND = spend_ctes("contains(lower(d.payment_description), lower(n.influencer_name))")
_SPEND_LIKE = spend_ctes("lower(d.payment_description) LIKE '%' || lower(n.influencer_name) || '%'")
_ATTRIBUTED = f"""
    SELECT r.* EXCLUDE (country), COALESCE(b.influencer_name, '{_GAP}' || r.finance_name) AS influencer_name, b.influencer_id
    FROM order_rows r LEFT JOIN best b ON b.purchaseorder_id = r.purchaseorder_id"""
_add(SPEND_BINDINGS, SPEND, {
    "spend_attribution": _ATTRIBUTED,
    "spend_filter": "SELECT * FROM kept",
    "infer_year_month": """
        SELECT purchaseorder_id, payment_description, date_created, month_part, year_part, year_month_concat,
               year_month_created, year_month_inferred FROM dated""",
    "attribute_by_name": """
        SELECT r.*, t.influencer_name, t.influencer_id
        FROM order_rows r LEFT JOIN by_text t ON t.purchaseorder_id = r.purchaseorder_id""",
    "attribute_by_number": """
        SELECT r.*, f.influencer_name, f.influencer_id
        FROM order_rows r LEFT JOIN by_number f ON f.purchaseorder_id = r.purchaseorder_id
        ANTI JOIN by_text t ON t.purchaseorder_id = r.purchaseorder_id""",
    "unique_finance_numbers": "SELECT * FROM sole_numbers",
    "unmatched_rows": "SELECT r.purchaseorder_id FROM order_rows r ANTI JOIN by_text t ON t.purchaseorder_id = r.purchaseorder_id",
})
_add(SPEND_BINDINGS, _SPEND_LIKE, {"spend_attribution_wildcards": _ATTRIBUTED})
SQL["wildcard_join_many_names"] = with_bindings(["purchase_orders"], [], """
    SELECT p.purchaseorder_id, c.c_custkey FROM purchase_orders p
    JOIN customer c ON contains(lower(p.finance_name), lower(c.c_name || ' LTD'))""")
SQL["wildcard_left_join"] = """
    SELECT d.doc_id, b.item_id FROM documents d
    LEFT JOIN benchmark b ON contains(lower(d.text), lower(b.text))"""


# ---------------------------------------------------------------------------
# Organic: each post's mentions as one list, unnested with their positions
# ---------------------------------------------------------------------------
_ORGANIC = [
    ("posts", """
        SELECT DISTINCT content_id, provider_name, caption, published_at,
               regexp_extract_all(lower(caption), '@([a-zA-Z0-9_.]+)', 1) AS handles
        FROM organic_social_content
        WHERE "date" > DATE '1997-12-31' AND caption LIKE '%@%' AND published_at IS NOT NULL"""),
    ("numbered", """
        SELECT content_id, provider_name, caption, published_at, unnest(handles) AS mention,
               CAST(generate_subscripts(handles, 1) AS INTEGER) AS slot
        FROM posts"""),
    ("mentions", "SELECT * FROM numbered WHERE NOT starts_with(mention, 'companyname')"),
    ("owners", """
        SELECT DISTINCT lower(c.social_handle) AS lookup_name, i.influencer_id
        FROM content_posted c LEFT JOIN influencer_database i ON i.influencer_id2 = c.influencer_id2"""),
    ("resolved", """
        SELECT m.content_id, m.provider_name, m.caption, m.published_at, o.influencer_id
        FROM mentions m JOIN owners o ON o.lookup_name = m.mention AND o.influencer_id IS NOT NULL"""),
    ("publishers", "SELECT DISTINCT influencer_id, publisher_name FROM influencer_database"),
    ("peaks", """
        SELECT content_id, MAX(lifetime_engagement) AS max_lifetime_engagement, MAX(lifetime_reach) AS max_lifetime_reach,
               MAX(lifetime_engagement_rate) AS max_lifetime_engagement_rate,
               MAX(video_views_lifetime) AS max_video_views_lifetime
        FROM organic_social_content GROUP BY content_id, post_url"""),
]
_add(["organic_social_content", "content_posted", "influencer_database"], _ORGANIC, {
    "organic_post_attribution": """
        SELECT r.*, p.publisher_name, k.* EXCLUDE (content_id)
        FROM resolved r LEFT JOIN publishers p ON p.influencer_id = r.influencer_id
        LEFT JOIN peaks k ON k.content_id = r.content_id""",
    "handle_lookup": "SELECT * FROM owners",
    "extract_mentions": "SELECT * FROM mentions",
    "resolve_mentions": "SELECT * FROM resolved",
    "multi_slot_lookup": """
        SELECT m.content_id, m.slot, m.mention, o.influencer_id
        FROM mentions m LEFT JOIN owners o ON o.lookup_name = m.mention""",
    "unpivot_slots": "SELECT content_id, mention, slot FROM mentions",
})


# ---------------------------------------------------------------------------
# Paid: spellings as rows with their kind, one hit per title and influencer
# ---------------------------------------------------------------------------
# First day of the ads that count, shortest name that counts.
_ADS_FROM, _SHORTEST = "1996-01-01", 5


def _paid(in_title: str) -> list[tuple[str, str]]:
    return [
        ("spellings", """
            SELECT DISTINCT kind, name, influencer_id FROM (
                SELECT influencer_id, unnest(['as written', 'without blanks']) AS kind,
                       unnest([lower(influencer_name), lower(replace(influencer_name, ' ', ''))]) AS name
                FROM influencer_database
                UNION ALL
                SELECT i.influencer_id, 'handle', lower(c.social_handle)
                FROM content_posted c LEFT JOIN influencer_database i ON i.influencer_id2 = c.influencer_id2)"""),
        ("catalogue", f"""
            SELECT lower(campaign) AS title, platform, account_name, campaign_id, MAX("date") AS max_date
            FROM paid_social_campaigns WHERE "date" >= DATE '{_ADS_FROM}' AND "date" <= current_date GROUP BY ALL"""),
        ("hits", f"""
            SELECT DISTINCT c.title, s.influencer_id FROM (SELECT DISTINCT title FROM catalogue) c
            JOIN (SELECT DISTINCT name, influencer_id FROM spellings WHERE length(name) >= {_SHORTEST}) s ON {in_title}"""),
    ]


_PAID = _paid("contains(c.title, s.name)")
_PAID_LIKE = _paid("c.title LIKE '%' || s.name || '%'")
_PAID_BINDINGS = ["paid_social_campaigns", "content_posted", "influencer_database"]
_PER_DAY = """
    SELECT i.publisher_name, i.creator_number, a."date" AS cal_date,
           COUNT(DISTINCT a.campaign) AS distinct_campaigns, COUNT(DISTINCT a.territory) AS distinct_territory,
           COUNT(DISTINCT a.channel) AS distinct_paid_channels,
           CAST(SUM(a.impressions) AS BIGINT) AS sum_impressions, CAST(SUM(a.spend) AS DECIMAL(38,2)) AS sum_spend,
           CAST(SUM(a.clicks) AS BIGINT) AS sum_clicks, CAST(round(SUM(a.ad_revenue)) AS DECIMAL(38,0)) AS sum_ad_revenue,
           string_agg(a.campaign, '' ORDER BY a.campaign) AS agg_campaign
    FROM paid_social_campaigns a JOIN hits h ON h.title = lower(a.campaign)
    LEFT JOIN influencer_database i ON i.influencer_id = h.influencer_id
    GROUP BY i.publisher_name, i.creator_number, a."date\""""
_PER_CAMPAIGN = """
    SELECT DISTINCT c.title AS campaign, c.max_date, c.platform, c.campaign_id, h.influencer_id, i.influencer_name
    FROM catalogue c JOIN hits h ON h.title = c.title LEFT JOIN influencer_database i ON i.influencer_id = h.influencer_id"""
_add(_PAID_BINDINGS, _PAID, {
    "paid_ad_attribution": _PER_DAY,
    "match_campaigns": _PER_CAMPAIGN,
    "name_variants": "SELECT name, influencer_id FROM spellings",
    "campaign_catalogue": "SELECT title AS campaign, max_date, platform, account_name, campaign_id FROM catalogue",
    "wildcard_inner_join": f"""
        SELECT t.title AS campaign, s.name, s.influencer_id
        FROM (SELECT DISTINCT lower(campaign) AS title FROM paid_social_campaigns) t
        JOIN spellings s ON contains(t.title, s.name) WHERE length(s.name) >= {_SHORTEST}""",
})
_add(_PAID_BINDINGS, _PAID_LIKE, {"paid_ad_attribution_wildcards": _PER_DAY, "match_campaigns_wildcards": _PER_CAMPAIGN})


# ---------------------------------------------------------------------------
# Journey: the features as one long relation of signals
# ---------------------------------------------------------------------------
# First acquisition day of the cohort, the sequences checked for
# shared order names, the subdomain pattern of content visits.
_COHORT_FROM, _CHECKED, _CONTENT = "2024-01-02", "(1, 2)", "%central%"


def _local(o: str) -> str:
    return f"CASE WHEN {o}.order_date_nam < {o}.order_date THEN {o}.order_date_nam ELSE {o}.order_date END"


# kind -> relation, time, number, text
_SIGNALS = {
    "blog": ("contents", "visit_start_time", "NULL", "NULL"),
    "review": ("reviews", "submitted_at", "rating", "NULL"),
    "ecom": ("ecom_first", "download_date", "NULL", "NULL"),
    "train": ("train_first", "download_date", "NULL", "NULL"),
    "wish": ("wishes", "visit_start_time", "num_prod_added", "NULL"),
    "cart": ("carts", "visit_start_time", "total_cart_adds", "NULL"),
    "bounce": ("session_bounces", "visit_start_time", "bounces", "NULL"),
    "opt": ("opt_changes", "change_date", "NULL", "new_opt_in"),
    "acct": ("accounts", "updated_at", "NULL", "account_status"),
}
_JOURNEY = [
    ("acquired", f"""
        SELECT customer_id, MIN(order_date) AS acquisition_date FROM journey_orders GROUP BY customer_id
        HAVING acquisition_date >= DATE '{_COHORT_FROM}' AND acquisition_date <= current_date"""),
    ("history", f"""
        SELECT o.*, a.acquisition_date, r.region, r.global_group, {_local('o')} AS order_date_local,
               p.order_date AS prior_order_date, p.wix_order_stamp AS prior_order_date_timestamp,
               CASE WHEN o.order_sequence > 1 THEN f.fiscal_year END AS repeat_order_fy,
               date_diff('day', {_local('p')}, order_date_local) AS days_btwn_orders
        FROM journey_orders o JOIN acquired a ON a.customer_id = o.customer_id
        LEFT JOIN journey_orders p ON p.customer_id = o.customer_id AND p.order_sequence = o.order_sequence - 1
        LEFT JOIN fiscal_dates f ON f.cal_date = o.order_date
        LEFT JOIN regional_index r ON r.shipping_country = upper(o.shipping_country)"""),
    ("shared_names", f"""
        SELECT wix_order_name FROM history WHERE order_sequence IN {_CHECKED} GROUP BY customer_id, wix_order_name
        HAVING MIN(order_sequence) <> MAX(order_sequence)"""),
    ("kept_orders", """
        SELECT h.*, ROW_NUMBER() OVER (PARTITION BY h.customer_id ORDER BY h.wix_order_stamp, h.order_sequence) AS order_sequence_new
        FROM history h ANTI JOIN shared_names s ON s.wix_order_name = h.wix_order_name WHERE h.wix_order_stamp IS NOT NULL"""),
    ("members", "SELECT DISTINCT customer_id FROM kept_orders"),
    ("unclear", """
        SELECT customer_id FROM sessions_master WHERE wix_order_name IS NOT NULL
        GROUP BY customer_id, wix_order_name HAVING COUNT(*) > 1"""),
    ("visits", "SELECT v.* FROM sessions_master v ANTI JOIN unclear u ON u.customer_id = v.customer_id WHERE v.customer_id IS NOT NULL"),
    ("first_visits", """
        SELECT DISTINCT customer_id, visit_date AS first_visit_date, visit_start_time AS first_visit_timestamp
        FROM visits WHERE web_visit_number = 1"""),
    ("lookback", """
        SELECT k.*, v.first_visit_date, v.first_visit_timestamp,
               CASE WHEN k.order_sequence_new = 1 AND v.first_visit_timestamp <= k.wix_order_stamp
                    THEN v.first_visit_timestamp ELSE k.prior_order_date_timestamp END AS opens
        FROM kept_orders k LEFT JOIN first_visits v ON v.customer_id = k.customer_id"""),
    ("refunds", """
        SELECT r.wix_order_id, CAST(SUM(r.quantity_returned) AS BIGINT) AS items_returned, MAX(left(r.refund_date, 10)) AS refund_date
        FROM refunded_items r SEMI JOIN kept_orders k ON k.wix_order_name = r.wix_order_id GROUP BY r.wix_order_id"""),
    ("conversions", "SELECT v.* FROM visits v SEMI JOIN kept_orders k ON k.wix_order_name = v.wix_order_name"),
    ("reviews", "SELECT DISTINCT customer_id, submitted_at, rating FROM customer_ratings"),
    ("opt_changes", """
        SELECT d.customer_id, l.previous_opt_in, l.new_opt_in, l.updated_on AS change_date, COUNT(*) AS count
        FROM opt_in_log l LEFT JOIN customer_details d ON d.email_address = l.email_address
        WHERE l.new_opt_in IS NOT NULL GROUP BY ALL HAVING COUNT(*) = 1"""),
    ("accounts", """
        SELECT DISTINCT d.customer_id, l.updated_at, if(l.new_account_state = 'activated', 'Y', 'N') AS account_status
        FROM account_status_log l JOIN customer_details d ON d.email = l.email
        SEMI JOIN members m ON m.customer_id = d.customer_id"""),
    ("ecom_first", "SELECT customer_id, MIN(session_date) AS download_date FROM ecom_app_visits GROUP BY customer_id"),
    ("train_first", "SELECT customer_id, MIN(session_date) AS download_date FROM train_app_visits GROUP BY customer_id"),
    ("wishes", """
        SELECT s.customer_id, s.wix_order_name, s.visit_start_time, l.dates, l.visitor_id, l.visitid,
               COUNT(DISTINCT l.productsku) AS num_prod_added
        FROM wishlist_logging l
        LEFT JOIN sessions_master s ON s.visit_id = l.visitid AND s.visitor_id = l.visitor_id AND s.visit_date = l.dates
        GROUP BY ALL"""),
    ("carts", """
        SELECT s.customer_id, s.visit_date, s.wix_order_name, i.visit_key, i.visit_start_time, COUNT(*) AS total_cart_adds
        FROM product_interactions i
        JOIN sessions_master s ON s.visit_key = i.visit_key AND s.visit_start_time = i.visit_start_time
        SEMI JOIN members m ON m.customer_id = s.customer_id
        WHERE i.event_action = 'Added_To_Cart' GROUP BY ALL"""),
    ("contents", f"""
        SELECT s.customer_id, s.wix_order_name, s.visit_date, s.visit_start_time,
               COUNT(DISTINCT s.customer_id) AS blog_visit_flag
        FROM sessions_master s SEMI JOIN members m ON m.customer_id = s.customer_id
        WHERE array_to_string(s.all_subdomains, ' , ') LIKE '{_CONTENT}' GROUP BY ALL"""),
    ("signals", " UNION ALL ".join(
        f"SELECT customer_id, CAST({t} AS TIMESTAMP) AS t, '{kind}' AS kind, CAST({num} AS DOUBLE) AS num, CAST({txt} AS VARCHAR) AS txt FROM {rel}"
        for kind, (rel, t, num, txt) in _SIGNALS.items())),
    ("met", """
        SELECT w.customer_id, w.order_sequence_new, s.kind, s.t, s.num, s.txt
        FROM lookback w JOIN signals s ON s.customer_id = w.customer_id AND s.t >= w.opens AND s.t <= w.wix_order_stamp"""),
    ("order_facts", """
        SELECT w.customer_id, w.order_sequence_new, w.wix_order_stamp, w.wix_order_name, w.first_visit_date,
               w.first_visit_timestamp, w.opens AS prior_order_or_first_visit_timestamp, r.items_returned,
               CASE WHEN r.items_returned < w.item_quantity THEN 'PART' WHEN r.items_returned = w.item_quantity THEN 'FULL' END
                   AS full_or_part_return,
               d.customer_gender, d.mail_control, c.channel_grouping AS conversion_channel
        FROM lookback w LEFT JOIN refunds r ON r.wix_order_id = w.wix_order_name
        LEFT JOIN conversions c ON c.wix_order_name = w.wix_order_name AND c.customer_id = w.customer_id
        LEFT JOIN customer_details d ON d.customer_id = w.customer_id"""),
]
_JOURNEY_BINDINGS = ["journey_orders", "regional_index", "fiscal_dates", "refunded_items", "customer_ratings",
                     "customer_details", "opt_in_log", "account_status_log", "ecom_app_visits", "train_app_visits",
                     "sessions_master", "wishlist_logging", "product_interactions", "session_bounces"]


def _measures(of) -> str:
    """The feature columns; ``of(kind, aggregate)`` computes an aggregate of a
    kind's signals ``m`` (t, num, txt)."""
    def flag(kind):
        return f"CASE WHEN {of(kind, 'COUNT(m.t)')} > 0 THEN 'Y' ELSE 'N' END"
    return f"""
        {flag('blog')} AS blog_visit_flag,
        CAST(COALESCE({of('review', 'COUNT(m.t)')}, 0) AS BIGINT) AS total_reviews,
        round({of('review', 'AVG(m.num)')}, 1) AS avg_rating,
        {flag('ecom')} AS ecom_app_download, {flag('train')} AS train_app_download, {flag('wish')} AS wishlist_add,
        CAST(COALESCE({of('wish', 'COUNT(m.num)')}, 0) AS BIGINT) AS count_wishlist_add,
        CAST(COALESCE({of('wish', 'SUM(m.num)')}, 0) AS BIGINT) AS wishlist_num_prod_added,
        CAST(COALESCE({of('cart', 'SUM(m.num)')}, 0) AS BIGINT) AS total_add_to_carts,
        CAST(COALESCE({of('bounce', 'SUM(m.num)')}, 0) AS BIGINT) AS total_bounced_sessions,
        CAST(COALESCE({of('bounce', 'COUNT(m.num)')}, 0) AS BIGINT) AS total_sessions,
        total_bounced_sessions / NULLIF(total_sessions, 0) * 100 AS bounce_rate,
        {of('opt', 'MAX(m.t)')} AS max_date, {of('opt', 'MAX(m.txt)')} AS latest_opt_status,
        {of('acct', 'MAX(m.t)')} AS updated_at, COALESCE({of('acct', 'MAX(m.txt)')}, 'N') AS account_status"""


# default: every order meets each kind's signals on their own
_per_order = _measures(lambda kind, agg: f"{agg} FILTER (m.kind = '{kind}')")
_DEFAULT = f"""
    SELECT o.*, x.* EXCLUDE (customer_id, order_sequence_new)
    FROM order_facts o
    LEFT JOIN (SELECT w.customer_id, w.order_sequence_new, {_per_order}
               FROM lookback w LEFT JOIN met m ON m.customer_id = w.customer_id AND m.order_sequence_new = w.order_sequence_new
               GROUP BY w.customer_id, w.order_sequence_new) x
      ON x.customer_id = o.customer_id AND x.order_sequence_new = o.order_sequence_new"""
# literal: the product of all kinds, and of the first visits joined once more
_LITERAL = f"""
    SELECT o.*, {_measures(lambda kind, agg: agg.replace('m.', f'm_{kind}.'))}
    FROM order_facts o LEFT JOIN visits g ON g.customer_id = o.customer_id AND g.web_visit_number = 1
    {' '.join(f"LEFT JOIN met m_{k} ON m_{k}.kind = '{k}' AND m_{k}.customer_id = o.customer_id AND m_{k}.order_sequence_new = o.order_sequence_new" for k in _SIGNALS)}
    GROUP BY ALL"""
_add(_JOURNEY_BINDINGS, _JOURNEY, {
    "interactions_between_orders": _DEFAULT,
    "interactions_view": _DEFAULT,
    "interactions_between_orders_literal": _LITERAL,
    "order_history": "SELECT * FROM history",
    "clean_order_sequence": """
        SELECT customer_id, order_sequence, order_sequence_new, order_sequence - order_sequence_new AS diff_seq,
               wix_order_name, wix_order_stamp FROM kept_orders""",
    "clean_sessions": "SELECT * EXCLUDE (all_subdomains) FROM visits",
    "conversion_session": "SELECT customer_id, wix_order_name, visit_key, channel_grouping FROM conversions",
    "first_visit": "SELECT * FROM first_visits",
    "lookback_start": """
        SELECT customer_id, order_sequence_new, wix_order_stamp, opens AS prior_order_or_first_visit_timestamp FROM lookback""",
    "order_returns": "SELECT * FROM refunds",
    "opt_in_changes": "SELECT * FROM opt_changes",
    "account_status": "SELECT * FROM accounts",
    "app_download": "SELECT * FROM ecom_first",
    "wishlist_sessions": "SELECT * FROM wishes",
    "cart_adds": "SELECT * FROM carts",
    "content_visits": "SELECT * FROM contents",
    "review_features": """
        SELECT customer_id, order_sequence_new, COUNT(*) AS total_reviews, round(AVG(num), 1) AS avg_rating
        FROM met WHERE kind = 'review' GROUP BY ALL""",
    "bounce_rate": """
        SELECT customer_id, order_sequence_new, CAST(COALESCE(SUM(num), 0) AS BIGINT) AS total_bounced_sessions,
               COUNT(num) AS total_sessions, total_bounced_sessions / NULLIF(total_sessions, 0) * 100 AS bounce_rate
        FROM met WHERE kind = 'bounce' GROUP BY customer_id, order_sequence_new""",
    "interval_join": """
        SELECT w.customer_id, w.order_sequence_new, c.visit_start_time
        FROM lookback w LEFT JOIN contents c
          ON c.customer_id = w.customer_id AND c.visit_start_time >= w.opens AND c.visit_start_time <= w.wix_order_stamp""",
})
