"""Bindings: the marketing relations the plans read, derived from the
driver's tables.

The reference reads warehouse tables (orders, items, sessions, purchase
orders, influencer lists, social posts, ad campaigns) that do not exist
here.  Each function below derives one of them from the driver tables with
plain DataFrame operations, so every plan reads whole tables and its work
grows with them.  The same derivations are written in SQL for the oracle
(``mktlens.plans.oracle``); the two must stay in step.

Money is DECIMAL(18,2) from the start: sums are then exact and do not depend
on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.scalars import money
from mktlens.operators.windows import min_by_key, row_number_by
from mktlens.sources.tables import Tables

# ---------------------------------------------------------------------------
# Fixed values of the bindings: ours, but for the spend categories.
# ---------------------------------------------------------------------------
# Purchase-order categories kept by the spend filter.
SPEND_CATEGORIES = [
    "Influencer Team : Monthly Salary Payments",
    "Influencer Team : Ambassador Monthly Salary Payments",
    "Influencer Team : Influencer Team : Influencer Campaigns",
    "Influencer Team : Influencer Team : Fixed One Year Fees",
    "Influencer Team : Influencer Team : Fixed Three Month Fees",
    "Influencer Team : Influencer Team : Commissions",
    "Influencer Team : Influencer Team : Bonus",
]
# The bound purchase orders also carry one category the filter must drop.
PO_CATEGORIES = [*SPEND_CATEGORIES, "Operations : Office Supplies"]
CHANNELS = ["Direct", "Organic Search", "Paid Social", "Email", "Referral"]
COGS_RATIO = "0.6"          # cost of goods as a share of the line's list price
NET_RATIO = "0.8"           # net sales of a web order as a share of its gross total
FISCAL_START_MONTH = 4
COMPANY_MENTION = "@companynameuk"
EMAIL_DOMAIN = "@mail.example"


def padded_id(number, width: int = 9) -> F.Column:
    """The number as text, zero-padded to ``width`` digits; longer numbers
    keep all their digits (``lpad`` alone would cut them)."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _pick(values: list[str], index_col) -> F.Column:
    """``values[index]`` as a CASE (index is 0-based)."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index_col == i, F.lit(v)) if expr is None else expr.when(index_col == i, F.lit(v))
    return expr


def line_net(t: Tables) -> F.Column:
    price = money(F.col("l_extendedprice"))
    disc = F.col("l_discount").cast("decimal(18,2)")
    return F.round(price * (F.lit(1) - disc), 2).cast("decimal(18,2)")


# ---------------------------------------------------------------------------
# Value (V) and halo (H): orders and their items
# ---------------------------------------------------------------------------
def order_items(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """One row per order from its lines: quantity, net sales and the item
    costs of the value plan (cost of goods, returned value, returned cost).
    One scan of lineitem, one aggregation keyed by order.  With ``orders``
    (order_name) only their lines are read into the aggregation."""
    li = t.lineitem
    if orders is not None:
        li = li.join(orders.select(F.col("order_name").alias("l_orderkey")), "l_orderkey", "left_semi")
    qty = F.col("l_quantity").cast("int")
    net = line_net(t)
    cogs = F.round(money(F.col("l_extendedprice")) * F.lit(COGS_RATIO).cast("decimal(2,1)"), 2).cast("decimal(18,2)")
    returned = F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0))
    return (li.select(F.col("l_orderkey").alias("order_name"), qty.alias("q"), net.alias("net"),
                      cogs.alias("cogs_line"), returned.alias("ret"))
            .groupBy("order_name")
            .agg(F.sum("q").cast("int").alias("item_quantity"),
                 F.sum("net").cast("decimal(18,2)").alias("order_net_sales"),
                 F.sum("cogs_line").alias("cogs"),
                 F.coalesce(F.sum(F.nullif(F.col("net"), F.lit(0)) / F.nullif(F.col("q"), F.lit(0)) * F.col("ret")),
                            F.lit(0)).alias("returns"),
                 F.coalesce(F.sum(F.nullif(F.col("cogs_line"), F.lit(0)) / F.nullif(F.col("q"), F.lit(0)) * F.col("ret")),
                            F.lit(0)).alias("cost_of_goods_returns")))


def items_sold(t: Tables) -> DataFrame:
    """Line level items with their customer (the ``items_sold`` table)."""
    qty = F.col("l_quantity").cast("int")
    cogs = F.round(money(F.col("l_extendedprice")) * F.lit(COGS_RATIO).cast("decimal(2,1)"), 2).cast("decimal(18,2)")
    return (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"),
                            F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_orderkey").alias("order_name"), F.col("o_custkey").alias("customer_id"),
                    cogs.alias("cost_of_goods_gbp"), line_net(t).alias("item_net_rev"),
                    qty.alias("item_quantity"),
                    F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0)).alias("items_returned")))


ITEM_COST_COLS = ("cogs", "returns", "cost_of_goods_returns")


def customer_geo(t: Tables) -> DataFrame:
    """Town (nation) and county (region) of each customer."""
    return (t.customer.select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("customer_id", F.col("n_name").alias("shipping_city"), F.col("r_name").alias("order_shipping_county")))


def customer_orders(t: Tables, with_geo: bool = False, with_item_costs: bool = False, with_sequence: bool = True,
                    with_acquisition: bool = True, only: DataFrame | None = None) -> DataFrame:
    """Orders with acquisition date and stored sequence per customer.

    ``acquisition_date`` (an aggregate joined back) and ``order_sequence``
    (bucketed numbering) do not gather a customer in one task.  ``with_geo``
    adds the customer's town and county; ``with_item_costs`` keeps the
    per-order item costs computed by the same lineitem aggregation.  ``only``
    (customer_id and columns to keep) limits orders and lines to its
    customers before anything is numbered or summed."""
    o = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_name"),
                        F.to_date("o_orderdate").alias("order_date"), money(F.col("o_totalprice")).alias("order_gross_sales"))
    if only is not None:
        o = o.join(only, "customer_id")
    extra = ITEM_COST_COLS if with_item_costs else ()
    items = order_items(t, None if only is None else o).select("order_name", "item_quantity", "order_net_sales", *extra)
    base = o.join(items, "order_name", "left")
    if with_acquisition:
        base = min_by_key(base, ["customer_id"], "order_date", "acquisition_date")
    if with_sequence:   # an inner join Catalyst cannot prune: only when asked
        base = row_number_by(base, ["customer_id"], ["order_date", "order_name"], "order_sequence",
                             bucket=F.col("order_date"))
    return base.join(customer_geo(t), "customer_id", "left") if with_geo else base


def halo_sessions_source(t: Tables) -> DataFrame:
    """Web sessions for the halo plan: one per shipped line, located at the
    supplier's nation.  Lines of open status are anonymous visitors."""
    li = t.lineitem
    geo = (t.supplier.select("s_suppkey", "s_nationkey")
           .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
           .select("s_suppkey", F.col("n_name").alias("geonetwork_city")))
    return (li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("visit_key"),
                    F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("visitor_id"),
                    F.when(F.col("l_linestatus") == "F", F.col("l_suppkey")).alias("customer_id"),
                    F.to_date("l_shipdate").alias("visit_date"),
                    F.col("l_shipdate").alias("visit_start_time"),
                    "geonetwork_city",
                    F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("transactions")))


# ---------------------------------------------------------------------------
# Spend (S), organic (O), paid (P): influencers, purchase orders, posts, ads
# ---------------------------------------------------------------------------
def influencers(t: Tables) -> DataFrame:
    """The influencer database: one influencer per distinct part name and one
    per distinct noun (last word) of the part names.  Ids are even for full
    names and odd for nouns; four consecutive ids share a finance number, so
    some finance numbers are unique and some are not."""
    p = t.part
    full = p.groupBy(F.col("p_name").alias("influencer_name")).agg(
        (F.min("p_partkey") * 2).alias("influencer_id"))
    noun = p.groupBy(F.get(F.split("p_name", " "), 1).alias("influencer_name")).agg(
        (F.min("p_partkey") * 2 + 1).alias("influencer_id"))
    db = full.unionByName(noun)
    return db.select(
        "influencer_id",
        F.col("influencer_id").alias("influencer_id2"),
        "influencer_name",
        F.concat(F.lit("Customer#"),
                 padded_id(F.floor(F.col("influencer_id") / 4))).alias("finance_number"),
        F.concat(F.lit("Publisher "), (F.col("influencer_id") % 5).cast("string")).alias("publisher_name"),
        F.concat(F.lit("CR"), F.col("influencer_id").cast("string")).alias("creator_number"))


def content_posted(t: Tables) -> DataFrame:
    """Social handles: the influencer name with ``_`` for blanks and an upper
    case first letter (so only a case-folded lookup finds it)."""
    name = F.col("influencer_name")
    handle = F.concat(F.upper(F.substring(name, 1, 1)),
                      F.substr(F.replace(name, F.lit(" "), F.lit("_")), F.lit(2)))
    return influencers(t).select("influencer_id2", handle.alias("social_handle"))


def purchase_orders(t: Tables) -> DataFrame:
    """Purchase orders: one per order.  The payment text names the part
    ``o_orderkey mod count(part)`` in one of three wordings; low priority
    orders get a text without any name so the finance-number fallback has
    work.  ``finance_name`` starts with the customer's name."""
    o = t.orders
    n_parts = t.part.agg(F.count(F.lit(1)).alias("n_parts"))
    d = F.to_date("o_orderdate")
    month = F.date_format(d, "MMMM")
    year = F.year(d).cast("string")
    part = t.part.select("p_partkey", "p_name")
    x = (o.join(F.broadcast(n_parts), F.lit(True))          # a global count: one row
         .join(part, (F.col("o_orderkey") % F.col("n_parts")) == F.col("p_partkey"), "left")
         .join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"), "left"))
    k3 = F.col("o_orderkey") % 3
    desc = (F.when(F.col("o_orderpriority") == "5-LOW",
                   F.concat(F.lit("misc work "), F.col("o_orderkey").cast("string")))
            .when(k3 == 0, F.concat(F.lit("Fees "), month, F.lit(" "), year, F.lit(" "), F.col("p_name")))
            .when(k3 == 1, F.concat(F.col("p_name"), F.lit(" "), F.lower(F.substring(month, 1, 3)), F.lit(" "),
                                    F.substring(year, 3, 2), F.lit(" invoice")))
            .otherwise(F.concat(F.lit("Black Friday "), F.col("p_name"))))
    return x.select(
        F.col("o_orderkey").alias("purchaseorder_id"),
        F.col("o_orderpriority").alias("item_title"),
        desc.alias("payment_description"),
        F.concat(F.col("c_name"), F.lit(" LTD")).alias("finance_name"),
        money(F.col("o_totalprice")).alias("amount_gbp"),
        F.lit("Marketing").alias("department"),
        _pick(PO_CATEGORIES, F.col("o_orderkey") % len(PO_CATEGORIES)).alias("purchase_order_description"),
        F.col("o_orderstatus").alias("status"),
        d.cast("string").alias("date_created"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("shipment_received"),
        money(F.col("o_totalprice")).alias("amount_foreign"),
        F.lit("GBP").alias("currency"),
        F.lit("UK").alias("country"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("transaction_id"))


def organic_social_content(t: Tables) -> DataFrame:
    """One post per order.  The caption mentions, in line order, the handle
    of each line's part; every fourth line from the second mentions the
    company account instead.  An order has a bounded number of lines (the
    line number is a small integer), so the per-order caption is bounded."""
    li = t.lineitem.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
    name = F.col("p_name")
    handle = F.concat(F.upper(F.substring(name, 1, 1)),
                      F.substr(F.replace(name, F.lit(" "), F.lit("_")), F.lit(2)))
    mention = F.when(F.col("l_linenumber") % 4 == 2, F.lit(COMPANY_MENTION)).otherwise(F.concat(F.lit("@"), handle))
    posts = (li.select("l_orderkey", "l_linenumber", mention.alias("mention"), "l_quantity",
                       "l_discount", "l_extendedprice")
             .groupBy("l_orderkey")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "mention"))),
                                           lambda s: s["mention"]), " ").alias("caption"),
                  F.sum("l_quantity").cast("bigint").alias("lifetime_engagement"),
                  (F.count(F.lit(1)) * 100).alias("lifetime_reach"),
                  F.max("l_discount").alias("lifetime_engagement_rate"),
                  F.max("l_extendedprice").cast("bigint").alias("video_views_lifetime")))
    o = t.orders.select("o_orderkey", "o_orderdate")
    return (posts.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("content_id"),
                    F.when(F.col("o_orderkey") % 2 == 0, "instagram").otherwise("tiktok").alias("provider_name"),
                    "caption",
                    F.col("o_orderdate").alias("published_at"),
                    F.to_date("o_orderdate").alias("date"),
                    F.concat(F.lit("https://social.example/p/"), F.col("o_orderkey").cast("string")).alias("post_url"),
                    "lifetime_engagement", "lifetime_reach", "lifetime_engagement_rate", "video_views_lifetime"))


def paid_social_campaigns(t: Tables) -> DataFrame:
    """Ad performance rows: one per line, the campaign named after the line's
    part ("Red widget | ECONOMY | Brand#17")."""
    li = t.lineitem.join(t.part.select("p_partkey", "p_name", "p_type", "p_brand"),
                         F.col("l_partkey") == F.col("p_partkey"), "left")
    name = F.col("p_name")
    campaign = F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2)),
                        F.lit(" | "), F.col("p_type"), F.lit(" | "), F.col("p_brand"))
    return li.select(
        campaign.alias("campaign"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("campaign_id"),
        F.when(F.col("l_suppkey") % 2 == 0, "meta").otherwise("tiktok").alias("platform"),
        F.concat(F.lit("acct_"), (F.col("l_suppkey") % 3).cast("string")).alias("account_name"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("territory"),
        F.col("l_linestatus").alias("channel"),
        (F.col("l_quantity").cast("bigint") * 100).alias("impressions"),
        money(F.col("l_extendedprice")).alias("spend"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        line_net(t).alias("ad_revenue"))


# ---------------------------------------------------------------------------
# Journey (J): everything from the web event log
# ---------------------------------------------------------------------------
def _events(t: Tables) -> DataFrame:
    return t.events.withColumn("k", F.regexp_extract("props", r"(\d+)", 1).try_cast("int"))


def _email(user) -> F.Column:
    return F.concat(F.lit("customer."), padded_id(user), F.lit(EMAIL_DOMAIN))


def journey_orders(t: Tables, located: bool = True) -> DataFrame:
    """Purchases as orders, with the stored sequence per customer; the
    customer's country is looked up only when asked."""
    ev = _events(t).where(F.col("event_type") == "purchase")
    geo = (t.customer.select("c_custkey", "c_nationkey")
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .select("c_custkey", F.lower("n_name").alias("shipping_country")))
    ev = row_number_by(ev, ["user_id"], ["ts", "event_id"], "order_sequence", bucket=F.date_trunc("hour", "ts"))
    if located:
        ev = ev.join(geo, F.col("user_id") == F.col("c_custkey"), "left")
    return (ev
            .select(F.col("user_id").alias("customer_id"),
                    "order_sequence",
                    F.to_date("ts").alias("order_date"),
                    F.to_date(F.col("ts") - F.expr("INTERVAL 8 HOURS")).alias("order_date_nam"),
                    F.col("ts").alias("wix_order_stamp"),
                    F.col("event_id").alias("wix_order_name"),
                    F.col("event_id").alias("wix_order_id"),
                    (F.col("k") % 4 + 1).alias("item_quantity"),
                    money(F.col("value")).alias("order_gross_total_gbp"),
                    (F.col("k") % 3).alias("order_flag_id"),
                    F.when((F.col("k") % 3 == 0) & (F.col("k") % 5 >= F.col("k") % 4), "Y").otherwise("N")
                     .alias("fully_returned"),
                    F.round(money(F.col("value")) * F.lit(NET_RATIO).cast("decimal(2,1)"), 2).cast("decimal(18,2)")
                     .alias("order_net_sales_gbp"),
                    F.when(F.col("k") % 2 == 0, "web").otherwise("app").alias("order_store"),
                    *(["shipping_country"] if located else [])))


def fiscal_dates(t: Tables) -> DataFrame:
    """The fiscal calendar: one row per day of the event log, the fiscal year
    named after the calendar year it ends in."""
    span = t.events.agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    day = span.select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))
    year = F.year("cal_date") + F.when(F.month("cal_date") >= FISCAL_START_MONTH, 1).otherwise(0)
    return day.select("cal_date", F.concat(F.lit("FY"), year.cast("string")).alias("fiscal_year"))


def regional_index(t: Tables) -> DataFrame:
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.upper("n_name").alias("shipping_country"), F.col("r_name").alias("region"),
                    F.concat(F.lit("G"), (F.col("n_regionkey") % 2).cast("string")).alias("global_group")))


def refunded_items(t: Tables) -> DataFrame:
    ev = _events(t).where((F.col("event_type") == "purchase") & (F.col("k") % 3 == 0))
    return ev.select(F.col("event_id").alias("wix_order_id"),
                     (F.col("k") % 5 + 1).alias("quantity_returned"),
                     (F.col("ts") + F.expr("INTERVAL 7 DAYS")).cast("string").alias("refund_date"))


def customer_ratings(t: Tables) -> DataFrame:
    ev = _events(t).where(F.col("event_type") == "purchase")
    return ev.select(F.col("user_id").alias("customer_id"),
                     (F.col("ts") + F.expr("INTERVAL 1 DAYS")).alias("submitted_at"),
                     (F.col("k") % 5 + 1).cast("double").alias("rating"))


def customer_details(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("customer_id"),
                    _email(F.col("c_custkey")).alias("email_address"),
                    _email(F.col("c_custkey")).alias("email"),
                    F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("customer_gender"),
                    F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("mail_control"))


def opt_in_log(t: Tables) -> DataFrame:
    ev = _events(t).where(F.col("event_type") == "signup")
    even = F.col("k") % 2 == 0
    return ev.select(_email(F.col("user_id")).alias("email_address"),
                     F.when(even, "N").otherwise("Y").alias("previous_opt_in"),
                     F.when(even, "Y").otherwise("N").alias("new_opt_in"),
                     F.col("ts").alias("updated_on"))


def account_status_log(t: Tables) -> DataFrame:
    ev = _events(t).where(F.col("event_type") == "signup")
    return ev.select(_email(F.col("user_id")).alias("email"),
                     F.col("ts").alias("updated_at"),
                     F.when(F.col("k") % 3 == 0, "suspended").otherwise("activated").alias("new_account_state"))


def app_visits(t: Tables, app: str) -> DataFrame:
    """App sessions: clicks for the shop app, errors for the second app."""
    kind = {"ecom": "click", "train": "error"}[app]
    ev = t.events.where(F.col("event_type") == kind)
    return ev.select(F.col("user_id").alias("customer_id"), F.to_date("ts").alias("session_date"))


def _sessions(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").cast("string").alias("visit_key"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("visitor_id"),
        F.col("event_id").cast("string").alias("visit_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("visit_date"),
        F.col("ts").alias("visit_start_time"),
        "web_visit_number",
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("wix_order_name"),
        _pick(CHANNELS, F.col("k") % len(CHANNELS)).alias("channel_grouping"),
        F.when(F.col("k") % 4 == 0, F.array(F.lit("www"), F.lit("central")))
         .otherwise(F.array(F.lit("www"), F.lit("shop"))).alias("all_subdomains"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("transactions"),
        F.col("event_type"))


def sessions_master(t: Tables, numbered: bool = False) -> DataFrame:
    """Every event is a web session hit; purchases carry their order name.
    ``web_visit_number`` (the customer's visit sequence) is computed only
    when asked: it is the one column that needs a per-customer ordering."""
    ev = _events(t)
    if numbered:
        return _sessions(row_number_by(ev, ["user_id"], ["ts", "event_id"], "web_visit_number",
                                       bucket=F.date_trunc("hour", "ts")))
    return _sessions(ev.withColumn("web_visit_number", F.lit(None).cast("int")))


def first_sessions(t: Tables) -> DataFrame:
    """The sessions of ``sessions_master`` whose ``web_visit_number`` is 1: one
    aggregation per customer, nothing is numbered."""
    row = F.struct("ts", "event_id", "event_type", "k")
    first = _events(t).groupBy("user_id").agg(F.min(row).alias("f"))
    return _sessions(first.select("user_id", "f.*", F.lit(1).alias("web_visit_number")))


def wishlist_logging(t: Tables) -> DataFrame:
    ev = _events(t).where(F.col("event_type") == "signup")
    return ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("visitor_id"),
                     F.col("event_id").cast("string").alias("visitid"),
                     F.to_date("ts").alias("dates"),
                     F.concat(F.lit("SKU-"), (F.col("k") % 10).cast("string")).alias("productsku"))


def product_interactions(t: Tables) -> DataFrame:
    ev = _events(t).where(F.col("event_type") == "click")
    return ev.select(F.col("event_id").cast("string").alias("visit_key"),
                     F.col("ts").alias("visit_start_time"),
                     F.when(F.col("k") % 2 == 0, "Added_To_Cart").otherwise("Viewed").alias("event_action"))


def session_bounces(t: Tables) -> DataFrame:
    """Per session bounce marker: views and errors are sessions, errors bounce."""
    ev = t.events.where(F.col("event_type").isin("view", "error"))
    return ev.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("visit_start_time"),
                     F.when(F.col("event_type") == "error", 1).otherwise(0).alias("bounces"))
