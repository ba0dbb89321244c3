"""Commercial halo of a local event: per town and month around the event
start, customers, new customers, sales and web visitors, with 3-month moving
averages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.predicates import bucket_first_match
from mktlens.functions.scalars import month_boundaries, ratio
from mktlens.operators.joins import constant_row_join
from mktlens.operators.topk import top_k
from mktlens.operators.windows import moving_average
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

# Fixed values of the bound data: the event and the towns around it.  Towns
# are unbounded substrings, first match wins ('%nation_1%' also catches
# NATION_16 once NATION_6/21/11 had their turn), guarded by the county.
EVENT_NAME = "AMERICA_MARKET"
COUNTY = "america"
TOWNS = [
    (["%nation_6%"], "NATION_6"),
    (["%nation_21%"], "NATION_21"),
    (["%nation_11%"], "NATION_11"),
    (["%nation_1%"], "NATION_1"),
]
MONTHS = (-12, 12)
FRAME_ROWS = 3


def events_lookup(t: Tables) -> DataFrame:
    """One market event per region, starting in month ``regionkey + 1`` of
    1998, held in the region's first nation."""
    r, n = t.region, t.nation
    first_nation = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n_nationkey"))
    return (r.join(first_nation, F.col("r_regionkey") == F.col("n_regionkey"))
            .join(n.select("n_nationkey", "n_name"), "n_nationkey")
            .select(F.concat(F.col("r_name"), F.lit("_MARKET")).alias("event_name"),
                    F.make_date(F.lit(1998), F.col("r_regionkey") + 1, F.lit(1)).alias("event_start_date"),
                    F.lower("n_name").alias("town")))


def event_row(t: Tables, event_name: str = EVENT_NAME) -> DataFrame:
    """The one-row lookup ``(select ... where event_name = :name)``."""
    return events_lookup(t).where(F.col("event_name") == event_name).select("event_name", "event_start_date")


def months_to_event(df: DataFrame, event: DataFrame, date_col: str,
                    lo: int = MONTHS[0], hi: int = MONTHS[1]) -> DataFrame:
    """Attach the event (left join; an event of several rows counts once per row) and keep rows whose
    month offset to the event start lies in ``[lo, hi]``."""
    out = constant_row_join(df, event)
    out = out.withColumn("months_to_popup_event", month_boundaries("event_start_date", date_col))
    return out.where(F.col("months_to_popup_event").between(lo, hi))


def halo_orders(t: Tables, towns=TOWNS, county: str = COUNTY, event_name: str = EVENT_NAME,
                event: DataFrame | None = None) -> DataFrame:
    # town and county belong to the customer: the few customers are chosen
    # first and only their orders and lines are numbered and summed
    near = (B.customer_geo(t).where(F.lower("order_shipping_county") == county)
            .withColumn("shipping_city", bucket_first_match("shipping_city", towns))
            .where(F.col("shipping_city").isNotNull()))
    o = B.customer_orders(t, only=near, with_acquisition=False).where(F.col("item_quantity") > 0)
    ev = event if event is not None else event_row(t, event_name)
    return months_to_event(o, ev, "order_date")


def halo_commercial(orders: DataFrame) -> DataFrame:
    new = F.col("order_sequence") == 1
    return (orders.groupBy("event_name", "shipping_city", "months_to_popup_event")
            .agg(F.count_distinct("customer_id").alias("distinct_customers"),
                 F.count_distinct(F.when(new, F.col("customer_id"))).alias("new_customers"),
                 F.sum("order_net_sales").cast("decimal(38,2)").alias("total_sales"),
                 F.sum(F.when(new, F.col("order_net_sales"))).cast("decimal(38,2)").alias("new_customer_sales"),
                 F.count("order_name").alias("total_orders"),
                 F.count(F.when(new, F.col("order_name"))).alias("new_customer_orders")))


def halo_session_rows(t: Tables, towns=TOWNS, event_name: str = EVENT_NAME,
                      k: int | None = None, event: DataFrame | None = None) -> DataFrame:
    s = B.halo_sessions_source(t)
    s = (s.withColumn("browsing_city", bucket_first_match("geonetwork_city", towns))
          .where(F.col("browsing_city").isNotNull()))
    ev = event if event is not None else event_row(t, event_name)
    s = months_to_event(s, ev, "visit_date")
    if k is not None:   # the reference's row cap, off by default
        s = top_k(s, [F.col(c).asc_nulls_last() for c in ["customer_id", "visit_start_time", "visit_key"]], k)
    return s


def halo_sessions(sessions: DataFrame) -> DataFrame:
    visitor = F.coalesce(F.col("customer_id").cast("string"), F.col("visitor_id"))
    out = (sessions.groupBy("event_name", "browsing_city", "months_to_popup_event")
           .agg(F.count("visit_key").alias("total_sessions"),
                F.count_distinct(visitor).alias("total_visitors_estimate"),
                F.sum("transactions").cast("bigint").alias("total_orders_ga")))
    return out.withColumn("ga_cvr_approx", F.round(ratio(F.col("total_orders_ga").cast("decimal(38,0)"),
                                                          F.col("total_sessions")), 3).cast("decimal(38,3)"))


def event_halo(commercial: DataFrame, sessions: DataFrame, literal_window: bool = False,
               rows: int = FRAME_ROWS) -> DataFrame:
    """Merge commercial and session stats per (event, town, month) and add the
    moving averages.  Default frame: per event and town (a town's months);
    ``literal_window`` partitions by event only, towns interleaved by month
    with the town as tie-breaker."""
    s = sessions.withColumnRenamed("browsing_city", "shipping_city")
    h = commercial.join(s, ["event_name", "shipping_city", "months_to_popup_event"], "left")
    if literal_window:
        part, order = ["event_name"], ["months_to_popup_event", "shipping_city"]
    else:
        part, order = ["event_name", "shipping_city"], ["months_to_popup_event"]
    return h.select(
        "event_name", "shipping_city", "months_to_popup_event", "distinct_customers", "new_customers",
        "total_sales", "new_customer_sales", "total_orders", "new_customer_orders",
        "total_sessions", "total_visitors_estimate", "total_orders_ga", "ga_cvr_approx",
        moving_average("total_visitors_estimate", part, order, rows).alias("avg_visitors_l3m"),
        moving_average("new_customers", part, order, rows).alias("avg_new_customers_l3m"),
        moving_average("total_sales", part, order, rows, 2).cast("decimal(38,2)").alias("avg_net_sales_l3m"))


def event_halo_effect(t: Tables, literal_window: bool = False, k: int | None = None) -> DataFrame:
    """``k`` keeps the original's cap on session rows (its ``top 10000``,
    first by customer and visit start); off by default."""
    ev = event_row(t)       # one lookup for both sides
    commercial = halo_commercial(halo_orders(t, event=ev))
    sessions = halo_sessions(halo_session_rows(t, k=k, event=ev))
    return event_halo(commercial, sessions, literal_window).orderBy("shipping_city", "months_to_popup_event")
