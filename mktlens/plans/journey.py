"""Interactions between orders: one row per order with everything the
customer did between the previous order (or the first visit) and this one.

Plan shape (Spark-first):

* order history without per-customer windows: the acquisition date is an
  aggregate joined back, the previous order a window over slices of the
  sequence, the re-sequencing a bucketed row number - a customer with a
  third of all orders is never one task;
* the cleaned orders are used once: refunds and conversions are joined to
  them by key, which keeps only their own, instead of being filtered by them;
* feature sources are reduced to ``(customer_id, t, kind, num, txt)`` rows
  and unioned, so the nine "t between lookback start and order stamp" joins
  become ONE time-bucketed interval join and ONE aggregation keyed by order;
* the written form, where nine one-to-many left joins multiply each other's
  sums (``interactions_between_orders_literal``), is derived from the same
  per-order aggregates by multiplying with the other features' match counts
  instead of materialising the product.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.scalars import date_lit, earlier_of, left_chars, ratio
from mktlens.operators.aggregates import duplicate_keys
from mktlens.operators.joins import LINEAR_WIDTHS, interval_aggregate, null_aware_anti_join
from mktlens.operators.windows import lag_by_sequence, min_by_key, row_number_by
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

ACQUIRED_FROM = "2024-01-02"   # bound data: cohort of customers acquired from this day
DUPLICATE_SEQUENCES = (1, 2)   # order names are checked for repeats among these sequences
BLOG_PATTERN = "%central%"
BUCKET_SECONDS = LINEAR_WIDTHS
ORDER_KEY = ["customer_id", "order_sequence_new"]

# what later steps need of an order window
WINDOW = [*ORDER_KEY, "wix_order_stamp", "wix_order_name", "item_quantity", "first_visit_date",
          "first_visit_timestamp", "prior_order_or_first_visit_timestamp"]

KINDS = ["blog", "review", "ecom", "train", "wish", "cart", "bounce", "opt", "acct"]


# ---------------------------------------------------------------------------
# orders
# ---------------------------------------------------------------------------
def cohort_orders(orders: DataFrame, acquired_from: str = ACQUIRED_FROM, as_of: str | None = None) -> DataFrame:
    """Orders of the customers acquired in ``[acquired_from, as_of]``, with the acquisition date."""
    end = F.current_date() if as_of is None else date_lit(as_of)
    s = min_by_key(orders, ["customer_id"], "order_date", "acquisition_date")
    return s.where(F.col("acquisition_date").between(date_lit(acquired_from), end))


def previous_orders(cohort: DataFrame) -> DataFrame:
    """Local date, prior order date and stamp (repeat orders only) and days
    between orders.  The stored ``order_sequence`` numbers a customer's orders
    without gaps."""
    repeat = F.col("order_sequence") > 1
    s = cohort.withColumn("order_date_local", earlier_of("order_date", "order_date_nam"))
    s = lag_by_sequence(s, ["customer_id"], "order_sequence",
                        {"__prev_date": "order_date", "__prev_stamp": "wix_order_stamp",
                         "__prev_local": "order_date_local"})
    return (s.withColumn("prior_order_date", F.when(repeat, F.col("__prev_date")))
             .withColumn("prior_order_date_timestamp", F.when(repeat, F.col("__prev_stamp")))
             .withColumn("days_btwn_orders", F.datediff(F.col("order_date_local"), F.col("__prev_local")))
             .drop("__prev_date", "__prev_stamp", "__prev_local"))


def order_history(orders: DataFrame, regions: DataFrame, fiscal: DataFrame, acquired_from: str = ACQUIRED_FROM,
                  as_of: str | None = None) -> DataFrame:
    """The cohort's orders with their previous orders, region and fiscal year
    (of the calendar ``fiscal``: cal_date, fiscal_year)."""
    s = previous_orders(cohort_orders(orders, acquired_from, as_of))
    s = s.join(regions, F.upper(s["shipping_country"]) == regions["shipping_country"], "left") \
         .drop(regions["shipping_country"])
    years = fiscal.select(F.col("cal_date").alias("order_date"), "fiscal_year")
    return (s.join(years, "order_date", "left")
             .withColumn("repeat_order_fy", F.when(F.col("order_sequence") > 1, F.col("fiscal_year")))
             .drop("fiscal_year"))


def clean_order_sequence(history: DataFrame, sequences=DUPLICATE_SEQUENCES, cohort: DataFrame | None = None) -> DataFrame:
    """Drop orders whose name is shared by several of the checked sequences
    (``not in``, NULL rules kept), drop orders without a stamp, and number
    the rest again by stamp.  ``cohort``: the same orders before the columns
    of ``history`` were added, so that looking for repeats doesn't plan those."""
    dupes = duplicate_keys((history if cohort is None else cohort).where(F.col("order_sequence").isin(*sequences)),
                           ["customer_id", "wix_order_name"], "order_sequence", distinct=True)
    kept = null_aware_anti_join(history, dupes, "wix_order_name").where(F.col("wix_order_stamp").isNotNull())
    kept = row_number_by(kept, ["customer_id"], ["wix_order_stamp", "order_sequence"], "order_sequence_new",
                         bucket=F.date_trunc("hour", "wix_order_stamp"))
    return kept.withColumn("diff_seq", F.col("order_sequence") - F.col("order_sequence_new"))


def base_orders(t: Tables, acquired_from: str = ACQUIRED_FROM, as_of: str | None = None) -> DataFrame:
    """The cohort's cleaned orders, without the region and fiscal year that no later step reads."""
    cohort = cohort_orders(B.journey_orders(t, located=False), acquired_from, as_of)
    return clean_order_sequence(previous_orders(cohort), cohort=cohort)


# ---------------------------------------------------------------------------
# feature sources
# ---------------------------------------------------------------------------
def clean_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions of customers none of whose orders is attributed to several
    sessions (``customer_id not in (...)``).  A NULL customer is left out of
    the list (decision D12): with SQL's rules it would empty the result;
    NULL customers themselves still drop out, as ``not in`` does."""
    dupes = duplicate_keys(sessions.where(F.col("wix_order_name").isNotNull()),
                           ["customer_id", "wix_order_name"], "wix_order_name", op=">", threshold=1)
    return null_aware_anti_join(sessions, dupes.where(F.col("customer_id").isNotNull()), "customer_id")


def conversion_sessions(visits: DataFrame, base: DataFrame | None) -> DataFrame:
    """Sessions of the base orders; ``None`` where a later join on the order
    name makes the filter redundant."""
    return visits.where(F.col("wix_order_name").isNotNull()) if base is None else visits.join(base.select("wix_order_name").distinct(), "wix_order_name", "left_semi")


def first_visit(visits: DataFrame) -> DataFrame:
    return (visits.where(F.col("web_visit_number") == 1)
            .select("customer_id", F.col("visit_date").alias("first_visit_date"),
                    F.col("visit_start_time").alias("first_visit_timestamp")).distinct())


def order_returns(refunds: DataFrame, base: DataFrame | None) -> DataFrame:
    """Refunds of the base orders; ``None`` as in ``conversion_sessions``."""
    if base is not None:
        names = base.select(F.col("wix_order_name").alias("wix_order_id")).distinct()
        refunds = refunds.join(names, "wix_order_id", "left_semi")
    return (refunds.groupBy("wix_order_id")
            .agg(F.sum("quantity_returned").alias("items_returned"),
                 F.max(left_chars("refund_date", 10)).alias("refund_date")))


def review_features(ratings: DataFrame) -> DataFrame:
    return ratings.select("customer_id", "submitted_at", "rating").distinct()


def opt_in_changes(log: DataFrame, customers: DataFrame) -> DataFrame:
    """Opt-in changes seen exactly once per (customer, from, to, time)."""
    j = log.join(customers.select("email_address", "customer_id"), "email_address", "left") \
           .where(F.col("new_opt_in").isNotNull())
    return (j.groupBy("customer_id", "previous_opt_in", "new_opt_in", F.col("updated_on").alias("change_date"))
            .agg(F.count(F.lit(1)).alias("count")).where(F.col("count") == 1))


def _in_base(df: DataFrame, base: DataFrame | None) -> DataFrame:
    """``customer_id in (select customer_id from base_table)``; ``None``
    skips the filter where a later join on the customer makes it redundant."""
    return df if base is None else df.join(base.select("customer_id").distinct(), "customer_id", "left_semi")


def account_status(log: DataFrame, customers: DataFrame, base: DataFrame | None) -> DataFrame:
    flag = F.when(F.col("new_account_state") == "activated", "Y").otherwise("N")
    j = log.join(customers.select("email", "customer_id"), "email", "left")
    j = _in_base(j, base)
    return j.select("customer_id", "updated_at", flag.alias("account_status")).distinct()


def app_download(visits: DataFrame) -> DataFrame:
    return visits.groupBy("customer_id").agg(F.min("session_date").alias("download_date"))


def wishlist_sessions(log: DataFrame, sessions: DataFrame) -> DataFrame:
    s = sessions.select("visitor_id", F.col("visit_id").alias("visitid"), F.col("visit_date").alias("dates"),
                        "customer_id", "wix_order_name", "visit_start_time")
    j = log.join(s, ["visitor_id", "visitid", "dates"], "left")
    return (j.groupBy("customer_id", "wix_order_name", "visit_start_time", "dates", "visitor_id", "visitid")
            .agg(F.count_distinct("productsku").alias("num_prod_added")))


def cart_adds(interactions: DataFrame, sessions: DataFrame, base: DataFrame | None) -> DataFrame:
    j = interactions.join(sessions.select("visit_key", "visit_start_time", "customer_id", "visit_date",
                                          "wix_order_name"), ["visit_key", "visit_start_time"], "left")
    j = _in_base(j.where(F.col("event_action") == "Added_To_Cart"), base)
    return (j.groupBy("customer_id", "visit_date", "wix_order_name", "visit_key", "visit_start_time")
            .agg(F.count(F.lit(1)).alias("total_cart_adds")))


def content_visits(sessions: DataFrame, base: DataFrame | None, pattern: str = BLOG_PATTERN) -> DataFrame:
    s = _in_base(sessions.where(F.array_join("all_subdomains", " , ").like(pattern)), base)
    return (s.groupBy("customer_id", "wix_order_name", "visit_date", "visit_start_time")
            .agg(F.count_distinct("customer_id").alias("blog_visit_flag")))


def lookback_start(base: DataFrame, first_visits: DataFrame) -> DataFrame:
    """Window start per order: the first visit for the first order when it
    is not later than the order, else the stored previous order's stamp."""
    b = base.join(first_visits, "customer_id", "left")
    start = F.when((F.col("order_sequence_new") == 1) &
                   (F.col("first_visit_timestamp") <= F.col("wix_order_stamp")),
                   F.col("first_visit_timestamp")).otherwise(F.col("prior_order_date_timestamp"))
    return b.withColumn("prior_order_or_first_visit_timestamp", start)


def feature_events(t: Tables, base: DataFrame | None, kinds=tuple(KINDS)) -> DataFrame:
    """All interval features as ``(customer_id, t, kind, num, txt, full)``:
    ``full`` marks rows whose own columns are all non-NULL (``count(t.*)``).
    Only the sources of ``kinds`` are planned.
    With ``base=None`` the "customer is in the base orders" filters of three
    sources are skipped: a feature row only counts when it meets one of its
    customer's order windows, so they cannot change the result."""
    sessions = B.sessions_master(t)
    cust = B.customer_details(t)

    def rows(df, kind, ts, num=None, txt=None, full=None):
        return df.select(
            F.col("customer_id"), F.col(ts).cast("timestamp_ntz").alias("t"), F.lit(kind).alias("kind"),
            (F.col(num).cast("double") if num else F.lit(None).cast("double")).alias("num"),
            (F.col(txt) if txt else F.lit(None).cast("string")).alias("txt"),
            (full if full is not None else F.lit(True)).alias("full"))

    whole_bounce = F.col("customer_id").isNotNull() & F.col("visit_start_time").isNotNull() & F.col("bounces").isNotNull()
    sources = {
        "blog": lambda k: rows(content_visits(sessions, base), k, "visit_start_time"),
        "review": lambda k: rows(review_features(B.customer_ratings(t)), k, "submitted_at", num="rating"),
        "ecom": lambda k: rows(app_download(B.app_visits(t, "ecom")), k, "download_date"),
        "train": lambda k: rows(app_download(B.app_visits(t, "train")), k, "download_date"),
        "wish": lambda k: rows(wishlist_sessions(B.wishlist_logging(t), sessions), k, "visit_start_time", num="num_prod_added"),
        "cart": lambda k: rows(cart_adds(B.product_interactions(t), sessions, base), k, "visit_start_time", num="total_cart_adds"),
        "bounce": lambda k: rows(B.session_bounces(t), k, "visit_start_time", num="bounces", full=whole_bounce),
        "opt": lambda k: rows(opt_in_changes(B.opt_in_log(t), cust), k, "change_date", txt="new_opt_in"),
        "acct": lambda k: rows(account_status(B.account_status_log(t), cust, base), k, "updated_at", txt="account_status"),
    }
    return reduce(DataFrame.unionByName, [sources[k](k) for k in kinds]).where(F.col("customer_id").isNotNull())


def _per_order_features(windows: DataFrame, events: DataFrame, bucket_seconds) -> DataFrame:
    """The order windows with their features, all nine in one aggregation."""
    k = F.col("kind")

    def n_of(kind):
        return F.count_if(k == kind).alias(f"n_{kind}")

    features = [
        *[n_of(x) for x in KINDS],
        F.sum(F.when(k == "review", F.col("num"))).alias("sum_rating"),
        F.count(F.when(k == "review", F.col("num"))).alias("cnt_rating"),
        F.count(F.when(k == "wish", F.col("num"))).alias("cnt_wish"),
        F.sum(F.when(k == "wish", F.coalesce(F.col("num"), F.lit(0.0)))).alias("sum_wish"),
        F.sum(F.when(k == "cart", F.col("num"))).alias("sum_cart"),
        F.sum(F.when(k == "bounce", F.col("num"))).alias("sum_bounce"),
        F.count_if((k == "bounce") & F.col("full")).alias("full_bounce"),
        F.max(F.when(k == "opt", F.col("t"))).alias("max_date"),
        F.max(F.when(k == "opt", F.col("txt"))).alias("latest_opt_status"),
        F.max(F.when(k == "acct", F.col("t"))).alias("updated_at"),
        F.max(F.when(k == "acct", F.coalesce(F.col("txt"), F.lit("N")))).alias("account_status")]
    return interval_aggregate(windows.select(*WINDOW), events, "customer_id", "prior_order_or_first_visit_timestamp",
                              "wix_order_stamp", "t", features, bucket_seconds)


def _equi_features(t: Tables, windows: DataFrame, visits: DataFrame) -> DataFrame:
    conv = conversion_sessions(visits, None).select(
        "customer_id", "wix_order_name", F.col("channel_grouping").alias("conversion_channel"))
    returns = order_returns(B.refunded_items(t), None).select(
        F.col("wix_order_id").alias("wix_order_name"), "items_returned")
    cust = B.customer_details(t).select("customer_id", "customer_gender", "mail_control")
    b = (windows.join(returns, "wix_order_name", "left")
             .join(conv, ["customer_id", "wix_order_name"], "left")
             .join(cust, "customer_id", "left"))
    full_or_part = (F.when(F.col("items_returned") == F.col("item_quantity"), "FULL")
                    .when(F.col("items_returned") < F.col("item_quantity"), "PART"))
    return b.withColumn("full_or_part_return", full_or_part)


def _assemble(rows: DataFrame, mult) -> DataFrame:
    """Final columns from equi-joined rows and per-order feature aggregates;
    ``mult(kind)`` is the factor a kind's sums and counts are repeated by."""
    def n(kind):
        return F.coalesce(F.col(f"n_{kind}"), F.lit(0))

    def yn(kind):
        return F.when(n(kind) > 0, "Y").otherwise("N")

    bounced = F.coalesce(F.col("sum_bounce") * mult("bounce"), F.lit(0.0)).cast("bigint")
    sessions = (F.coalesce(F.col("full_bounce"), F.lit(0)) * mult("bounce")).cast("bigint")
    avg_rating = F.round(ratio(F.col("sum_rating"), F.col("cnt_rating")), 1)
    return rows.select(
        "customer_id", "order_sequence_new", "wix_order_stamp", "wix_order_name", "first_visit_date",
        "first_visit_timestamp", "prior_order_or_first_visit_timestamp", "items_returned",
        "full_or_part_return", "customer_gender", "conversion_channel",
        yn("blog").alias("blog_visit_flag"),
        (n("review") * mult("review")).cast("bigint").alias("total_reviews"),
        avg_rating.alias("avg_rating"),
        yn("ecom").alias("ecom_app_download"),
        yn("train").alias("train_app_download"),
        yn("wish").alias("wishlist_add"),
        (F.coalesce(F.col("cnt_wish"), F.lit(0)) * mult("wish")).cast("bigint").alias("count_wishlist_add"),
        (F.coalesce(F.col("sum_wish"), F.lit(0.0)) * mult("wish")).cast("bigint").alias("wishlist_num_prod_added"),
        F.coalesce(F.col("sum_cart") * mult("cart"), F.lit(0.0)).cast("bigint").alias("total_add_to_carts"),
        bounced.alias("total_bounced_sessions"),
        sessions.alias("total_sessions"),
        (ratio(bounced, sessions) * 100).alias("bounce_rate"),
        "max_date", "latest_opt_status", "updated_at",
        F.coalesce(F.col("account_status"), F.lit("N")).alias("account_status"),
        "mail_control")


def _prepared(t: Tables, bucket_seconds, acquired_from: str = ACQUIRED_FROM, as_of: str | None = None, kinds=tuple(KINDS)):
    """(sessions, first sessions, order windows with the features of ``kinds``)."""
    visits = clean_sessions(B.sessions_master(t))
    firsts = clean_sessions(B.first_sessions(t))
    windows = lookback_start(base_orders(t, acquired_from, as_of), first_visit(firsts))
    feats = _per_order_features(windows, feature_events(t, None, kinds), bucket_seconds)
    return visits, firsts, feats


def interactions_between_orders(t: Tables, bucket_seconds=BUCKET_SECONDS, acquired_from: str = ACQUIRED_FROM,
                                as_of: str | None = None) -> DataFrame:
    """Default form: every feature aggregated per order.  The
    cohort is the customers acquired in ``[acquired_from, as_of]``
    (``as_of=None`` means today)."""
    visits, _, windows = _prepared(t, bucket_seconds, acquired_from, as_of)
    return _assemble(_equi_features(t, windows, visits), lambda kind: F.lit(1))


def interactions_between_orders_literal(t: Tables, bucket_seconds=BUCKET_SECONDS,
                                        acquired_from: str = ACQUIRED_FROM, as_of: str | None = None) -> DataFrame:
    """The written form: first-visit rows joined again per customer, nine
    one-to-many left joins multiplying one another, then grouped by 16 keys.
    Sums and counts of a feature are scaled by the equi-join rows of the
    group and by the match counts of the other eight features."""
    visits, firsts, windows = _prepared(t, bucket_seconds, acquired_from, as_of)
    g1 = firsts.where(F.col("web_visit_number") == 1).select("customer_id").withColumn("__g1", F.lit(1))
    rows = _equi_features(t, windows, visits).join(g1, "customer_id", "left")
    keys = ["customer_id", "order_sequence_new", "wix_order_stamp", "wix_order_name", "first_visit_date",
            "first_visit_timestamp", "prior_order_or_first_visit_timestamp", "items_returned",
            "full_or_part_return", "customer_gender", "conversion_channel", "mail_control"]
    # a group holds one order window, so its features are those of any row
    features = [c for c in windows.columns if c not in WINDOW]
    rows = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__eq"), *[F.first(c).alias(c) for c in features])

    def nn(kind):
        return F.greatest(F.coalesce(F.col(f"n_{kind}"), F.lit(0)), F.lit(1)).cast("bigint")

    def mult(kind):
        others = [nn(k) for k in KINDS if k != kind]
        return reduce(lambda a, b: a * b, others, F.col("__eq").cast("bigint"))

    return _assemble(rows, mult)
