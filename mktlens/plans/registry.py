"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (through ``mktlens.sources``) and
returns a lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktlens.plans import halo as H
from mktlens.plans import journey as J
from mktlens.plans import organic as O
from mktlens.plans import paid as P
from mktlens.plans import spend as S
from mktlens.plans import value as V
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        return fn
    return deco


# --- value -----------------------------------------------------------------
register("customer_value_metrics")(V.customer_value_metrics)
register("customer_value_metrics_literal")(V.customer_value_metrics_literal)
register("retention_flags")(V.retention_flags)


@register("item_costs")
def _item_costs(t: Tables) -> DataFrame:
    c = V.item_costs(B.items_sold(t))
    return c.select("order_name", "customer_id", "cogs",
                    F.round("returns", 2).cast("decimal(38,2)").alias("returns"),
                    F.round("cost_of_goods_returns", 2).cast("decimal(38,2)").alias("cost_of_goods_returns"))


# --- halo ------------------------------------------------------------------
register("event_halo_effect")(H.event_halo_effect)


@register("event_halo_effect_literal_window")
def _halo_literal(t: Tables) -> DataFrame:
    """Moving averages partitioned by event only (towns interleaved)."""
    return H.event_halo_effect(t, literal_window=True)


@register("halo_commercial")
def _halo_commercial(t: Tables) -> DataFrame:
    return H.halo_commercial(H.halo_orders(t))


@register("halo_sessions")
def _halo_sessions(t: Tables) -> DataFrame:
    return H.halo_sessions(H.halo_session_rows(t))


@register("months_to_event")
def _months_to_event(t: Tables) -> DataFrame:
    """Every order with its month offset to the event, offsets in [-12, 12]."""
    o = B.customer_orders(t).select("customer_id", "order_name", "order_date")
    return H.months_to_event(o, H.event_row(t), "order_date").drop("event_start_date")


@register("town_bucket")
def _town_bucket(t: Tables) -> DataFrame:
    """First-match town bucket of every order guarded by the county."""
    o = B.customer_orders(t, with_geo=True)
    b = H.bucket_first_match("shipping_city", H.TOWNS)
    return (o.where(F.lower("order_shipping_county") == H.COUNTY)
             .select("order_name", "shipping_city", b.alias("town_bucket")))


@register("event_lookup")
def _event_lookup(t: Tables) -> DataFrame:
    """The event table derived from regions, filtered to one event."""
    return H.event_row(t)


@register("top_k")
def _top_k(t: Tables) -> DataFrame:
    """The first 10 000 halo sessions by (customer, visit start, key):
    a top-k report, the limit is the feature."""
    from mktlens.operators.topk import top_k
    s = B.halo_sessions_source(t)
    order = [F.col(c).asc_nulls_last() for c in
             ["customer_id", "visit_start_time", "visit_key", "visitor_id", "visit_date",
              "geonetwork_city", "transactions"]]
    return top_k(s, order, 10000, lead="customer_id")


# --- spend -----------------------------------------------------------------
@register("spend_attribution")
def _spend(t: Tables) -> DataFrame:
    return S.spend_attribution_plan(t)


@register("spend_filter")
def _spend_filter(t: Tables) -> DataFrame:
    return S.spend_filter(B.purchase_orders(t))


@register("infer_year_month")
def _infer_year_month(t: Tables) -> DataFrame:
    d = S.infer_year_month(S.spend_filter(B.purchase_orders(t)))
    return d.select("purchaseorder_id", "payment_description", "date_created", "month_part", "year_part",
                    "year_month_concat", "year_month_created", "year_month_inferred")


@register("attribute_by_name")
def _attribute_by_name(t: Tables) -> DataFrame:
    return S.attribute_by_name(S.infer_year_month(S.spend_filter(B.purchase_orders(t))), B.influencers(t))


@register("attribute_by_number")
def _attribute_by_number(t: Tables) -> DataFrame:
    by_name = S.attribute_by_name(S.infer_year_month(S.spend_filter(B.purchase_orders(t))), B.influencers(t))
    return S.attribute_by_number(by_name.where(F.col("influencer_name").isNull()), B.influencers(t))


@register("spend_attribution_wildcards")
def _spend_wildcards(t: Tables) -> DataFrame:
    """As written: LIKE patterns, so '_' and '%' in names match any text."""
    return S.spend_attribution_plan(t, wildcards=True)


@register("unique_finance_numbers")
def _unique_finance_numbers(t: Tables) -> DataFrame:
    return S.unique_finance_numbers(B.influencers(t))


@register("wildcard_left_join")
def _wildcard_left_join(t: Tables) -> DataFrame:
    """Which benchmark passages occur, whole, inside which documents
    (case folded); documents without any keep one row with NULL."""
    from mktlens.operators.joins import wildcard_join
    docs = t.documents.select("doc_id", "text")
    bench = t.benchmark.select("item_id", F.col("text").alias("passage"))
    return wildcard_join(docs, bench, "text", "passage", how="left").select("doc_id", "item_id")


@register("wildcard_join_many_names")
def _wildcard_many(t: Tables) -> DataFrame:
    """Names from a high-cardinality column: which customers' accounts occur
    in the purchase orders' finance names."""
    from mktlens.operators.joins import wildcard_join
    pos = B.purchase_orders(t).select("purchaseorder_id", "finance_name")
    accounts = t.customer.select("c_custkey", F.concat("c_name", F.lit(" LTD")).alias("account"))
    return wildcard_join(pos, accounts, "finance_name", "account", how="inner").select("purchaseorder_id", "c_custkey")


# --- organic ---------------------------------------------------------------
register("organic_post_attribution")(O.organic_post_attribution)
register("unpivot_slots")(O.unpivot_mention_slots)


@register("handle_lookup")
def _handle_lookup(t: Tables) -> DataFrame:
    return O.handle_lookup(B.content_posted(t), B.influencers(t))


@register("extract_mentions")
def _extract_mentions(t: Tables) -> DataFrame:
    return O.extract_mentions(B.organic_social_content(t))


@register("resolve_mentions")
def _resolve_mentions(t: Tables) -> DataFrame:
    lookup = O.handle_lookup(B.content_posted(t), B.influencers(t))
    return O.resolve_mentions(B.organic_social_content(t), lookup)


register("multi_slot_lookup")(O.lookup_mention_slots)


# --- paid ------------------------------------------------------------------
register("paid_ad_attribution")(P.paid_ad_attribution)


@register("paid_ad_attribution_wildcards")
def _paid_wildcards(t: Tables) -> DataFrame:
    """As written: LIKE patterns, so '_' in handles matches any character."""
    return P.paid_ad_attribution(t, wildcards=True)


@register("match_campaigns_wildcards")
def _match_campaigns_wildcards(t: Tables) -> DataFrame:
    infl = B.influencers(t)
    return P.match_campaigns(P.campaign_catalogue(B.paid_social_campaigns(t)),
                             P.name_variants(infl, B.content_posted(t)), infl, wildcards=True)


@register("name_variants")
def _name_variants(t: Tables) -> DataFrame:
    return P.name_variants(B.influencers(t), B.content_posted(t))


@register("campaign_catalogue")
def _campaign_catalogue(t: Tables) -> DataFrame:
    return P.campaign_catalogue(B.paid_social_campaigns(t))


@register("match_campaigns")
def _match_campaigns(t: Tables) -> DataFrame:
    infl = B.influencers(t)
    return P.match_campaigns(P.campaign_catalogue(B.paid_social_campaigns(t)),
                             P.name_variants(infl, B.content_posted(t)), infl)


@register("wildcard_inner_join")
def _wildcard_inner_join(t: Tables) -> DataFrame:
    """Distinct campaign titles x name variants of at least five characters
    contained in them (inner)."""
    from mktlens.operators.joins import wildcard_join
    titles = B.paid_social_campaigns(t).select(F.lower("campaign").alias("campaign")).distinct()
    names = P.name_variants(B.influencers(t), B.content_posted(t)).where(F.length("name") >= P.MIN_NAME_LENGTH)
    return wildcard_join(titles, names, "campaign", "name", how="inner").select("campaign", "name", "influencer_id")


# --- journey ---------------------------------------------------------------
register("interactions_between_orders")(J.interactions_between_orders)
register("interactions_between_orders_literal")(J.interactions_between_orders_literal)


@register("interactions_view")
def _interactions_view(t: Tables) -> DataFrame:
    """The journey plan as a view, read back by name."""
    from mktlens.sources.sinks import view_sink
    return view_sink(J.interactions_between_orders(t), "mktlens_interactions_between_orders")


@register("order_history")
def _order_history(t: Tables) -> DataFrame:
    return J.order_history(B.journey_orders(t), B.regional_index(t), B.fiscal_dates(t))


@register("clean_order_sequence")
def _clean_order_sequence(t: Tables) -> DataFrame:
    return J.base_orders(t).select("customer_id", "order_sequence", "order_sequence_new", "diff_seq",
                                   "wix_order_name", "wix_order_stamp")


@register("clean_sessions")
def _clean_sessions(t: Tables) -> DataFrame:
    return J.clean_sessions(B.sessions_master(t, numbered=True)).drop("all_subdomains")


@register("conversion_session")
def _conversion_session(t: Tables) -> DataFrame:
    v = J.conversion_sessions(J.clean_sessions(B.sessions_master(t)), J.base_orders(t))
    return v.select("customer_id", "wix_order_name", "visit_key", "channel_grouping")


@register("first_visit")
def _first_visit(t: Tables) -> DataFrame:
    return J.first_visit(J.clean_sessions(B.sessions_master(t, numbered=True)))


@register("lookback_start")
def _lookback_start(t: Tables) -> DataFrame:
    b = J.lookback_start(J.base_orders(t), J.first_visit(J.clean_sessions(B.sessions_master(t, numbered=True))))
    return b.select("customer_id", "order_sequence_new", "wix_order_stamp", "prior_order_or_first_visit_timestamp")


@register("order_returns")
def _order_returns(t: Tables) -> DataFrame:
    return J.order_returns(B.refunded_items(t), J.base_orders(t))


@register("opt_in_changes")
def _opt_in_changes(t: Tables) -> DataFrame:
    return J.opt_in_changes(B.opt_in_log(t), B.customer_details(t))


@register("account_status")
def _account_status(t: Tables) -> DataFrame:
    return J.account_status(B.account_status_log(t), B.customer_details(t), J.base_orders(t))


@register("app_download")
def _app_download(t: Tables) -> DataFrame:
    return J.app_download(B.app_visits(t, "ecom"))


@register("wishlist_sessions")
def _wishlist_sessions(t: Tables) -> DataFrame:
    return J.wishlist_sessions(B.wishlist_logging(t), B.sessions_master(t))


@register("cart_adds")
def _cart_adds(t: Tables) -> DataFrame:
    return J.cart_adds(B.product_interactions(t), B.sessions_master(t), J.base_orders(t))


@register("content_visits")
def _content_visits(t: Tables) -> DataFrame:
    return J.content_visits(B.sessions_master(t), J.base_orders(t))


def _journey_features(t: Tables, kind: str) -> DataFrame:
    """Per-order features of one kind: only its source and the order windows are read."""
    _, _, feats = J._prepared(t, J.BUCKET_SECONDS, kinds=(kind,))
    return feats


@register("review_features")
def _review_features(t: Tables) -> DataFrame:
    f = _journey_features(t, "review").where(F.col("n_review") > 0)
    return f.select(*J.ORDER_KEY, F.col("n_review").alias("total_reviews"),
                    F.round(F.try_divide(F.col("sum_rating"), F.col("cnt_rating")), 1).alias("avg_rating"))


@register("bounce_rate")
def _bounce_rate(t: Tables) -> DataFrame:
    from mktlens.functions.scalars import ratio
    f = _journey_features(t, "bounce").where(F.col("n_bounce") > 0)
    bounced = F.coalesce(F.col("sum_bounce"), F.lit(0.0)).cast("bigint")
    return f.select(*J.ORDER_KEY, bounced.alias("total_bounced_sessions"),
                    F.col("full_bounce").alias("total_sessions"),
                    (ratio(bounced, F.col("full_bounce")) * 100).alias("bounce_rate"))


@register("interval_join")
def _interval_join(t: Tables) -> DataFrame:
    """Orders' lookback windows left-joined with the content visits inside
    them (time-bucketed interval join), one row per pair."""
    from mktlens.operators.joins import interval_join
    w = J.lookback_start(J.base_orders(t), J.first_visit(J.clean_sessions(B.first_sessions(t))))
    w = w.select("customer_id", "order_sequence_new", F.col("prior_order_or_first_visit_timestamp").alias("lo"),
                 F.col("wix_order_stamp").alias("hi"))
    blog = J.content_visits(B.sessions_master(t), None).select("customer_id", "visit_start_time")
    return interval_join(w, blog, "customer_id", "lo", "hi", "visit_start_time", how="left",
                         bucket_seconds=J.BUCKET_SECONDS, left_id=J.ORDER_KEY).select("customer_id", "order_sequence_new", "visit_start_time")


# --- operator-level catalog ----------------------------------------------------
from mktlens.plans.catalog import CATALOG  # noqa: E402

for _key, _fn in CATALOG.items():
    register(_key)(_fn)
