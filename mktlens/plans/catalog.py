"""Operator-level queries: one small query per relational operator or
function of the original scripts, each over whole driver tables (or the
relations bound from them).  They pin down each operator's semantics
against the SQL oracle independently of the plans that combine them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.predicates import all_of, any_of, like_ci, not_like_prefix
from mktlens.functions.scalars import (date_lit, days_between, earlier_of, left_chars, money, month_boundaries,
                                       ratio, regexp_delete, regexp_nth, strip_spaces)
from mktlens.operators.aggregates import count_nonnull_rows, duplicate_keys
from mktlens.operators.joins import constant_row_join, null_aware_anti_join, unmatched_rows
from mktlens.operators.sets import union_all_by_name
from mktlens.operators.windows import lag_by_sequence, moving_average, row_number_by
from mktlens.plans import halo as H
from mktlens.plans import organic as O
from mktlens.plans import paid as P
from mktlens.plans import spend as S
from mktlens.plans import value as V
from mktlens.sources import bindings as B
from mktlens.sources.sinks import ctas_sink, view_sink
from mktlens.sources.tables import Tables

CATALOG: dict = {}

MENTION = O.MENTION_PATTERN


def q(key: str):
    def deco(fn):
        CATALOG[key] = fn
        return fn
    return deco


def _odate():
    return F.to_date("o_orderdate")


# --- sources and sinks ------------------------------------------------------
@q("scan_tables")
def scan_tables(t: Tables) -> DataFrame:
    """Whole-table scan with pruned columns."""
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")


@q("view_sink")
def view_sink_q(t: Tables) -> DataFrame:
    """``create or replace view``: a temporary view read back by name."""
    counts = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count(F.lit(1)).alias("n_orders"))
    return view_sink(counts, "mktlens_customer_order_counts")


@q("ctas_sink")
def ctas_sink_q(t: Tables) -> DataFrame:
    """``create table as``: the campaign catalogue written once to the
    session's shared checkpoint folder and read back."""
    spark = t.spark
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        from mktlens.session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/ctas/{uuid.uuid4().hex}"
    return ctas_sink(P.campaign_catalogue(B.paid_social_campaigns(t)), path)


# --- projection ---------------------------------------------------------------
@q("project_alias")
def project_alias(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_name"), F.col("o_custkey").alias("customer_id"),
                           money("o_totalprice").alias("order_gross_sales"))


@q("project_star")
def project_star(t: Tables) -> DataFrame:
    return t.customer.select("*", (F.col("c_acctbal") > 0).alias("in_credit"))


@q("cte_chain")
def cte_chain(t: Tables) -> DataFrame:
    """items -> per-order costs -> per-customer cost of goods: a CTE chain as
    three functions."""
    costs = V.item_costs(B.items_sold(t))
    return costs.groupBy("customer_id").agg(F.sum("cogs").cast("decimal(38,2)").alias("cogs"))


@q("nested_cte")
def nested_cte(t: Tables) -> DataFrame:
    """Orders of customers without two orders on one day (the duplicate list
    is local to the query, like a CTE inside a CTE)."""
    o = t.orders.select("o_orderkey", "o_custkey", _odate().alias("d"))
    dupes = o.groupBy("o_custkey", "d").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return null_aware_anti_join(o, dupes.select("o_custkey"), "o_custkey").select("o_orderkey", "o_custkey")


@q("derived_table")
def derived_table(t: Tables) -> DataFrame:
    firsts = t.orders.groupBy("o_custkey").agg(F.min(_odate()).alias("first_order_date"))
    return t.orders.join(firsts, "o_custkey", "left").select("o_orderkey", "first_order_date")


@q("lateral_alias")
def lateral_alias(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", _odate().alias("order_date"))
    o = o.withColumn("order_year", F.year("order_date"))
    return o.withColumn("order_decade", F.col("order_year") - F.col("order_year") % 10).drop("order_date")


@q("ratio_of_aggregates")
def ratio_of_aggregates(t: Tables) -> DataFrame:
    agg = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.sum(money("o_totalprice")).cast("decimal(38,2)").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"))
    return agg.withColumn("aov", F.round(ratio("total_revenue", "total_orders"), 4).cast("decimal(38,4)"))


@q("alias_predicate")
def alias_predicate(t: Tables) -> DataFrame:
    """An alias used in WHERE: computed first, then filtered."""
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    return o.where(F.col("order_year") == 1997)


@q("quoted_identifier")
def quoted_identifier(t: Tables) -> DataFrame:
    return B.organic_social_content(t).select("content_id", F.col("`date`"))


@q("case_bucket")
def case_bucket(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(p > 300000, "high").when(p > 100000, "mid").alias("bucket"))


# --- filters ------------------------------------------------------------------
@q("filter_compare")
def filter_compare(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.where((F.col("l_quantity") < 5) & (F.col("l_discount") >= 0.05) & (F.col("l_linenumber") <= 3)
                    & (F.col("l_tax") > 0) & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_linenumber")


@q("filter_between_dates")
def filter_between_dates(t: Tables) -> DataFrame:
    return t.orders.where(_odate().between(date_lit("1997-01-01"), date_lit("1997-12-31"))).select("o_orderkey")


@q("filter_between_ints")
def filter_between_ints(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", month_boundaries(F.lit("1998-06-01").cast("date"), _odate()).alias("m"))
    return o.where(F.col("m").between(-12, 12))


@q("between_flag")
def between_flag(t: Tables) -> DataFrame:
    """``case when t between a and b then 'Y' else 'N'`` with a NULL bound."""
    e = t.events.select("user_id", "ts", "event_id")
    e = row_number_by(e, ["user_id"], ["ts", "event_id"], "seq", bucket=F.date_trunc("hour", "ts"))
    e = lag_by_sequence(e, ["user_id"], "seq", {"prev_ts": "ts"})
    inside = F.col("ts").between(F.col("prev_ts"), F.col("prev_ts") + F.expr("INTERVAL 1 HOURS"))
    return e.select("event_id", F.when(inside, "Y").otherwise("N").alias("flag"))


@q("filter_in_list")
def filter_in_list(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@q("semi_join")
def semi_join(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.join(urgent, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@q("null_aware_anti_join")
def null_aware_anti_join_q(t: Tables) -> DataFrame:
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select("o_custkey")
    return null_aware_anti_join(t.customer, recent, "c_custkey", "o_custkey").select("c_custkey")


@q("filter_nulls")
def filter_nulls(t: Tables) -> DataFrame:
    s = B.halo_sessions_source(t)
    return s.where(F.col("customer_id").isNull() & F.col("geonetwork_city").isNotNull()).select("visit_key", "visitor_id")


@q("filter_like")
def filter_like(t: Tables) -> DataFrame:
    return t.part.where(like_ci("p_name", "%widget%") | like_ci("p_name", "red%")).select("p_partkey")


@q("filter_not_like")
def filter_not_like(t: Tables) -> DataFrame:
    return t.customer.where(not_like_prefix("c_name", "Customer#0000001")).select("c_custkey")


@q("filter_boolean_tree")
def filter_boolean_tree(t: Tables) -> DataFrame:
    c = F.col
    tree = any_of([all_of([c("l_returnflag") == "R", c("l_quantity") > 40]),
                   all_of([c("l_returnflag") == "A", c("l_discount") == 0]),
                   all_of([c("l_linestatus") == "O", c("l_tax") > 0.07])])
    return t.lineitem.where(tree).select("l_orderkey", "l_linenumber")


@q("filter_contains")
def filter_contains(t: Tables) -> DataFrame:
    return t.documents.where(F.col("text").contains("@")).select("doc_id")


@q("filter_length")
def filter_length(t: Tables) -> DataFrame:
    return t.part.where(F.length("p_name") > 9).select("p_partkey", "p_name")


@q("having")
def having(t: Tables) -> DataFrame:
    return (t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
            .where(F.col("n_orders") > 12))


# --- joins --------------------------------------------------------------------
@q("left_equi_join")
def left_equi_join(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@q("multi_key_join")
def multi_key_join(t: Tables) -> DataFrame:
    pairs = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n_pair"))
    return t.lineitem.join(pairs, ["l_partkey", "l_suppkey"], "left").select("l_orderkey", "l_linenumber", "n_pair")


@q("using_join")
def using_join(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_name"))
    return o.join(B.customer_details(t).select("customer_id", "customer_gender"), "customer_id", "left")


@q("function_key_join")
def function_key_join(t: Tables) -> DataFrame:
    o, r = B.journey_orders(t), B.regional_index(t)
    return o.join(r, F.upper(o["shipping_country"]) == r["shipping_country"], "left").select("wix_order_name", "region")


@q("constant_row_join")
def constant_row_join_q(t: Tables) -> DataFrame:
    return constant_row_join(t.orders.select("o_orderkey"), H.event_row(t)).select("o_orderkey", "event_name")


@q("unmatched_rows")
def unmatched_rows_q(t: Tables) -> DataFrame:
    by_name = S.attribute_by_name(S.infer_year_month(S.spend_filter(B.purchase_orders(t))), B.influencers(t))
    return unmatched_rows(by_name, "influencer_name").select("purchaseorder_id")


@q("acquisition_cohort_filter")
def acquisition_cohort_filter(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", _odate().alias("d"))
    acq = o.groupBy("o_custkey").agg(F.min("d").alias("acquisition_date"))
    return (o.join(acq, "o_custkey", "inner")
            .where(F.col("acquisition_date").between(date_lit("1995-01-01"), date_lit("1995-01-31")))
            .select("o_orderkey", "acquisition_date"))


# --- aggregates ---------------------------------------------------------------
@q("group_by_ordinal")
def group_by_ordinal(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@q("group_by_named")
def group_by_named(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).cast("decimal(38,2)").alias("revenue"))


@q("agg_sum")
def agg_sum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).cast("decimal(38,2)").alias("total"),
                                               F.sum(F.col("l_quantity").cast("int")).alias("qty"))


@q("agg_min")
def agg_min(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_ts"))


@q("agg_max")
def agg_max(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("max_priority"),
                                            F.max("o_orderstatus").alias("max_status"),
                                            F.max(money("o_totalprice")).alias("max_price"))


@q("agg_avg")
def agg_avg(t: Tables) -> DataFrame:
    return B.customer_ratings(t).groupBy("customer_id").agg(F.round(F.avg("rating"), 1).alias("avg_rating"))


@q("agg_count_star")
def agg_count_star(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@q("agg_count_col")
def agg_count_col(t: Tables) -> DataFrame:
    s = B.halo_sessions_source(t)
    return s.groupBy("geonetwork_city").agg(F.count("customer_id").alias("n_known"))


@q("agg_count_distinct")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("orders"),
                                                 F.count_distinct("l_suppkey").alias("suppliers"))


@q("agg_count_row_nonnull")
def agg_count_row_nonnull(t: Tables) -> DataFrame:
    s = B.halo_sessions_source(t)
    return s.groupBy("transactions").agg(
        count_nonnull_rows(["customer_id", "visitor_id", "geonetwork_city"]).alias("full_rows"))


@q("agg_conditional_sum")
def agg_conditional_sum(t: Tables) -> DataFrame:
    r = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(F.when(r, F.col("l_quantity").cast("int"))).alias("returned_qty"))


@q("agg_conditional_count")
def agg_conditional_count(t: Tables) -> DataFrame:
    u = F.col("o_orderpriority") == "1-URGENT"
    return t.orders.groupBy("o_custkey").agg(F.count(F.when(u, F.col("o_orderkey"))).alias("urgent_orders"),
                                            F.count_distinct(F.when(u, F.col("o_orderstatus"))).alias("urgent_statuses"))


@q("agg_guarded_ratio_sum")
def agg_guarded_ratio_sum(t: Tables) -> DataFrame:
    c = V.item_costs(B.items_sold(t))
    return c.select("order_name", F.round("returns", 2).cast("decimal(38,2)").alias("returns"))


@q("agg_coalesce")
def agg_coalesce(t: Tables) -> DataFrame:
    s = B.halo_sessions_source(t)
    return s.groupBy("geonetwork_city").agg(
        F.sum(F.coalesce(F.col("customer_id"), F.lit(0))).alias("sum_of_coalesced"),
        F.coalesce(F.sum("customer_id"), F.lit(0)).alias("coalesced_sum"))


@q("agg_listagg")
def agg_listagg(t: Tables) -> DataFrame:
    """Per order, whose few lines bound the length of the list."""
    return t.lineitem.groupBy("l_orderkey").agg(P.ordered_listagg("l_returnflag", ",").alias("flags"))


@q("distinct_rows")
def distinct_rows(t: Tables) -> DataFrame:
    return t.part.select("p_name", "p_type").distinct()


@q("presence_flag")
def presence_flag(t: Tables) -> DataFrame:
    late = t.orders.where(F.year("o_orderdate") == 2001).select(F.col("o_custkey").alias("c_custkey")).distinct() \
                   .withColumn("k", F.col("c_custkey"))
    j = t.customer.select("c_custkey").join(late, "c_custkey", "left")
    return j.select("c_custkey", F.when(F.col("k").isNotNull(), "Y").otherwise("N").alias("ordered_2001"))


@q("duplicate_keys")
def duplicate_keys_q(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey", op=">", threshold=1)


@q("first_order_date")
def first_order_date(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min(_odate()).alias("acquisition_date"))


# --- windows ------------------------------------------------------------------
@q("window_lag")
def window_lag(t: Tables) -> DataFrame:
    o = B.customer_orders(t).select("customer_id", "order_name", "order_date", "order_sequence")
    o = lag_by_sequence(o, ["customer_id"], "order_sequence", {"prior_order_date": "order_date"})
    return o.select("customer_id", "order_name", "prior_order_date")


@q("window_gap_days")
def window_gap_days(t: Tables) -> DataFrame:
    o = B.customer_orders(t).select("customer_id", "order_name", "order_date", "order_sequence")
    o = lag_by_sequence(o, ["customer_id"], "order_sequence", {"prior": "order_date"})
    return o.select("customer_id", "order_name", F.datediff("order_date", "prior").alias("gap_days"))


@q("window_row_number")
def window_row_number(t: Tables) -> DataFrame:
    o = B.customer_orders(t).select("customer_id", "order_name", "order_gross_sales", "order_sequence")
    # descending value (NULL last) as an ascending column, sliced by value
    lowest = F.lit("9999999999999999.99").cast("decimal(18,2)")
    o = o.withColumn("falling", F.coalesce(-F.col("order_gross_sales"), lowest))
    o = row_number_by(o, ["customer_id"], ["falling", "order_name"], "rank_by_value",
                      bucket=F.floor(F.col("falling") / 1000))
    return o.select("customer_id", "order_name", "rank_by_value",
                    (F.col("order_sequence") - F.col("rank_by_value")).alias("drift"))


@q("window_moving_avg")
def window_moving_avg(t: Tables) -> DataFrame:
    o = B.customer_orders(t, with_geo=True)
    monthly = o.groupBy("shipping_city", F.date_trunc("month", "order_date").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return monthly.select("shipping_city", "month", "n_orders",
                          moving_average("n_orders", ["shipping_city"], ["month"], 3, 2).alias("avg_l3m"))


@q("order_by")
def order_by(t: Tables) -> DataFrame:
    agg = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return agg.orderBy("l_returnflag", "l_linestatus")


# --- set operations ------------------------------------------------------------
@q("union_all")
def union_all(t: Tables) -> DataFrame:
    """Finished orders first, then all others, whatever their status."""
    o = t.orders.select("o_orderkey", "o_orderstatus")
    finished = F.col("o_orderstatus").eqNullSafe("F")
    return union_all_by_name([o.where(finished), o.where(~finished)])


@q("union_variants")
def union_variants(t: Tables) -> DataFrame:
    return P.name_variants(B.influencers(t), B.content_posted(t))


# --- scalar functions ----------------------------------------------------------
@q("fn_case_fold")
def fn_case_fold(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.lower("c_name").alias("lower_name"), F.upper("c_mktsegment").alias("seg"))


@q("fn_left")
def fn_left(t: Tables) -> DataFrame:
    return B.purchase_orders(t).select("purchaseorder_id", left_chars("date_created", 4).alias("y"),
                                       left_chars("date_created", 7).alias("ym"))


@q("fn_concat")
def fn_concat(t: Tables) -> DataFrame:
    """NULL in, NULL out (the original's concat)."""
    maybe = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return t.part.select("p_partkey", F.concat(F.col("p_name"), F.lit(" - "), maybe).alias("label"))


@q("fn_replace")
def fn_replace(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", strip_spaces("p_name").alias("squeezed"))


@q("fn_length")
def fn_length(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length("text").alias("n_chars_text"))


@q("fn_contains")
def fn_contains(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.contains(F.col("html"), F.lit("@")).alias("has_at"))


@q("fn_regexp_first")
def fn_regexp_first(t: Tables) -> DataFrame:
    return B.organic_social_content(t).select("content_id", regexp_nth(F.lower("caption"), MENTION, 1).alias("m1"))


@q("fn_regexp_nth")
def fn_regexp_nth(t: Tables) -> DataFrame:
    c = F.lower("caption")
    return B.organic_social_content(t).select("content_id", *[regexp_nth(c, MENTION, n).alias(f"m{n}") for n in (2, 5, 9)])


@q("fn_regexp_delete")
def fn_regexp_delete(t: Tables) -> DataFrame:
    return B.organic_social_content(t).select("content_id", regexp_delete("caption", "@").alias("no_at"))


@q("fn_array_join")
def fn_array_join(t: Tables) -> DataFrame:
    return B.sessions_master(t).select("visit_key", F.array_join("all_subdomains", " , ").alias("subdomains"))


@q("fn_datediff_day")
def fn_datediff_day(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", days_between("o_orderdate", "l_shipdate").alias("days_to_ship"))


@q("fn_datediff_month")
def fn_datediff_month(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", month_boundaries("o_orderdate", "l_shipdate").alias("months_to_ship"))


@q("fn_current_date")
def fn_current_date(t: Tables) -> DataFrame:
    """Days from each order to the as-of date that stands for current_date()."""
    return t.orders.select("o_orderkey", days_between(_odate(), F.current_date()).alias("age_days"))


@q("fn_date_literal")
def fn_date_literal(t: Tables) -> DataFrame:
    return t.orders.where(_odate() > date_lit("2000-12-31")).select("o_orderkey")


@q("fn_arithmetic")
def fn_arithmetic(t: Tables) -> DataFrame:
    li = t.lineitem
    price, disc = money("l_extendedprice"), F.col("l_discount").cast("decimal(18,2)")
    return li.select("l_orderkey", "l_linenumber",
                     (price * (F.lit(1) - disc)).cast("decimal(38,4)").alias("net"),
                     (price + price - price).cast("decimal(38,2)").alias("same"),
                     F.round(ratio(price, F.col("l_quantity").cast("decimal(18,0)")), 2).cast("decimal(38,2)").alias("unit_price"))


@q("fn_round")
def fn_round(t: Tables) -> DataFrame:
    p = money("o_totalprice")
    return t.orders.select("o_orderkey", F.round(p).cast("decimal(38,0)").alias("r0"),
                           F.round(p, -3).cast("decimal(38,0)").alias("r_thousands"))


@q("fn_null_handling")
def fn_null_handling(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax_or_null"),
                     F.ifnull(F.nullif(F.col("l_discount"), F.lit(0.0)), F.lit(-1.0)).alias("disc_or_minus"),
                     F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("none")).alias("flag"))


@q("fn_case_coalesce")
def fn_case_coalesce(t: Tables) -> DataFrame:
    s = B.halo_sessions_source(t)
    x = F.when(F.col("customer_id").isNull(), F.col("visitor_id")).otherwise(F.col("customer_id").cast("string"))
    return s.select("visit_key", x.alias("visitor"))


@q("fn_earlier_date")
def fn_earlier_date(t: Tables) -> DataFrame:
    return B.journey_orders(t).select("wix_order_name", earlier_of("order_date", "order_date_nam").alias("order_date_local"))
