"""Customer value over cohort horizons (days since the first order).

One row per customer: revenue, orders, items, average order value, items
per order, net revenue and gross profit within 12 and 24 months of the first
order, plus retention flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.scalars import date_lit, days_between, ratio
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

# Horizon lengths in days (strictly fewer days than these).
HORIZONS = (("24m", 731), ("12m", 366))
RETAINED_AFTER_DAYS = 365
DEFAULT_CUTOFF = "1996-06-30"


def item_costs(items: DataFrame) -> DataFrame:
    """Cost of goods, returned revenue and returned cost per order."""
    def returned(value):
        return F.coalesce(F.sum(F.nullif(F.col(value), F.lit(0)) /
                                F.nullif(F.col("item_quantity"), F.lit(0)) * F.col("items_returned")), F.lit(0))
    return (items.groupBy("order_name", "customer_id")
            .agg(F.sum("cost_of_goods_gbp").alias("cogs"),
                 returned("item_net_rev").alias("returns"),
                 returned("cost_of_goods_gbp").alias("cost_of_goods_returns")))


def _horizon_aggs(label: str, days: int, fanned_out: bool = False) -> list:
    """With ``fanned_out`` each order stands for ``copies`` rows of the written
    join: its values count that often, and its gross profit is summed over the
    ``costed`` copies, whose cost terms add up to ``cost_terms``."""
    within = days_between("acquisition_date", "order_date") < days

    def times(value):
        return value * F.col("copies") if fanned_out else value

    if fanned_out:
        gp = F.when(F.col("costed") > 0, F.col("order_net_sales") * F.col("costed") + F.col("cost_terms"))
    else:
        gp = F.col("order_net_sales") - F.col("cogs") - F.col("returns") + F.col("cost_of_goods_returns")
    rev = F.sum(F.when(within, times(F.col("order_gross_sales")))).cast("decimal(38,2)")
    orders = F.coalesce(F.sum(F.when(within & F.col("order_name").isNotNull(), times(F.lit(1)))), F.lit(0)).cast("bigint")
    items = F.sum(F.when(within, times(F.col("item_quantity").cast("bigint")))).cast("bigint")
    return [
        rev.alias(f"total_revenue_{label}"),
        orders.alias(f"total_orders_{label}"),
        items.alias(f"total_items_{label}"),
        F.round(ratio(rev, orders), 4).cast("decimal(38,4)").alias(f"AOV_{label}"),
        F.round(ratio(items.cast("decimal(38,0)"), orders), 1).cast("decimal(38,1)").alias(f"items_per_order_{label}"),
        F.sum(F.when(within, times(F.col("order_net_sales")))).cast("decimal(38,2)").alias(f"total_order_net_revenue_{label}"),
        F.round(F.sum(F.when(within, gp)), 2).cast("decimal(38,2)").alias(f"GP1_{label}"),
    ]


def customer_value(orders: DataFrame, customers: DataFrame, cutoff: str = DEFAULT_CUTOFF,
                   horizons=HORIZONS, fanned_out: bool = False) -> DataFrame:
    """``orders`` carries customer_id, order_name, order_date,
    acquisition_date, order_gross_sales, order_net_sales, item_quantity and
    the item costs of the order; ``customers`` customer_id, infilled_gender.
    ``horizons`` lists (label, days): orders fewer than ``days`` days after
    the first count towards ``label``."""
    aggs = [a for label, days in horizons for a in _horizon_aggs(label, days, fanned_out)]
    late = days_between("acquisition_date", "order_date") > RETAINED_AFTER_DAYS
    aggs.append(F.when(F.sum(F.when(late, F.lit(1))).isNotNull(), F.lit(1)).alias("retained_customer"))
    joined = orders.join(customers, "customer_id", "left")
    out = joined.groupBy("customer_id", "infilled_gender", "acquisition_date").agg(*aggs)
    eligible = F.when(days_between("acquisition_date", date_lit(cutoff)) > RETAINED_AFTER_DAYS, F.lit(1))
    return out.withColumn("retained_eligible_customer", eligible.cast("int")) \
              .withColumn("retained_customer", F.col("retained_customer").cast("int"))


def customer_database(t: Tables) -> DataFrame:
    return B.customer_details(t).select("customer_id", F.col("customer_gender").alias("infilled_gender"))


def customer_value_metrics(t: Tables, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Item costs joined per order (customer and order), one lineitem pass."""
    orders = B.customer_orders(t, with_item_costs=True, with_sequence=False)
    return customer_value(orders, customer_database(t), cutoff)


def customer_value_metrics_literal(t: Tables, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """As written: item costs grouped per order but joined per customer, so
    each order row meets every order's costs of its customer.  The product is
    not built: the costs are summed and counted per customer first."""
    orders = B.customer_orders(t, with_sequence=False)
    terms = F.col("cost_of_goods_returns") - F.col("cogs") - F.col("returns")
    costs = (item_costs(B.items_sold(t)).groupBy("customer_id")
             .agg(F.count(F.lit(1)).alias("n_costs"), F.count(terms).alias("costed"),
                  F.sum(terms).cast("decimal(38,10)").alias("cost_terms")))
    fanned = orders.join(costs, "customer_id", "left").withColumn("copies", F.coalesce("n_costs", F.lit(1)))
    return customer_value(fanned, customer_database(t), cutoff, fanned_out=True)


def retention_flags(t: Tables, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Retained (an order more than 365 days after the first) and eligible
    (first order more than 365 days before the cut-off) per customer."""
    o = B.customer_orders(t, with_sequence=False)
    late = days_between("acquisition_date", "order_date") > RETAINED_AFTER_DAYS
    out = o.groupBy("customer_id", "acquisition_date").agg(
        F.when(F.sum(F.when(late, F.lit(1))).isNotNull(), F.lit(1)).cast("int").alias("retained_customer"))
    return out.withColumn("retained_eligible_customer",
                          F.when(days_between("acquisition_date", date_lit(cutoff)) > RETAINED_AFTER_DAYS,
                                 F.lit(1)).cast("int"))
