"""Spend attribution: purchase orders attributed to an influencer and to the
month the spend relates to (read from the payment text, not the creation
date).  Attribution is a waterfall: a name found in the text first, then a
finance number owned by exactly one influencer, else a labelled gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.predicates import bucket_first_match
from mktlens.functions.scalars import left_chars
from mktlens.operators.aggregates import duplicate_keys
from mktlens.operators.joins import null_aware_anti_join, wildcard_join
from mktlens.sources import bindings as B
from mktlens.sources.bindings import SPEND_CATEGORIES
from mktlens.sources.tables import Tables

# Month and year patterns of the payment text, in the order the
# first match is taken.  They are unbounded substrings on purpose ('%dec%'
# also hits "decor", '%19%' any "19").
MONTH_PATTERNS = [
    (["%january%", "%jan %"], "01"),
    (["%february%", "%febraury%", "%feb%"], "02"),
    (["%march%", "%mar %"], "03"),
    (["%april%", "%apr %"], "04"),
    (["%may %"], "05"),
    (["%june%", "%jun %"], "06"),
    (["%july%", "%jul %"], "07"),
    (["%august%", "%aug %"], "08"),
    (["%september%", "%sep%", "%sept %"], "09"),
    (["%october%", "%oct%"], "10"),
    (["%november%", "%nov%", "%black friday%", "%bf%"], "11"),
    (["%december%", "%dec%"], "12"),
]
YEAR_PATTERNS = [
    (["%2019%", "%19%"], "2019"),
    (["%2020%"], "2020"),
    (["%2021%", "%21%"], "2021"),
    (["%2022%", "%22%"], "2022"),
    (["%2023%", "%23%"], "2023"),
    (["%2024%", "%24%"], "2024"),
    (["%2025%", "%25%"], "2025"),
    (["%2026%", "%26%"], "2026"),
]
MISSING_LABEL = "PO MISSING FROM DATABASE - "

# The output columns of the two attribution stages and of the result.
ATTRIBUTED_COLS = [
    "influencer_name", "influencer_id", "purchaseorder_id", "item_title", "payment_description",
    "finance_name", "amount_gbp", "department", "purchase_order_description", "status",
    "date_created", "shipment_received", "amount_foreign", "currency", "country", "transaction_id",
    "year_month_inferred",
]
RESULT_COLS = [
    "influencer_name", "influencer_id", "finance_name", "purchaseorder_id", "year_month_inferred",
    "date_created", "item_title", "payment_description", "amount_gbp", "status", "department",
    "purchase_order_description", "transaction_id", "shipment_received", "amount_foreign", "currency",
]


def spend_filter(pos: DataFrame, categories=SPEND_CATEGORIES) -> DataFrame:
    return pos.where(F.col("purchase_order_description").isin(categories))


def infer_year_month(df: DataFrame, text: str = "payment_description",
                     created: str = "date_created") -> DataFrame:
    """month_part, year_part from the text (first pattern wins); the year of
    ``created`` fills a missing year; ``created``'s year-month fills a
    missing month."""
    month = bucket_first_match(text, MONTH_PATTERNS)
    year = bucket_first_match(text, YEAR_PATTERNS)
    out = df.withColumn("month_part", month).withColumn("year_part", year)
    m, y = F.col("month_part"), F.col("year_part")
    out = out.withColumn(
        "year_month_concat",
        F.when(m.isNotNull() & y.isNotNull(), F.concat(y, F.lit("-"), m))
         .when(m.isNotNull() & y.isNull(), F.concat(left_chars(created, 4), F.lit("-"), m)))
    out = out.withColumn("year_month_created",
                         F.when(F.col("year_month_concat").isNull(), left_chars(created, 7)))
    return out.withColumn("year_month_inferred",
                          F.coalesce(F.col("year_month_concat"), F.col("year_month_created")))


def name_lookup(influencers: DataFrame) -> DataFrame:
    return (influencers.where(F.col("influencer_name").isNotNull())
            .select("influencer_name", "influencer_id").distinct())


def attribute_by_name(pos: DataFrame, influencers: DataFrame, wildcards: bool = False) -> DataFrame:
    """Left wildcard join of the payment text with every influencer name
    (1 text : n names)."""
    j = wildcard_join(pos, name_lookup(influencers), "payment_description", "influencer_name",
                      how="left", wildcards=wildcards, texts_repeat=True)
    return j.select(*ATTRIBUTED_COLS)


def unique_finance_numbers(influencers: DataFrame) -> DataFrame:
    """Influencers whose finance number belongs to them alone (an agency's
    shared number is dropped); ``not in`` keeps SQL's NULL rules."""
    dupes = duplicate_keys(influencers, ["finance_number"], "finance_number", op=">", threshold=1)
    kept = null_aware_anti_join(influencers, dupes, "finance_number")
    return kept.select("influencer_name", "influencer_id", "finance_number").distinct()


def account_number(finance_name: str = "finance_name", n: int | None = None) -> F.Column:
    """The account number a finance name starts with: its first ``n``
    characters, or by default everything before its first blank (numbers may
    have any length)."""
    return F.substring_index(F.col(finance_name), " ", 1) if n is None else left_chars(finance_name, n)


def attribute_by_number(unmatched: DataFrame, influencers: DataFrame, n: int | None = None) -> DataFrame:
    """Fallback for rows without a name: the account number of the finance
    name equals a unique finance number."""
    l2 = unique_finance_numbers(influencers)
    j = unmatched.drop("influencer_name", "influencer_id").join(
        l2, account_number(n=n) == F.col("finance_number"), "left")
    return j.select(*ATTRIBUTED_COLS)


def spend_attribution(pos: DataFrame, influencers: DataFrame, n: int | None = None,
                      wildcards: bool = False) -> DataFrame:
    """The waterfall in one pass over the name join: rows with a name keep
    it; rows without one take the finance-number match, which is the union of
    the two stages.  Rows with a name get a join key of their own that no
    finance number has: an agency's orders are not gathered for nothing."""
    by_name = attribute_by_name(infer_year_month(spend_filter(pos)), influencers, wildcards)
    l2 = unique_finance_numbers(influencers).select(
        F.col("influencer_name").alias("__n2"), F.col("influencer_id").alias("__id2"), "finance_number")
    unnamed = F.col("influencer_name").isNull()
    key = F.when(unnamed, account_number(n=n)).otherwise(F.concat(F.lit("named: "), F.col("purchaseorder_id").cast("string")))
    j = by_name.withColumn("__key", key)
    j = j.join(l2, unnamed & (F.col("__key") == F.col("finance_number")), "left")
    name = F.coalesce(F.col("influencer_name"), F.col("__n2"))
    out = j.select(
        F.coalesce(name, F.concat(F.lit(MISSING_LABEL), F.col("finance_name"))).alias("influencer_name"),
        F.when(F.col("influencer_name").isNotNull(), F.col("influencer_id")).otherwise(F.col("__id2")).alias("influencer_id"),
        *[c for c in RESULT_COLS if c not in ("influencer_name", "influencer_id")])
    return out


def spend_attribution_plan(t: Tables, n: int | None = None, wildcards: bool = False) -> DataFrame:
    return spend_attribution(B.purchase_orders(t), B.influencers(t), n, wildcards)
