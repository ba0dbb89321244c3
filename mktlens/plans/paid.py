"""Paid ad attribution: ads whose campaign title contains an influencer's
name (as written, without blanks, or as a social handle), aggregated per
publisher, creator and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.scalars import strip_spaces
from mktlens.operators.joins import wildcard_join
from mktlens.operators.sets import union_all_by_name
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

MIN_NAME_LENGTH = 5            # names of 4 characters or fewer are ignored
CAMPAIGNS_FROM = "1996-01-01"  # bound data: ads of 1996 onwards


def name_variants(influencers: DataFrame, content: DataFrame) -> DataFrame:
    """Ways a name appears in campaign titles: lower case, lower case without
    blanks, and the social handle (lower-cased too, so mixed-case handles can
    match the lower-cased titles)."""
    lower = influencers.select(F.lower("influencer_name").alias("name"), "influencer_id").distinct()
    squeezed = influencers.select(F.lower(strip_spaces("influencer_name")).alias("name"), "influencer_id").distinct()
    handles = (content.join(influencers.select("influencer_id2", "influencer_id"), "influencer_id2", "left")
               .select(F.lower("social_handle").alias("name"), "influencer_id").distinct())
    return union_all_by_name([lower, squeezed, handles])


def campaign_catalogue(ads: DataFrame, start: str = CAMPAIGNS_FROM, as_of: str | None = None) -> DataFrame:
    """Campaigns (lower-cased) with their last date in ``[start, as_of]``
    (today unless ``as_of`` is given)."""
    end = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return (ads.where(F.col("date").between(F.lit(start).cast("date"), end))
            .groupBy(F.lower("campaign").alias("campaign"), "platform", "account_name", "campaign_id")
            .agg(F.max("date").alias("max_date"))
            .select("campaign", "max_date", "platform", "account_name", "campaign_id"))


def match_campaigns(catalogue: DataFrame, variants: DataFrame, influencers: DataFrame,
                    min_len: int = MIN_NAME_LENGTH, wildcards: bool = False) -> DataFrame:
    """Inner wildcard join of titles with the name variants long enough to
    be meaningful, plus the influencer's name; distinct rows."""
    names = variants.where(F.length("name") >= min_len).distinct()
    m = wildcard_join(catalogue, names, "campaign", "name", how="inner", wildcards=wildcards)
    m = m.join(influencers.select("influencer_id", "influencer_name"), "influencer_id", "left")
    return m.select("campaign", "max_date", "platform", "campaign_id", "influencer_id", "influencer_name").distinct()


def paid_attribution(ads: DataFrame, matches: DataFrame, influencers: DataFrame) -> DataFrame:
    """Ads joined to the influencers their campaign matched - one row per
    (ad, influencer): matches are made distinct on (campaign, influencer)
    first so platform or account repeats do not multiply spend - then
    aggregated per publisher, creator and day."""
    lookup = (matches.select("campaign", "influencer_id").distinct()
              .join(influencers.select("influencer_id", "publisher_name", "creator_number"), "influencer_id", "left")
              .select(F.col("campaign").alias("__campaign_l"), "publisher_name", "creator_number"))
    # Ads are aggregated before the join multiplies them by their influencers:
    # one row per (campaign, day, territory, channel), with map-side combine.
    daily = (ads.groupBy("campaign", F.col("date").alias("cal_date"), "territory", "channel")
             .agg(F.sum("impressions").alias("impressions"), F.sum("spend").alias("spend"),
                  F.sum("clicks").alias("clicks"), F.sum("ad_revenue").alias("ad_revenue"),
                  F.count(F.lit(1)).alias("n_rows")))
    joined = daily.join(lookup, F.lower(F.col("campaign")) == F.col("__campaign_l"), "inner")
    # One aggregation per group, without a row per distinct count: the group
    # buffers a (campaign, rows) pair per daily row, from which both the
    # concatenation (each campaign once per ad row, in order) and the distinct
    # campaigns are read; territories and channels are sets no longer than that.
    campaigns = F.transform("__pairs", lambda p: p["campaign"])
    listed = F.transform("__pairs", lambda p: F.repeat(p["campaign"], p["n_rows"].cast("int")))
    return (joined.groupBy("publisher_name", "creator_number", "cal_date")
            .agg(F.sort_array(F.collect_list(F.struct("campaign", "n_rows"))).alias("__pairs"),
                 F.size(F.collect_set("territory")).cast("bigint").alias("distinct_territory"),
                 F.size(F.collect_set("channel")).cast("bigint").alias("distinct_paid_channels"),
                 F.sum("impressions").alias("sum_impressions"),
                 F.sum("spend").cast("decimal(38,2)").alias("sum_spend"),
                 F.sum("clicks").alias("sum_clicks"),
                 F.round(F.sum("ad_revenue")).cast("decimal(38,0)").alias("sum_ad_revenue"))
            .select("publisher_name", "creator_number", "cal_date",
                    F.size(F.array_distinct(campaigns)).cast("bigint").alias("distinct_campaigns"),
                    "distinct_territory", "distinct_paid_channels", "sum_impressions", "sum_spend", "sum_clicks",
                    "sum_ad_revenue", F.array_join(listed, "").alias("agg_campaign")))


def ordered_listagg(c: str, sep: str = "") -> F.Column:
    """``listagg(c) within group (order by c)``: NULLs skipped, values kept
    with repeats, in sort order.  (Spark 4.1's ``listagg ... within group``
    fails next to ``count(distinct)`` in one aggregate, so it is spelled with
    ``collect_list``.)"""
    return F.array_join(F.sort_array(F.collect_list(F.col(c))), sep)


def matched_titles(catalogue: DataFrame, variants: DataFrame, min_len: int = MIN_NAME_LENGTH,
                   wildcards: bool = False) -> DataFrame:
    """Distinct (campaign, influencer_id) of ``match_campaigns``: a match
    depends only on the title text, so the wildcard join runs once per
    distinct title instead of once per (title, platform, account, id) row."""
    names = variants.where(F.length("name") >= min_len).distinct()
    titles = catalogue.select("campaign").distinct()
    m = wildcard_join(titles, names, "campaign", "name", how="inner", wildcards=wildcards)
    return m.select("campaign", "influencer_id").distinct()


def paid_ad_attribution(t: Tables, wildcards: bool = False) -> DataFrame:
    """``wildcards=True`` keeps the original's LIKE: a '_' in a handle
    matches any character of a title."""
    infl, ads = B.influencers(t), B.paid_social_campaigns(t)
    matches = matched_titles(campaign_catalogue(ads), name_variants(infl, B.content_posted(t)),
                             wildcards=wildcards)
    # the original orders a CREATE TABLE AS; a table has no row order, so
    # no sort is spent on it (callers sort when they display)
    return paid_attribution(ads, matches, infl)
