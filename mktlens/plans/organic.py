"""Organic post attribution: handles mentioned in post captions are
extracted in order, resolved to influencers, and each (post, influencer)
gets the post's best lifetime metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions.predicates import not_like_prefix
from mktlens.functions.scalars import regexp_delete
from mktlens.operators.sets import unpivot_slots
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables

# A mention is '@' followed by letters, digits, '_' or '.';
# mentions of the company's own accounts start with '@companyname'; the
# original reads seven mention slots per caption (only with ``n`` given).
MENTION_PATTERN = "@([a-zA-Z0-9_.]+)"
COMPANY_PREFIX = "@companyname"
SLOTS_AS_WRITTEN = 7
POSTED_AFTER = "1997-12-31"     # bound data: posts of 1998 onwards

POST_KEYS = ["content_id", "provider_name", "caption", "published_at"]


def handle_lookup(content: DataFrame, influencers: DataFrame) -> DataFrame:
    """(lower(handle), influencer_id), distinct."""
    return (content.join(influencers.select("influencer_id2", "influencer_id"), "influencer_id2", "left")
            .select(F.lower("social_handle").alias("lookup_name"), "influencer_id").distinct())


def mention_array(caption: str = "caption", n: int | None = None,
                  exclude_prefix: str = COMPANY_PREFIX) -> F.Column:
    """All mentions (the first ``n`` if given) of the lower-cased caption, in
    one regex pass, each stripped of '@'; a company mention keeps its slot as
    NULL."""
    raw = F.regexp_extract_all(F.lower(F.col(caption)), F.lit(MENTION_PATTERN), F.lit(0))
    raw = raw if n is None else F.slice(raw, 1, n)
    return F.transform(raw, lambda m: F.when(not_like_prefix(m, exclude_prefix), regexp_delete(m, "@")))


def post_candidates(posts: DataFrame, posted_after: str = POSTED_AFTER) -> DataFrame:
    """Posts after the cut-off whose caption has an '@', de-duplicated."""
    return (posts.where((F.col("date") > F.lit(posted_after).cast("date"))
                        & F.col("caption").contains("@") & F.col("published_at").isNotNull())
            .select(*POST_KEYS).distinct())


def extract_mentions(posts: DataFrame, n: int | None = None, posted_after: str = POSTED_AFTER) -> DataFrame:
    """One row per mention with its slot number (company mentions left out);
    with ``n`` the written form: one column for each of the first ``n`` slots,
    as ``regexp_substr(..., 1, k)`` gives them."""
    p = post_candidates(posts, posted_after).withColumn("__m", mention_array(n=n))
    if n is None:
        return unpivot_slots(p, POST_KEYS, "__m", "mention", position="slot")
    return p.select(*POST_KEYS, *[F.get(F.col("__m"), i).alias(f"regex_string_{i + 1}") for i in range(n)])


def resolve_mentions(posts: DataFrame, lookup: DataFrame, n: int | None = None,
                     posted_after: str = POSTED_AFTER) -> DataFrame:
    """One row per (post, mention that resolves to an influencer): the lookup
    per slot and the union of the slots as one explode and one join."""
    p = post_candidates(posts, posted_after).withColumn("__m", mention_array(n=n))
    slots = p.select(*POST_KEYS, F.explode(F.col("__m")).alias("lookup_name")).where(F.col("lookup_name").isNotNull())
    return (slots.join(lookup.where(F.col("influencer_id").isNotNull()), "lookup_name", "inner")
            .select(*POST_KEYS, "influencer_id"))


def organic_attribution(union_ids: DataFrame, posts: DataFrame, influencers: DataFrame) -> DataFrame:
    """Mentions joined to publishers and to each post's best metrics (per
    post and URL).  The original restricts the metrics to mentioned posts
    with an ``in`` subquery first; the left join on the post id gives the
    same rows, and skipping the filter saves a second pass of the mention
    extraction over every caption (Spark would compute ``union_ids`` twice)."""
    publishers = influencers.select("publisher_name", "influencer_id").distinct()
    best = (posts.groupBy("content_id", "post_url")
            .agg(F.max("lifetime_engagement").alias("max_lifetime_engagement"),
                 F.max("lifetime_reach").alias("max_lifetime_reach"),
                 F.max("lifetime_engagement_rate").alias("max_lifetime_engagement_rate"),
                 F.max("video_views_lifetime").alias("max_video_views_lifetime"))
            .drop("post_url"))
    return (union_ids.join(publishers, "influencer_id", "left")
            .join(best, "content_id", "left")
            .select(*POST_KEYS, "influencer_id", "publisher_name", "max_lifetime_engagement",
                    "max_lifetime_reach", "max_lifetime_engagement_rate", "max_video_views_lifetime"))


def organic_post_attribution(t: Tables) -> DataFrame:
    posts, infl = B.organic_social_content(t), B.influencers(t)
    lookup = handle_lookup(B.content_posted(t), infl)
    return organic_attribution(resolve_mentions(posts, lookup), posts, infl)


def unpivot_mention_slots(t: Tables) -> DataFrame:
    """One row per non-NULL slot of each post's mentions, with its number."""
    return extract_mentions(B.organic_social_content(t)).select("content_id", "mention", "slot")


def lookup_mention_slots(t: Tables) -> DataFrame:
    """Every mention slot with the influencers its handle belongs to: NULL
    where it resolves to none, a row each where it has several owners."""
    lookup = handle_lookup(B.content_posted(t), B.influencers(t)).withColumnRenamed("lookup_name", "mention")
    return (unpivot_mention_slots(t).join(lookup, "mention", "left")
            .select("content_id", "slot", "mention", "influencer_id"))
