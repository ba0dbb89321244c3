"""Properties on the smallest driver folder."""

from pyspark.sql import functions as F

from mktlens.operators.joins import wildcard_join
from mktlens.plans import journey as J
from mktlens.plans import spend as S
from mktlens.sources import bindings as B
from mktlens.sources.tables import Tables
from tests.conftest import SF_SMALL, wildcard_join_nested


def test_waterfall_conserves_purchase_orders(spark):
    t = Tables(spark, SF_SMALL)
    pos = S.spend_filter(B.purchase_orders(t))
    out = S.spend_attribution(pos, B.influencers(t))
    ids_in = {r[0] for r in pos.select("purchaseorder_id").collect()}
    ids_out = {r[0] for r in out.select("purchaseorder_id").collect()}
    assert ids_in == ids_out
    assert out.where(F.col("influencer_name").isNull()).count() == 0


def test_resequencing_is_one_to_n(spark):
    t = Tables(spark, SF_SMALL)
    b = J.base_orders(t)
    per = b.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.min("order_sequence_new").alias("lo"),
                                       F.max("order_sequence_new").alias("hi"),
                                       F.count_distinct("order_sequence_new").alias("d"))
    assert per.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0


def test_blocked_wildcard_equals_nested_on_driver_text(spark):
    t = Tables(spark, SF_SMALL)
    pos = B.purchase_orders(t).select("purchaseorder_id", "payment_description")
    names = B.influencers(t).select("influencer_id", "influencer_name")
    slow = wildcard_join_nested(pos, names, "payment_description", "influencer_name", how="left") \
        .select("purchaseorder_id", "influencer_id")
    for repeat in (False, True):
        fast = wildcard_join(pos, names, "payment_description", "influencer_name", how="left", texts_repeat=repeat) \
            .select("purchaseorder_id", "influencer_id")
        assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
