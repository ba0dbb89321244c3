"""Plan-level tests on small literal frames (edge rows of FIXTURES.md)."""

import datetime as dt
from decimal import Decimal as Dec


from mktlens.operators.windows import moving_average
from mktlens.plans import organic as O
from mktlens.plans import paid as P
from mktlens.plans import spend as S
from mktlens.plans import value as V
from mktlens.plans.journey import clean_order_sequence
from tests.conftest import rows

D = dt.date


def test_horizons_and_ratios(spark):
    first = D(2020, 1, 1)
    orders = spark.createDataFrame(
        [(1, n, first + dt.timedelta(days=d), first, Dec(10), Dec(10), 1, Dec(0), Dec(0), Dec(0))
         for n, d in [(1, 0), (2, 365), (3, 366), (4, 730), (5, 731)]] +
        [(2, 9, D(2020, 1, 1), D(2018, 1, 1), Dec(10), Dec(10), 1, Dec(0), Dec(0), Dec(0))],
        "customer_id int, order_name int, order_date date, acquisition_date date, "
        "order_gross_sales decimal(18,2), order_net_sales decimal(18,2), item_quantity int, "
        "cogs decimal(18,2), returns decimal(18,2), cost_of_goods_returns decimal(18,2)")
    cust = spark.createDataFrame([(1, "F"), (2, "M")], "customer_id int, infilled_gender string")
    out = {r.customer_id: r for r in V.customer_value(orders, cust, cutoff="2021-06-30").collect()}
    assert out[1].total_orders_12m == 2        # 0 and 365 days
    assert out[1].total_orders_24m == 4        # 0, 365, 366, 730 days
    assert out[1].retained_customer == 1
    assert out[2].total_orders_12m == 0 and out[2].AOV_12m is None   # NULL ratio, no error
    assert out[1].retained_eligible_customer == 1


def test_moving_average_rows_frame(spark):
    df = spark.createDataFrame([("e", -2, 3), ("e", -1, 6), ("e", 0, 9), ("e", 2, 12)], "ev string, m int, v int")
    out = rows(df.select("m", moving_average("v", ["ev"], ["m"], 3, 1).alias("a")))
    assert out == [(-2, 3.0), (-1, 4.5), (0, 6.0), (2, 9.0)]


def test_infer_year_month(spark):
    texts = ["Jan fee 2022", "fee jan", "Black Friday 21", "BF", "Sept 2020", "decor march 23", "decor fee 22", "misc"]
    df = spark.createDataFrame([(i, t, "2023-12-05") for i, t in enumerate(texts)],
                               "i int, payment_description string, date_created string")
    out = [r.year_month_inferred for r in S.infer_year_month(df).orderBy("i").collect()]
    assert out == ["2022-01", "2023-12", "2021-11", "2023-11", "2020-09", "2023-03", "2022-12", "2023-12"]


def test_spend_waterfall(spark):
    cols = [c for c in S.ATTRIBUTED_COLS if c not in ("influencer_name", "influencer_id", "year_month_inferred")]
    def po(i, text, fin):
        vals = {c: None for c in cols}
        vals.update(purchaseorder_id=i, payment_description=text, finance_name=fin, date_created="2023-01-02",
                    purchase_order_description=S.SPEND_CATEGORIES[0], amount_gbp=Dec(1))
        return tuple(vals[c] for c in cols)
    schema = ", ".join(f"{c} {'bigint' if c == 'purchaseorder_id' else 'decimal(18,2)' if c in ('amount_gbp', 'amount_foreign') else 'string'}" for c in cols)
    pos = spark.createDataFrame([po(1, "fee ann", "X"), po(2, "fee ann and bob", "X"),
                                 po(3, "nothing", "ACC-1 LTD"), po(4, "nothing", "ACC-2 LTD"),
                                 po(5, "nothing", "ZZZ")], schema)
    infl = spark.createDataFrame([(10, "ann", "ACC-9"), (11, "bob", "ACC-8"), (12, "cy", "ACC-1"),
                                  (13, "dee", "ACC-2"), (14, "eve", "ACC-2")],
                                 "influencer_id long, influencer_name string, finance_number string")
    out = rows(S.spend_attribution(pos, infl, n=5), "purchaseorder_id", "influencer_name")
    assert out == [(1, "ann"), (2, "ann"), (2, "bob"), (3, "cy"),
                   (4, "PO MISSING FROM DATABASE - ACC-2 LTD"), (5, "PO MISSING FROM DATABASE - ZZZ")]


def test_mentions(spark):
    caps = ["@Ann @companynameuk @bob.", " ".join(f"@h{i}" for i in range(9)), "a@b.com", "none", None, "@ann @ann"]
    df = spark.createDataFrame([(i, "p", c, dt.datetime(2024, 1, 1), D(2024, 1, 1)) for i, c in enumerate(caps)],
                               "content_id int, provider_name string, caption string, published_at timestamp_ntz, date date")
    e = {r.content_id: r for r in O.extract_mentions(df, n=7, posted_after="2023-12-31").collect()}
    assert (e[0].regex_string_1, e[0].regex_string_2, e[0].regex_string_3) == ("ann", None, "bob.")
    assert e[1].regex_string_7 == "h6"
    assert e[2].regex_string_1 == "b.com"
    assert set(e) == {0, 1, 2, 5}
    long = rows(O.extract_mentions(df, posted_after="2023-12-31"), "content_id", "slot", "mention")
    assert [r for r in long if r[0] == 0] == [(0, 1, "ann"), (0, 3, "bob.")]
    assert [r for r in long if r[0] == 1] == [(1, i + 1, f"h{i}") for i in range(9)]
    nine = spark.createDataFrame([(f"h{i}", i) for i in range(9)] + [("h8", 99)], "lookup_name string, influencer_id int")
    assert rows(O.resolve_mentions(df, nine, posted_after="2023-12-31"), "influencer_id") == [(i,) for i in [*range(9), 99]]
    lookup = spark.createDataFrame([("ann", 1), ("bob.", 2)], "lookup_name string, influencer_id int")
    assert rows(O.resolve_mentions(df, lookup, posted_after="2023-12-31"), "content_id", "influencer_id") == \
        [(0, 1), (0, 2), (5, 1), (5, 1)]


def test_name_variants_and_length(spark):
    infl = spark.createDataFrame([(1, 1, "Ann Lee"), (2, 2, "anna")], "influencer_id int, influencer_id2 int, influencer_name string")
    content = spark.createDataFrame([(1, "Ann_L")], "influencer_id2 int, social_handle string")
    v = rows(P.name_variants(infl, content), "name", "influencer_id")
    assert ("ann lee", 1) in v and ("annlee", 1) in v and ("ann_l", 1) in v
    cat = spark.createDataFrame([("anna and annas promo", D(2024, 1, 1), "meta", "c1")],
                                "campaign string, max_date date, platform string, campaign_id string")
    infl2 = spark.createDataFrame([(3, "annas")], "influencer_id int, influencer_name string")
    names = spark.createDataFrame([("anna", 2), ("annas", 3)], "name string, influencer_id int")
    m = P.match_campaigns(cat, names, infl2.unionByName(spark.createDataFrame([(2, "anna")], "influencer_id int, influencer_name string")))
    assert rows(m, "influencer_id") == [(3,)]


def test_ordered_listagg(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "a"), ("g", None)], "k string, c string")
    assert df.groupBy("k").agg(P.ordered_listagg("c").alias("s")).first().s == "aab"


def test_duplicate_order_names(spark):
    h = spark.createDataFrame([
        (1, 1, "A", dt.datetime(2024, 1, 1)), (1, 2, "A", dt.datetime(2024, 1, 2)), (1, 3, "B", dt.datetime(2024, 1, 3)),
        (2, 1, "C", dt.datetime(2024, 1, 1)), (2, 2, "D", dt.datetime(2024, 1, 2)), (2, 3, "D", dt.datetime(2024, 1, 3)),
    ], "customer_id int, order_sequence int, wix_order_name string, wix_order_stamp timestamp_ntz")
    out = rows(clean_order_sequence(h), "customer_id", "wix_order_name", "order_sequence_new")
    assert out == [(1, "B", 1), (2, "C", 1), (2, "D", 2), (2, "D", 3)]


def test_clean_sessions_null_customer_does_not_empty(spark):
    """D12: a NULL customer with a repeated order name must not empty the result."""
    from mktlens.plans.journey import clean_sessions
    s = spark.createDataFrame([(None, 7), (None, 7), (1, 8), (2, 9), (2, 9)],
                              "customer_id int, wix_order_name int")
    assert rows(clean_sessions(s), "customer_id") == [(1,)]
