from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cartpulse.functions import advice, kpis

# spend, revenue, impressions, clicks, purchases -> rounded roas, roi, conversion rate
OBSERVED = [
    (2637.98, 787.81, 610, 89, 7, 0.3, -70.1, 7.87),
    (15978.9, 3783.48, 2944, 551, 44, 0.24, -76.3, 7.99),
    (13300.77, 2918.43, 3031, 453, 35, 0.22, -78.1, 7.73),
    (1324.15, 159.44, 602, 27, 2, 0.12, -88.0, 7.41),
    (6198.29, 614.5, 2981, 91, 7, 0.1, -90.1, 7.69),
    (2023.13, 47.56, 655, 52, 1, 0.02, -97.6, 1.92),
    (17166.47, 4004.63, 3158, 594, 46, 0.23, -76.7, 7.74),
]


def test_observed_rows(spark):
    df = spark.createDataFrame(OBSERVED, "s double, r double, i long, c long, p long, "
                                         "roas double, roi double, cr double")
    rows = df.select(
        F.round(kpis.roas(F.col("r"), F.col("s")), 2).alias("a"), "roas",
        F.round(kpis.roi(F.col("r"), F.col("s")), 1).alias("b"), "roi",
        F.round(kpis.conversion_rate(F.col("p"), F.col("c")), 2).alias("c"), "cr").collect()
    for row in rows:
        assert row.a == row.roas and row.b == row.roi and row.c == row.cr


@pytest.mark.parametrize("a,b,expected", [
    (1, 2, 0.5), (0, 2, 0.0), (1, 0, None), (0, 0, None), (None, 2, None), (1, None, None)])
def test_safe_div(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    assert df.select(kpis.safe_div(F.col("a"), F.col("b"))).first()[0] == expected


def test_every_rate_is_null_on_zero(spark):
    df = spark.range(1).select(F.lit(3).alias("n"), F.lit(0).alias("z"))
    n, z = F.col("n"), F.col("z")
    ratios = [kpis.ctr, kpis.cpc, kpis.cost_per_acquisition, kpis.roas, kpis.roi,
              kpis.conversion_rate, kpis.page_to_product_rate, kpis.view_to_cart_rate,
              kpis.cart_to_checkout_rate, kpis.checkout_to_purchase_rate,
              kpis.cart_to_purchase_rate, kpis.average_order_value, kpis.budget_utilization]
    assert set(df.select(*[f(n, z).alias(str(i)) for i, f in enumerate(ratios)]).first()) == {None}


def test_bands_are_strict(spark):
    rois = [1000.01, 1000.0, 800.0, 500.0, 300.0, -5.0, None]
    df = spark.createDataFrame([(r,) for r in rois], "roi double")
    rows = df.select(
        advice.budget_recommendation(F.col("roi")).alias("label"),
        advice.potential_impact(F.col("roi"), F.lit(300.0), F.lit(100.0)).alias("impact")).collect()
    assert [r.label for r in rows] == [
        "Increase budget by 50%", "Increase budget by 30%", "Maintain budget",
        "Decrease budget by 20%", "Decrease budget by 40%", "Decrease budget by 40%",
        "Decrease budget by 40%"]
    assert [r.impact for r in rows] == [100.0, 60.0, 0.0, -40.0, -80.0, -80.0, -80.0]


def test_cart_advice(spark):
    df = spark.createDataFrame(
        [("Mobile", "Email", 60.0), ("Desktop", "Email", 60.0), ("Desktop", "Direct", 1.0),
         ("Tablet", "Direct", 25.0), (None, "Email", 5.0)], "d string, s string, r double")
    rows = df.select(
        advice.cart_recommendation(F.col("d"), F.col("s")).alias("label"),
        advice.potential_revenue_increase(F.col("d"), F.col("r"), F.lit(100), F.lit(2.0))
        .alias("gain")).collect()
    assert [r.label for r in rows] == [
        "Optimize mobile checkout experience", "Maintain high-performing experience",
        "Standard optimization", "Improve tablet cart-to-purchase rate", "Standard optimization"]
    assert [r.gain for r in rows] == [-30.0, 0.0, 0.0, 50.0, 0.0]


def test_hours_keep_wall_clock_time(spark):
    """02:31 does not exist in New York on that day, but is a valid zone-less time."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:31:15.123456' AS t")
        hour = df.select(kpis.hour_of(F.col("t")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert hour == "2024-03-10 02:00:00"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
@pytest.mark.parametrize("time", ["2024-03-10 02:31:15.123456", "2024-11-03 01:30:00", "1969-12-31 23:59:59.5",
                                  "2300-01-01 00:00:00"])
def test_instants_do_not_depend_on_the_zone(spark, zone, time):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(f"SELECT TIMESTAMP_NTZ '{time}' AS t")
        instant = kpis.utc_instant(F.col("t"))
        micros, back = df.select(F.unix_micros(instant), kpis.utc_wall_clock(
            F.date_trunc("second", instant)).cast("string")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    moment = datetime.fromisoformat(time).replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    assert micros == (moment - epoch) // timedelta(microseconds=1)
    assert back == time[:19]
