from cartpulse import schemas
from cartpulse.functions import advice
from cartpulse.operators import insights
from cartpulse.plans.oracles import ORACLES
from oracle_check import connect

PERFORMANCE = ("campaign_id string, campaign_name string, channel string, spend_to_date double, "
               "impressions long, clicks long, purchases long, revenue double, roas double, "
               "roi double, conversion_rate double")


def performance(spark):
    return spark.createDataFrame([
        ("C1", "A", "Email", 100.0, 10, 4, 2, 1200.0, 12.0, 1100.0, 50.0),
        ("C2", "B", "Email", 300.0, 10, 4, 1, 600.0, 2.0, 100.0, 25.0),
        ("C3", "C", "Search", 50.0, 10, 0, 0, 0.0, 0.0, -100.0, None),
        ("C4", "D", None, 10.0, 10, 4, 2, 0.0, 0.0, None, 50.0),
    ], PERFORMANCE)


def test_campaign_insights(spark):
    rows = {r.campaign_id: r for r in insights.campaign_insights(performance(spark)).collect()}
    assert set(rows) == {"C1", "C2", "C3"}
    assert rows["C1"].channel_total_spend == 400.0 and rows["C1"].channel_roas == 4.5
    assert rows["C1"].budget == 75000 and rows["C2"].budget_utilization == 0.4
    assert rows["C1"].potential_impact == 550.0


def test_campaign_insights_with_budgets(spark):
    budgets = spark.createDataFrame([("C1", 1000.0)], "campaign_id string, budget double")
    rows = {r.campaign_id: r.budget
            for r in insights.campaign_insights(performance(spark), budgets).collect()}
    assert rows == {"C1": 1000.0, "C2": 75000.0, "C3": 75000.0}


def test_board_orders_by_rounded_roi_with_nulls_last(spark):
    assert [r.roi for r in insights.campaign_board(performance(spark)).collect()] == [
        1100.0, 100.0, -100.0, None]


def test_cart_insights_sorted_by_device_then_value(spark):
    rows = [("Mobile", "Email", "Toys", 10, 8, 4, 2, 1, 30.0, 12.5, 50.0),
            ("Mobile", "Direct", "Toys", 10, 8, 4, 2, 1, 90.0, 12.5, 50.0),
            ("Desktop", "Email", "Toys", 10, 8, 4, 2, 0, 0.0, None, 50.0)]
    funnel = spark.createDataFrame(rows, (
        "device_type string, traffic_source string, product_category string, "
        "total_page_views long, total_product_views long, total_add_to_carts long, "
        "total_checkout_starts long, total_purchases long, total_revenue double, "
        "cart_to_purchase_rate double, view_to_cart_rate double"))
    view = insights.cart_conversion_insights(funnel).collect()
    assert [(r.device_type, r.average_order_value) for r in view] == [
        ("Desktop", None), ("Mobile", 90.0), ("Mobile", 30.0)]
    assert view[1].potential_revenue_increase == round((0.45 - 0.125) * 4 * 90.0, 2)
    board = insights.funnel_board(funnel).collect()
    assert [r.average_order_value for r in board] == [90.0, 30.0, None]


def test_board_diff(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), (None, 5)], "k string, v int")
    after = spark.createDataFrame([("b", 7), ("c", 3), (None, 5)], "k string, v int")
    rows = {r.k: (r.status, r.v_before, r.v_after, r.v_change)
            for r in insights.board_diff(before, after, ["k"], ["v"]).collect()}
    assert rows == {"a": ("gone", 1, None, None), "b": ("kept", 2, 7, 5),
                    "c": ("new", None, 3, None), None: ("kept", 5, 5, 0)}


def test_sample_is_a_prefix(spark):
    assert [r.id for r in insights.sample_events(spark.range(100), 3, ["id"]).collect()] == [0, 1, 2]
    assert insights.sample_events(spark.range(100)).count() == 3


def test_serving_schemas():
    widths = {name: len(schema) for name, (schema, _, _) in schemas.SERVING_TABLES.items()}
    assert widths == {"campaign_performance": 17, "cart_conversion_funnel": 17,
                      "marketing_campaigns": 11, "cart_analytics": 8}


def test_every_band_of_advice_occurs_in_some_hour():
    con = connect("/root/testdata/sf0.01")
    bands = con.sql(f"""SELECT DISTINCT budget_recommendation, potential_impact IS NULL
                        FROM ({ORACLES['hourly_recommendations']})""").fetchall()
    assert {label for label, missing in bands if not missing} == {
        *[label for _, label, _ in advice.ROI_BANDS], advice.FALLBACK[0]}
