"""Declared schemas, keys and enumerations of the inputs and serving tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TIME = T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Inputs. On the wire the event time is called `timestamp`; sources rename it.
MARKETING_EVENTS = _struct(
    event_type=_STRING, event_id=_STRING, event_time=_TIME,
    campaign_id=_STRING, campaign_name=_STRING, channel=_STRING,
    user_id=_STRING, device_type=_STRING, impression_id=_STRING, click_id=_STRING,
    product_category=_STRING, cost=_DOUBLE, revenue=_DOUBLE,
)
CART_EVENTS = _struct(
    event_type=_STRING, event_id=_STRING, event_time=_TIME,
    session_id=_STRING, user_id=_STRING, device_type=_STRING, traffic_source=_STRING,
    product_id=_STRING, product_category=_STRING, product_price=_DOUBLE, quantity=_INT,
    cart_id=_STRING, checkout_id=_STRING, purchase_id=_STRING, revenue=_DOUBLE,
)
CAMPAIGN_SNAPSHOTS = _struct(
    campaign_id=_STRING, campaign_name=_STRING, channel=_STRING, snapshot_time=_TIME,
    spend_to_date=_DOUBLE, impressions=_LONG, clicks=_LONG, purchases=_LONG, revenue=_DOUBLE,
)
CART_SNAPSHOTS = _struct(
    device_type=_STRING, traffic_source=_STRING, snapshot_time=_TIME,
    page_views=_LONG, add_to_carts=_LONG, purchases=_LONG, revenue=_DOUBLE,
)

EVENTS = {"marketing": MARKETING_EVENTS, "cart": CART_EVENTS}
SNAPSHOTS = {"campaign": CAMPAIGN_SNAPSHOTS, "cart": CART_SNAPSHOTS}
WIRE_NAMES = {"event_time": "timestamp"}

# Serving tables.
CAMPAIGN_PERFORMANCE = _struct(
    campaign_id=_STRING, campaign_name=_STRING, channel=_STRING,
    start_date=_TIME, last_updated=_TIME, spend_to_date=_DOUBLE,
    impressions=_LONG, clicks=_LONG, unique_visitors=_LONG, purchases=_LONG, revenue=_DOUBLE,
    ctr=_DOUBLE, cpc=_DOUBLE, cost_per_acquisition=_DOUBLE, roas=_DOUBLE, roi=_DOUBLE,
    conversion_rate=_DOUBLE,
)
CART_CONVERSION_FUNNEL = _struct(
    device_type=_STRING, traffic_source=_STRING, product_category=_STRING,
    start_date=_TIME, last_updated=_TIME,
    total_page_views=_LONG, total_product_views=_LONG, total_add_to_carts=_LONG,
    total_checkout_starts=_LONG, total_purchases=_LONG, total_revenue=_DOUBLE,
    page_to_product_rate=_DOUBLE, view_to_cart_rate=_DOUBLE, cart_to_checkout_rate=_DOUBLE,
    checkout_to_purchase_rate=_DOUBLE, cart_to_purchase_rate=_DOUBLE,
    average_order_value=_DOUBLE,
)
MARKETING_CAMPAIGNS = _struct(
    campaign_id=_STRING, campaign_name=_STRING, channel=_STRING, last_updated=_TIME,
    spend_to_date=_DOUBLE, impressions=_LONG, clicks=_LONG, purchases=_LONG, revenue=_DOUBLE,
    roas=_DOUBLE, roi=_DOUBLE,
)
CART_ANALYTICS = _struct(
    device_type=_STRING, traffic_source=_STRING, last_updated=_TIME,
    page_views=_LONG, add_to_carts=_LONG, purchases=_LONG, revenue=_DOUBLE,
    cart_to_purchase_rate=_DOUBLE,
)

CAMPAIGN_KEYS = ["campaign_id", "campaign_name", "channel"]
FUNNEL_KEYS = ["device_type", "traffic_source", "product_category"]
DEVICE_SOURCE_KEYS = ["device_type", "traffic_source"]

# Table name -> (schema, distribution columns, sort columns).
SERVING_TABLES = {
    "campaign_performance": (CAMPAIGN_PERFORMANCE, ["campaign_id"], ["campaign_id"]),
    "cart_conversion_funnel": (CART_CONVERSION_FUNNEL, DEVICE_SOURCE_KEYS, FUNNEL_KEYS),
    "marketing_campaigns": (MARKETING_CAMPAIGNS, ["campaign_id"], ["campaign_id"]),
    "cart_analytics": (CART_ANALYTICS, DEVICE_SOURCE_KEYS, DEVICE_SOURCE_KEYS),
}

# Fixed values of the two domains.
CART_STAGES = ["page_view", "product_view", "add_to_cart", "checkout_start", "purchase"]
MARKETING_STAGES = ["impression", "click", "purchase"]
CAMPAIGNS = [
    # campaign_id, campaign_name, channel, budget
    ("CAMP-001", "Summer Sale Email Campaign", "Email", 75000.0),
    ("CAMP-002", "Social Media Retargeting", "Social Media", 120000.0),
    ("CAMP-003", "Google Search Campaign", "Search", 85000.0),
    ("CAMP-004", "Influencer Partnership", "Influencer", 65000.0),
    ("CAMP-005", "Display Advertising", "Display", 55000.0),
]
DEVICES = ["Mobile", "Desktop", "Tablet"]
TRAFFIC_SOURCES = ["Organic Search", "Paid Search", "Social Media", "Email", "Direct", "Referral"]
MARKETING_CATEGORIES = ["Electronics", "Clothing", "Home & Garden", "Beauty", "Sports"]
PRODUCT_CATEGORIES = ["Electronics", "Clothing", "Home & Garden", "Beauty", "Sports", "Toys"]
DEFAULT_BUDGET = 75000
