"""Views of the generic ``events`` table as this library's inputs.

``events`` has event_id, ts, user_id, event_type, value and a JSON ``props``
with a number ``k``. Amounts are cut down to binary fractions so that sums are
exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse import schemas
from cartpulse.functions import kpis
from cartpulse.schemas import CAMPAIGN_KEYS, DEVICE_SOURCE_KEYS

# events.event_type -> stage; types without an entry keep their own name.
MARKETING_TYPES = {"view": "impression"}
CART_TYPES = {
    "view": "page_view", "click": "product_view", "signup": "add_to_cart",
    "error": "checkout_start",
}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values: list[str], number: Column) -> Column:
    """The value that ``number`` comes to, counting around; NULL for NULL."""
    place = F.pmod(number, F.lit(len(values))).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), place)


def _renamed(kind: Column, names: dict[str, str]) -> Column:
    renamed = F
    for old, new in names.items():
        renamed = renamed.when(kind == old, F.lit(new))
    return renamed.otherwise(kind)


def _k() -> Column:
    """The integer ``k`` of ``props``. A pattern reads the usual ``{"k": 7}`` at a
    fraction of the cost of a JSON parser, which is left with any other object."""
    usual = F.regexp_extract("props", r'^\{\s*"k"\s*:\s*(-?(?:0|[1-9][0-9]*))\s*\}$', 1)
    return F.coalesce(F.nullif(usual, F.lit("")), F.get_json_object("props", "$.k")).cast("int")


def _amount() -> Column:
    return F.floor(F.col("value") * 64).cast("double")


def marketing_events(table: DataFrame) -> DataFrame:
    """Impressions, clicks and purchases; a click and a purchase name the event
    before them as the one they follow."""
    kind = F.col("event_type")
    campaign = _k()
    previous = (F.col("event_id") - 1).cast("string")
    amount = _amount()
    return table.select(
        _renamed(kind, MARKETING_TYPES).alias("event_type"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
        _pick([c[0] for c in schemas.CAMPAIGNS], campaign).alias("campaign_id"),
        _pick([c[1] for c in schemas.CAMPAIGNS], campaign).alias("campaign_name"),
        _pick([c[2] for c in schemas.CAMPAIGNS], campaign).alias("channel"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_id"),
        _pick(schemas.DEVICES, F.col("user_id")).alias("device_type"),
        F.when(kind == "click", previous).alias("impression_id"),
        F.when(kind == "purchase", previous).alias("click_id"),
        F.when(kind == "purchase", _pick(schemas.MARKETING_CATEGORIES, F.col("event_id")))
        .alias("product_category"),
        F.when(kind == "view", amount / 1024).when(kind == "click", amount / 256).alias("cost"),
        F.when(kind == "purchase", amount / 64).alias("revenue"),
    )


def cart_events(table: DataFrame) -> DataFrame:
    """The five funnel stages; a session is one user's day, odd users are anonymous."""
    kind = F.col("event_type")
    user = F.col("user_id")
    time = F.col("ts").cast("timestamp_ntz")
    session = F.concat(F.lit("s-"), user.cast("string"), F.lit("-"), time.cast("date").cast("string"))
    category = _pick(schemas.PRODUCT_CATEGORIES, F.col("event_id"))
    product = F.concat(F.lit("p-"), F.pmod("event_id", F.lit(50)).cast("string"))
    price = _amount() / 64
    quantity = (F.pmod(_k(), F.lit(3)) + 1).cast("int")
    in_cart = kind.isin("signup", "error", "purchase")
    return table.select(
        _renamed(kind, CART_TYPES).alias("event_type"),
        F.col("event_id").cast("string").alias("event_id"),
        time.alias("event_time"),
        session.alias("session_id"),
        F.when(user % 2 == 0, F.concat(F.lit("user-"), user.cast("string"))).alias("user_id"),
        _pick(schemas.DEVICES, user).alias("device_type"),
        _pick(schemas.TRAFFIC_SOURCES, _k()).alias("traffic_source"),
        product.alias("product_id"),
        category.alias("product_category"),
        price.alias("product_price"),
        quantity.alias("quantity"),
        F.when(in_cart, F.concat(F.lit("cart-"), session)).alias("cart_id"),
        F.when(kind.isin("error", "purchase"), F.concat(F.lit("checkout-"), session))
        .alias("checkout_id"),
        F.when(kind == "purchase", F.concat(F.lit("purchase-"), session)).alias("purchase_id"),
        F.when(kind == "purchase", price * quantity).alias("revenue"),
    )


def with_short_lived_users(cart: DataFrame, days: int) -> DataFrame:
    """Users as a site sees them that forgets them after so many days: each known user
    becomes another one with every span of ``days`` calendar days."""
    span = F.floor(F.datediff(F.col("event_time").cast("date"), F.lit("1970-01-01").cast("date"))
                   / days).cast("string")
    return cart.withColumn("user_id", F.concat("user_id", F.lit("-"), span))


def _running(daily: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Daily rows turned into running totals: one snapshot per key and day.
    The window holds one row per day of a key, whatever the event volume."""
    so_far = Window.partitionBy(*keys).orderBy("snapshot_time").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        *keys, "snapshot_time", *[F.sum(c).over(so_far).alias(c) for c in counters])


def with_refunds(marketing: DataFrame, category: str = "Electronics") -> DataFrame:
    """Purchases of a category are given back a day later, so counters can shrink."""
    bought = marketing.where(
        (F.col("event_type") == "purchase") & (F.col("product_category") == category))
    return marketing.unionByName(bought.withColumns({
        "event_type": F.lit("refund"), "revenue": -F.col("revenue"),
        "event_time": F.col("event_time") + F.make_dt_interval(F.lit(1))}))


def _day() -> Column:
    return F.col("event_time").cast("date").cast("timestamp_ntz").alias("snapshot_time")


def campaign_snapshots(marketing: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    daily = marketing.groupBy(*CAMPAIGN_KEYS, _day()).agg(
        F.sum(kpis.value_when(kind.isin("impression", "click"), F.col("cost")))
        .alias("spend_to_date"),
        F.count_if(kind == "impression").alias("impressions"),
        F.count_if(kind == "click").alias("clicks"),
        (F.count_if(kind == "purchase") - F.count_if(kind == "refund")).alias("purchases"),
        F.sum(kpis.value_when(kind.isin("purchase", "refund"), F.col("revenue")))
        .alias("revenue"),
    )
    return _running(daily, CAMPAIGN_KEYS,
                    ["spend_to_date", "impressions", "clicks", "purchases", "revenue"])


def cart_snapshots(cart: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    daily = cart.groupBy(*DEVICE_SOURCE_KEYS, _day()).agg(
        F.count_if(kind == "page_view").alias("page_views"),
        F.count_if(kind == "add_to_cart").alias("add_to_carts"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.sum(kpis.value_when(kind == "purchase", F.col("revenue"))).alias("revenue"),
    )
    return _running(daily, DEVICE_SOURCE_KEYS,
                    ["page_views", "add_to_carts", "purchases", "revenue"])


def budgets(spark: SparkSession) -> DataFrame:
    """The campaign budgets as a small dimension table, whose size the planner knows."""
    rows = ", ".join(f"('{campaign}', {float(budget)}D)"
                     for campaign, _, _, budget in schemas.CAMPAIGNS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS budgets(campaign_id, budget)")
