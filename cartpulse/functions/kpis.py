"""Marketing and funnel KPIs as column expressions.

Inputs are columns; a ratio is NULL when its denominator is 0 or NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return safe_div(part, whole) * F.lit(100.0)


def hour_of(time: Column) -> Column:
    """Start of the calendar hour, keeping the zone-less timestamp type.

    ``date_trunc`` would go through the session time zone and move hours that
    the zone skips; plain subtraction does not.
    """
    seconds = F.date_part(F.lit("SECOND"), time)
    return time - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(time), seconds)


_EPOCH = "1970-01-01"


def utc_instant(time: Column) -> Column:
    """A zone-less time read as UTC, whatever the session's zone (watermarks need instants)."""
    since = (time - F.lit(_EPOCH).cast("timestamp_ntz")).cast("interval second")
    return F.timestamp_seconds(since.cast("decimal(18,6)"))


def utc_wall_clock(instant: Column) -> Column:
    """The inverse of `utc_instant`."""
    micros = F.unix_micros(instant).cast("decimal(18,0)")
    seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds)


def value_when(condition: Column, value: Column) -> Column:
    """``value`` on matching rows (NULL values stay NULL), 0 on all others."""
    return F.when(condition, value).otherwise(F.lit(0.0))


# --- marketing -------------------------------------------------------------

def spend_to_date(impression_cost: Column, click_cost: Column) -> Column:
    return impression_cost + click_cost


def ctr(clicks: Column, impressions: Column) -> Column:
    return percent(clicks, impressions)


def cpc(click_cost: Column, clicks: Column) -> Column:
    return safe_div(click_cost, clicks)


def cost_per_acquisition(spend: Column, purchases: Column) -> Column:
    return safe_div(spend, purchases)


def roas(revenue: Column, spend: Column) -> Column:
    return safe_div(revenue, spend)


channel_roas = roas


def roi(revenue: Column, spend: Column) -> Column:
    return percent(revenue - spend, spend)


def conversion_rate(purchases: Column, clicks: Column) -> Column:
    return percent(purchases, clicks)


def budget_utilization(spend: Column, budget: Column) -> Column:
    return percent(spend, budget)


# --- cart funnel -----------------------------------------------------------

def page_to_product_rate(product_views: Column, page_views: Column) -> Column:
    return percent(product_views, page_views)


def view_to_cart_rate(add_to_carts: Column, product_views: Column) -> Column:
    return percent(add_to_carts, product_views)


def cart_to_checkout_rate(checkout_starts: Column, add_to_carts: Column) -> Column:
    return percent(checkout_starts, add_to_carts)


def checkout_to_purchase_rate(purchases: Column, checkout_starts: Column) -> Column:
    return percent(purchases, checkout_starts)


def cart_to_purchase_rate(purchases: Column, add_to_carts: Column) -> Column:
    return percent(purchases, add_to_carts)


def average_order_value(revenue: Column, purchases: Column) -> Column:
    return safe_div(revenue, purchases)
