"""Budget and funnel recommendations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ROI above the bound -> (label, share of budget added or removed).
# The first bound that is exceeded wins; FALLBACK covers the rest and a NULL ROI.
ROI_BANDS = [
    (1000, "Increase budget by 50%", 0.5),
    (800, "Increase budget by 30%", 0.3),
    (500, "Maintain budget", 0.0),
    (300, "Decrease budget by 20%", -0.2),
]
FALLBACK = ("Decrease budget by 40%", -0.4)

# Cart-to-purchase rate a device should reach, and the advice per segment.
TARGET_RATES = {"Mobile": 0.45, "Tablet": 0.50}
MOBILE_ADVICE = "Optimize mobile checkout experience"
DESKTOP_EMAIL_ADVICE = "Maintain high-performing experience"
TABLET_ADVICE = "Improve tablet cart-to-purchase rate"
OTHER_ADVICE = "Standard optimization"


def _by_band(roi: Column, values: list, otherwise) -> Column:
    banded = F
    for (bound, _, _), value in zip(ROI_BANDS, values):
        banded = banded.when(roi > bound, F.lit(value))
    return banded.otherwise(F.lit(otherwise))


def budget_recommendation(roi: Column) -> Column:
    return _by_band(roi, [label for _, label, _ in ROI_BANDS], FALLBACK[0])


def budget_change(roi: Column) -> Column:
    """Share by which the ROI band raises or cuts a budget."""
    return _by_band(roi, [share for _, _, share in ROI_BANDS], FALLBACK[1])


def potential_impact(roi: Column, revenue: Column, spend: Column) -> Column:
    """Profit times the band's change of the budget."""
    return (revenue - spend) * budget_change(roi)


def cart_recommendation(device: Column, source: Column) -> Column:
    return (
        F.when(device == "Mobile", MOBILE_ADVICE)
        .when((device == "Desktop") & (source == "Email"), DESKTOP_EMAIL_ADVICE)
        .when(device == "Tablet", TABLET_ADVICE)
        .otherwise(OTHER_ADVICE)
    )


def potential_revenue_increase(device: Column, rate: Column, add_to_carts: Column,
                               order_value: Column) -> Column:
    """Revenue gained when the device reaches its target rate; negative beyond it."""
    gain = F
    for name, target in TARGET_RATES.items():
        missing = F.lit(target) - rate / F.lit(100.0)
        gain = gain.when(device == name, F.round(missing * add_to_carts * order_value, 2))
    return gain.otherwise(F.lit(0.0))
