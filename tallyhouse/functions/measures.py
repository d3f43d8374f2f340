"""Money arithmetic, ratios, bands and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits of the discount bands and lower limits of the revenue segments.
NO_DISCOUNT_BAND = "No Discount"
DISCOUNT_BANDS = (("0.10", "Up to 10%"), ("0.20", "10-20%"))
TOP_DISCOUNT_BAND = "Over 20%"
REVENUE_SEGMENTS = ((50000, "VIP"), (20000, "High Value"), (5000, "Medium Value"))
LOWEST_SEGMENT = "Standard"


def net_revenue(price="unit_price", quantity="quantity", discount="discount") -> Column:
    """Discounted value of a line, in exact decimals so sums do not depend on row order."""
    return (
        F.col(price).cast("decimal(19,4)")
        * F.col(quantity).cast("decimal(10,0)")
        * (F.lit(1) - F.col(discount).cast("decimal(9,6)"))
    )


def money(amount: Column) -> Column:
    """A decimal amount as a double with two places."""
    return F.round(amount, 2).cast("double")


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Rounded quotient; NULL when the denominator is 0."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.round(quotient, places)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part.cast("double") * 100, whole)


def or_zero(value: Column, data_type: str) -> Column:
    return F.coalesce(value, F.lit(0)).cast(data_type)


def label(value: Column, missing: str) -> Column:
    return F.coalesce(value, F.lit(missing))


def discount_band(discount: Column) -> Column:
    bands = F.when(discount == 0, NO_DISCOUNT_BAND)
    for limit, name in DISCOUNT_BANDS:
        bands = bands.when(discount <= F.lit(limit).cast("decimal(9,6)"), name)
    return bands.otherwise(TOP_DISCOUNT_BAND)


def revenue_segment(revenue: Column) -> Column:
    segments = None
    for limit, name in REVENUE_SEGMENTS:
        reached = revenue >= limit
        segments = F.when(reached, name) if segments is None else segments.when(reached, name)
    return segments.otherwise(LOWEST_SEGMENT)
