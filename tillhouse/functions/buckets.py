"""Classification ladders (BKT1-BKT14): first match wins, NULL takes the default."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}
Rung = tuple[str, float, str]


def ladder(value: Column, rungs: Sequence[Rung], default: str) -> Column:
    """Label ``value`` by the first rung ``(operator, bound, label)`` it meets."""
    expr = None
    for op, bound, label in rungs:
        test = _OPS[op](value, F.lit(bound))
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(F.lit(default))


def labels(value: Column, groups: dict[str, Sequence[str]], default: str) -> Column:
    """Label ``value`` by the group of codes it belongs to."""
    expr = None
    for label, codes in groups.items():
        test = value.isin(*codes)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(F.lit(default))


# Bounds and labels of the ladders.
AGE_GROUPS = [
    ("<", 18, "Under 18"), ("<", 25, "18-24"), ("<", 35, "25-34"),
    ("<", 45, "35-44"), ("<", 55, "45-54"), ("<", 65, "55-64"),
]
TENURE_BY_MONTHS = [(">", 24, "Loyal (2+ years)"), (">=", 12, "Established (1-2 years)"), (">=", 1, "Recent (3-12 months)")]
TENURE_BY_DAYS = [("<", 90, "New (< 3 months)"), ("<", 365, "Recent (3-12 months)"), ("<", 730, "Established (1-2 years)")]
LTV_TIERS = [(">=", 5000, "High Value"), (">=", 2000, "Medium Value"), (">=", 500, "Low Value")]
MATURITY_BY_MONTHS = [
    ("<", 1, "New (< 1 month)"), ("<=", 3, "Recent (1-3 months)"), ("<=", 12, "Current (< 1 year)"),
    ("<=", 24, "Established (1-2 years)"), (">", 24, "Mature (2+ years)"),
]
MATURITY_BY_DAYS = [
    ("<", 30, "New (< 1 month)"), ("<", 90, "Recent (1-3 months)"), ("<", 365, "Current (< 1 year)"),
    ("<", 730, "Established (1-2 years)"), (">=", 730, "Mature (2+ years)"),
]
WEIGHTS_INCLUSIVE = [
    ("<", 1, "Light (< 1 kg)"), ("<=", 5, "Medium (1-5 kg)"),
    ("<=", 25, "Heavy (5-25 kg)"), (">", 25, "Very Heavy (25+ kg)"),
]
WEIGHTS = [
    ("<", 1, "Light (< 1 kg)"), ("<", 5, "Medium (1-5 kg)"),
    ("<", 25, "Heavy (5-25 kg)"), (">=", 25, "Very Heavy (25+ kg)"),
]
MARGINS_INCLUSIVE = [
    ("<", 10, "Low Margin (< 10%)"), ("<=", 25, "Moderate Margin (10-25%)"),
    ("<=", 50, "Good Margin (25-50%)"), (">", 50, "High Margin (50%+)"),
]
MARGINS = [
    ("<", 10, "Low Margin (< 10%)"), ("<", 25, "Moderate Margin (10-25%)"),
    ("<", 50, "Good Margin (25-50%)"), (">=", 50, "High Margin (50%+)"),
]
PRICE_TIERS = [(">=", 1000, "Premium"), (">=", 100, "Mid-Range"), (">=", 10, "Budget"), (">", 0, "Economy")]
STORE_AGES = [("<", 365, "New (< 1 year)"), ("<", 1095, "Young (1-3 years)"), ("<", 1825, "Established (3-5 years)")]
STORE_MATURITY = [("<", 1, "Brand New"), ("<", 3, "Growing"), ("<", 5, "Established"), ("<", 10, "Mature"), (">=", 10, "Legacy")]
STORE_CATEGORIES = {
    "Flagship": ["FLAGSHIP", "MAIN"],
    "Outlet": ["OUTLET", "CLEARANCE"],
    "Temporary": ["KIOSK", "POP-UP"],
    "Warehouse": ["WAREHOUSE"],
}
REGIONS = {
    "West": ["CA", "OR", "WA", "NV", "AZ"],
    "South": ["TX", "OK", "AR", "LA", "MS", "AL", "TN", "KY"],
    "Northeast": ["NY", "NJ", "PA", "CT", "MA", "VT", "NH", "ME", "RI"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
}
METRO_CITIES = [
    "New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
    "Philadelphia", "San Antonio", "San Diego", "Dallas", "San Jose",
    "Austin", "Jacksonville", "Fort Worth", "Columbus", "Charlotte",
    "San Francisco", "Indianapolis", "Seattle", "Denver", "Boston",
]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
DAY_PARTS = [
    ("<", 6, "Late Night (12-5am)"), ("<", 12, "Morning (6-11am)"), ("<", 17, "Afternoon (12-4pm)"),
    ("<", 21, "Evening (5-8pm)"), ("<", 24, "Night (9-11pm)"),
]


def age_group(age: Column) -> Column:
    """BKT1."""
    return ladder(age, AGE_GROUPS, "65+")


def tenure_by_months(months: Column) -> Column:
    """BKT2, staging form."""
    return ladder(months, TENURE_BY_MONTHS, "New (< 3 months)")


def tenure_by_days(days: Column) -> Column:
    """BKT2, the form the marts see."""
    return ladder(days, TENURE_BY_DAYS, "Loyal (2+ years)")


def ltv_tier(value: Column) -> Column:
    """BKT3, staging form: NULL counts as very low."""
    return F.when(value < 0, "Negative").otherwise(ladder(value, LTV_TIERS, "Very Low Value"))


def ltv_category(value: Column) -> Column:
    """BKT3, the form the marts see: NULL falls through to 'Negative'."""
    return ladder(value, [*LTV_TIERS, (">=", 0, "Very Low Value")], "Negative")


def maturity_by_months(months: Column) -> Column:
    """BKT4, staging form."""
    return ladder(months, MATURITY_BY_MONTHS, "Unknown")


def maturity_by_days(days: Column) -> Column:
    """BKT4."""
    return ladder(days, MATURITY_BY_DAYS, "Unknown")


def weight_category_inclusive(weight: Column) -> Column:
    """BKT5, staging form: upper bounds belong to the lower class."""
    return ladder(weight, WEIGHTS_INCLUSIVE, "Unknown")


def weight_category(weight: Column) -> Column:
    """BKT5."""
    return ladder(weight, WEIGHTS, "Unknown")


def margin_tier_inclusive(margin: Column) -> Column:
    """BKT6, staging form."""
    return ladder(margin, MARGINS_INCLUSIVE, "Unknown")


def margin_tier(margin: Column) -> Column:
    """BKT6."""
    return ladder(margin, MARGINS, "Unknown")


def price_tier(price: Column) -> Column:
    """BKT7."""
    return ladder(price, PRICE_TIERS, "Invalid")


def price_category(very_high: Column, very_low: Column) -> Column:
    """BKT7 from the two price flags."""
    return F.when(very_high == 1, "LUXURY").when(very_low == 1, "CLEARANCE").otherwise("STANDARD")


def stock_status(stock: Column) -> Column:
    """BKT8: a known stock of 50 or more is 'In Stock'."""
    known = F.when(stock == 0, "Out of Stock").otherwise(
        ladder(stock, [("<", 10, "Low Stock"), ("<", 50, "Available")], "In Stock")
    )
    return F.when(stock.isNull(), "Unknown").otherwise(known)


def stock_flags(stock: Column) -> dict[str, Column]:
    """BKT8: NULL stock is none of the three."""
    return {
        "is_available": F.coalesce(stock > 0, F.lit(False)),
        "is_out_of_stock": F.coalesce(stock == 0, F.lit(False)),
        "is_low_stock": F.coalesce((stock > 0) & (stock < 10), F.lit(False)),
    }


def store_age_category(opened: Column, days: Column, today: Column) -> Column:
    """BKT9."""
    return (
        F.when(opened.isNull(), "Unknown")
        .when(opened > today, "Not Yet Opened")
        .otherwise(ladder(days, STORE_AGES, "Mature (5+ years)"))
    )


def store_maturity_tier(years: Column) -> Column:
    """BKT9."""
    return ladder(years, STORE_MATURITY, "Unknown")


def store_category(store_type: Column) -> Column:
    """BKT10."""
    return labels(store_type, STORE_CATEGORIES, "Standard")


def region(state: Column) -> Column:
    """BKT10: from the two-letter state code."""
    return labels(state, REGIONS, "Other")


def is_metro_area(city: Column) -> Column:
    """BKT10."""
    return F.coalesce(city.isin(*METRO_CITIES), F.lit(False))


def is_fully_operational(opened: Column, phone: Column, manager: Column, today: Column) -> Column:
    """BKT11."""
    return F.coalesce(opened <= today, F.lit(False)) & phone.isNotNull() & manager.isNotNull()


def is_weekend(dow: Column) -> Column:
    """BKT12."""
    return F.coalesce(dow.isin(0, 6), F.lit(False))


def day_name(dow: Column) -> Column:
    """BKT12: NULL for an unknown day."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), dow + 1)


def time_of_day(hour: Column) -> Column:
    """BKT12."""
    return F.when(hour.isNull(), "Unknown").otherwise(ladder(hour, DAY_PARTS, "Late Night (12-5am)"))


def sale_flags(qty: Column, total: Column, pct: Column, points: Column) -> dict[str, Column]:
    """BKT13."""
    def holds(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return {
        "has_discount": holds(pct > 0),
        "is_multi_quantity": holds(qty > 1),
        "is_bulk_purchase": holds(qty >= 10),
        "is_high_value_item": holds(total > 1000),
        "earned_loyalty_points": holds(points > 0),
    }


def transaction_type(refund: Column, promotion: Column, pct: Column) -> Column:
    """BKT14: a refund outranks a promotion, a promotion outranks a discount."""
    deep = F.coalesce(pct > 25, F.lit(False))
    return (
        F.when(refund, "Refund")
        .when(promotion & deep, "Promotional Sale")
        .when(promotion, "Promotion")
        .when(deep, "Deep Discount")
        .when(pct > 0, "Discounted")
        .otherwise("Regular Sale")
    )
