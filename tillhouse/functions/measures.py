"""Money and quantities (CLN21-CLN23, MEA1-MEA5).

Rounding goes through DECIMAL: a binary double such as 1.005 has no two-digit
neighbour that all engines agree on, its decimal text has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions.text import blank


def money(c: Column, places: int = 2) -> Column:
    """CLN21: row-level rounding.

    Up to 12 integer digits are kept in a long; wider values take a wider decimal, and what even that
    cannot hold (1e32, infinity, NaN) becomes NULL instead of ending the batch.
    """
    narrow = F.round(c.try_cast("decimal(18,6)"), places).cast("double")
    return F.coalesce(narrow, F.round(c.try_cast("decimal(38,6)"), places).cast("double"))


def money_total(c: Column, places: int = 2) -> Column:
    """Rounding of aggregates, wide enough for totals of very many rows."""
    return F.round(c.cast("decimal(34,6)"), places).cast("double")


def cents(c: Column) -> Column:
    """Whole cents: integer sums are exact in whatever order rows arrive."""
    return F.rint(c * 100).cast("bigint")


def exact_sum(c: Column) -> Column:
    """Sum of an amount as DECIMAL: the same in whatever order rows arrive, and wide enough for very many rows."""
    return F.sum(c.cast("decimal(28,8)"))


def revenue_sum(name: str) -> Column:
    """An exact sum in money."""
    return money_total(exact_sum(F.col(name)))


def negative_to_null(c: Column) -> Column:
    """CLN22: also NULL when the input is NULL."""
    return F.when(c >= 0, c)


def is_refund(status: Column, reason: Column) -> Column:
    """CLN23."""
    return F.coalesce(status == "Refunded", F.lit(False)) | reason.isNotNull()


def has_promotion(code: Column) -> Column:
    """CLN23."""
    return ~blank(code)


def discount_amount(qty: Column, price: Column, pct: Column) -> Column:
    """MEA1: ``pct`` is 0-100."""
    return qty * price * (pct / 100)


def calculated_line_total(qty: Column, price: Column, pct: Column) -> Column:
    """MEA1."""
    return money(qty * price * (1 - pct / 100))


def profit_margin_pct(price: Column, cost: Column) -> Column:
    """MEA2: only for a positive price and a known, non-negative cost."""
    return F.when((price > 0) & (cost >= 0), money((price - cost) / F.nullif(price, F.lit(0.0)) * 100))


def line_total_clean(total: Column, qty: Column, price: Column, pct: Column, refund: Column) -> Column:
    """MEA3: no negative sales; a zero total is recomputed from its parts."""
    zero_by_mistake = (total == 0) & (qty > 0) & (price > 0)
    return (
        F.when((total < 0) & ~refund, F.lit(0.0))
        .when(zero_by_mistake, qty * price * (1 - pct / 100))
        .otherwise(total)
    )


def quantity_clean(qty: Column, refund: Column) -> Column:
    """MEA4: only refunds may be negative."""
    return F.when((qty < 0) & ~refund, F.abs(qty)).otherwise(qty)


def sale_amounts(qty: Column, price: Column, total: Column, discount: Column, cost: Column) -> dict[str, Column]:
    """MEA5: gross, net, cost, profit and margin of one line.

    ``total`` is already net of the discount, so ``net_amount`` takes it off
    twice.  That is the published definition of the column; it is kept.
    """
    total_cost = qty * F.coalesce(cost, F.lit(0.0))
    profit = total - total_cost
    margin = (total - qty * cost) / F.nullif(total, F.lit(0.0)) * 100
    return {
        "gross_amount": qty * price,
        "net_amount": total - discount,
        "total_cost": total_cost,
        "line_profit": profit,
        "line_profit_margin_pct": F.when((total > 0) & (cost > 0), margin),
    }
