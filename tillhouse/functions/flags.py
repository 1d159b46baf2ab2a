"""Quality flags, scores, keys and audit columns (FLG*, KEY*, AUD1)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.context import RunContext
from tillhouse.functions.dates import years_between
from tillhouse.functions.text import blank, phone_digits

# Fixed value: what a NULL part contributes to a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
UNKNOWN_MEMBER = "-1"


def flag(test: Column) -> Column:
    """1 if the test holds, 0 if it fails or is unknown."""
    return F.when(test, 1).otherwise(0)


def missing_flag(c: Column) -> Column:
    """FLG1."""
    return flag(blank(c.cast("string")))


def between_open(c: Column, low: float, high: float) -> Column:
    """low < c < high."""
    return (c > low) & (c < high)


def product_range_flags(price: Column, cost: Column, stock: Column, weight: Column) -> dict[str, Column]:
    """FLG2 and the cost part of FLG3 for products."""
    return {
        "negative_stock_quantity_flag": flag(stock < 0),
        "missing_stock_quantity_flag": flag(stock.isNull()),
        "zero_stock_quantity_flag": flag(stock == 0),
        "is_low_stock": flag(stock.between(1, 9)),
        "invalid_price_flag": flag(price.isNull() | (price <= 0)),
        "invalid_cost_flag": flag(cost.isNull() | (cost < 0)),
        "cost_exceeds_price_flag": flag(cost > price),
        "very_high_price_flag": flag(price > 10000),
        "very_low_price_flag": flag(between_open(price, 0, 1)),
        "missing_weight_flag": flag(weight.isNull()),
        "suspiciously_low_weight_flag": flag(between_open(weight, 0, 0.01)),
        "very_high_weight_flag": flag(weight > 1000),
    }


def sale_range_flags(
    qty: Column, price: Column, line: Column, computed: Column, total: Column, status: Column, reason: Column
) -> dict[str, Column]:
    """FLG2 and the line part of FLG3 for transactions."""
    not_refunded = (status != "Refunded") | reason.isNull()
    return {
        "line_total_discrepancy_flag": flag(F.abs(computed - line) > 100),
        "negative_quantity_flag": flag((qty < 0) & not_refunded),
        "negative_amount_flag": flag((total < 0) & not_refunded),
        "negative_line_total_flag": flag((line < 0) & not_refunded),
        "zero_total_amount_flag": flag(total.isNull() | (total == 0)),
        "zero_quantity_flag": flag(qty.isNull() | (qty == 0)),
        "high_unit_price_flag": flag(price > 10000),
        "high_total_amount_flag": flag(total > 100000),
    }


def address_mismatch(address: Column, part: Column) -> Column:
    """FLG4: 1 when the address does not contain the part; 0 when unknown."""
    return flag(~address.contains(part))


def future_flag(date: Column, today: Column) -> Column:
    """FLG5."""
    return flag(date > today)


def very_old_flag(date: Column, today: Column) -> Column:
    """FLG5: more than 20 year boundaries ago."""
    return flag(years_between(date, today) > 20)


def invalid_phone_flag(phone: Column) -> Column:
    """FLG6: fewer than 7 digits, or none."""
    return flag(blank(phone) | (F.length(phone_digits(phone)) < 7))


def phone_too_short_flag(digits: Column) -> Column:
    """FLG6: fewer than 10 characters left."""
    return flag(F.length(digits) < 10)


def quality_issues(flags: list[Column]) -> Column:
    """FLG8: how many flags are up."""
    return reduce(add, flags)


def quality_tier(issues: Column) -> Column:
    """FLG8."""
    return F.when(issues == 0, "CLEAN").when(issues <= 2, "ACCEPTABLE").otherwise("POOR")


def _none_up(*flags: Column) -> Column:
    return reduce(lambda a, b: a & b, [f == 0 for f in flags])


def address_quality(*mismatches: Column) -> Column:
    """FLG9."""
    return F.when(_none_up(*mismatches), "VALID").otherwise("INCONSISTENT")


def completeness(core: list[Column], extra: list[Column]) -> Column:
    """FLG9: COMPLETE needs core and extra fields, GOOD the core ones."""
    return F.when(_none_up(*core, *extra), "COMPLETE").when(_none_up(*core), "GOOD").otherwise("BASIC")


def data_quality_status(corrections: list[Column], gaps: list[Column], refund: Column) -> Column:
    """FLG10: corrected sales first, then incomplete rows."""
    corrected = ~_none_up(*corrections) & ~refund
    return F.when(corrected, "CORRECTED").when(~_none_up(*gaps), "INCOMPLETE").otherwise("CLEAN")


def row_hash(*cols: Column) -> Column:
    """KEY1: MD5 of the '|'-joined values; pass doubles through :func:`as_text`."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def as_text(c: Column) -> Column:
    """A double as fixed two-digit text: the same in every engine, -0.0 included."""
    return (c + F.lit(0.0)).cast("decimal(18,2)").cast("string")


def surrogate_key(*cols: Column) -> Column:
    """KEY2: MD5 of the '-'-joined values with a placeholder for NULL."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in cols]))


def packed_key(key: Column) -> Column:
    """A key for travelling: the 16 bytes that MD5 text stands for; any other text as its bytes behind more zeros than that."""
    return F.when(key.rlike("^[0-9a-f]{32}$"), F.unhex(key)).otherwise(F.concat(F.lit(bytes(17)), key.cast("binary")))


def unpacked_key(packed: Column) -> Column:
    """The text of a packed key."""
    text = F.substring(packed, F.lit(18), F.octet_length(packed)).cast("string")
    return F.when(F.octet_length(packed) == 16, F.lower(F.hex(packed))).otherwise(text)


def unknown_member_key() -> Column:
    """KEY3: the key of the unknown customer or store."""
    return F.md5(F.lit(UNKNOWN_MEMBER))


def unknown_product_key(product_id: Column) -> Column:
    """KEY3: one unknown member per unresolved product id."""
    return surrogate_key(F.lit("UNKNOWN"), product_id)


def audit_columns(ctx: RunContext, source_table: str) -> dict[str, Column]:
    """AUD1: fixed for the whole run."""
    return {
        "staging_batch_id": F.lit(ctx.batch_id),
        "_source_system": F.lit(ctx.source_system),
        "_source_table": F.lit(source_table),
    }
