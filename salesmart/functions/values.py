"""Row-local value repairs. Every expression is safe under ANSI mode: bad text becomes NULL, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source text formats, the correction of the shipment export, and the labels of unknown members.
US_DATE = "M/d/yyyy"
ISO_DATE = "yyyy-MM-dd"
SHIPMENT_SHIFT_MONTHS = 108
UNKNOWN_KEY = -1
NO_STATE_LABEL = "N/A (International)"

MONEY = "decimal(18,2)"

# Types of line values. Their product fits into 38 digits with all its decimals, so only results are rounded.
QUANTITY, PRICE, DISCOUNT = "decimal(11,3)", "decimal(12,4)", "decimal(9,4)"
LINE_TYPES = {"quantity": QUANTITY, "unit_price": PRICE, "discount": DISCOUNT}


# Wide enough to show whether a narrower type drops digits.
_WIDEST = "decimal(38,18)"


def exactly(column: str, kind: str) -> Column:
    """The column as a decimal type, NULL where that would drop digits as well as where there is no number."""
    narrow = F.col(column).try_cast(kind)
    return F.when(F.col(column).try_cast(_WIDEST) == narrow, narrow)


def as_int(column: str) -> Column:
    """64-bit integer out of text that may carry a spreadsheet's trailing ``.0``."""
    return F.col(column).try_cast("decimal(28,6)").try_cast("bigint")


def parse_date(column: str, fmt: str = US_DATE) -> Column:
    return F.try_to_date(F.col(column).cast("string"), fmt)


def shift_months(column: Column | str, months: int = SHIPMENT_SHIFT_MONTHS) -> Column:
    """Month arithmetic, so 29 February lands on 28 February in a common year."""
    return F.add_months(column, months)


def null_to(column: str, label) -> Column:
    """NULL becomes ``label``; an empty string is a value and stays."""
    return F.coalesce(F.col(column), F.lit(label))


def foreign_key_or_unknown(column: str) -> Column:
    """A missing key becomes the unknown member. Text that is no number stays NULL, for the parse-failure rule to report."""
    return F.when(F.col(column).isNull(), F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(as_int(column))


def reassign_key(key: str, when: Column, new_key: int) -> Column:
    """Give the rows matching ``when`` another key, leave the rest alone."""
    return F.when(when, F.lit(new_key)).otherwise(F.col(key))


def days_between(later: str, earlier: str) -> Column:
    return F.date_diff(later, earlier)


def _net_price() -> Column:
    """Unrounded line amount after discount. Decimal all the way, so the sum does not depend on row order."""
    return (
        F.col("quantity").try_cast(QUANTITY)
        * F.col("unit_price").try_cast(PRICE)
        * (F.lit(1) - F.col("discount").try_cast(DISCOUNT))
    )


def _cost() -> Column:
    return F.col("quantity").try_cast(QUANTITY) * F.col("unit_cost").try_cast(PRICE)


def extended_amount() -> Column:
    return F.round(_net_price(), 2).try_cast(MONEY)


def line_cost() -> Column:
    return F.round(_cost(), 2).try_cast(MONEY)


def raw_margin() -> Column:
    """Margin before rounding; NULL when the product has no cost."""
    return _net_price() - _cost()


def margin() -> Column:
    return F.round(raw_margin(), 2).try_cast(MONEY)


def percent(part: Column, whole: Column, scale: int = 4) -> Column:
    """``part`` as a percentage of ``whole``; NULL instead of an error when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), scale)
