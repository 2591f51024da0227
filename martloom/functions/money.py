"""Exact money arithmetic.

Amounts are DOUBLE at the interface and whole cents inside. Line arithmetic is BIGINT
(it stays in generated code); totals are DECIMAL so that no sum can overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prices and rates of up to four decimals count in whole steps, price * rate in 1e-8.
_STEPS = 10_000
_STEPS_PER_CENT = _STEPS * _STEPS // 100
_LARGEST_STEPS = 2**63 - _STEPS_PER_CENT


def half_up_div(num: Column, den: Column) -> Column:
    """``num / den`` rounded to a whole number, halves away from zero.

    Both sides are whole numbers and ``den`` is not negative; NULL when it is zero.
    """
    den = F.nullif(den, F.lit(0))
    size = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -size).otherwise(size)


def _steps(value: Column) -> Column:
    return F.rint(value * _STEPS).try_cast("bigint")


def _has_steps(value: Column) -> Column:
    """Whether a number has at most four decimals."""
    return F.rint(value * _STEPS) / _STEPS == value


def _own_digits(value: Column, kind: str) -> Column:
    """A number as the decimal that its shortest form shows, if ``kind`` holds all of it."""
    digits = value.try_cast(kind)
    return F.when(digits.cast("double") == value, digits)


def net_price_cents(list_price: Column, discount: Column) -> Column:
    """Discounted unit price in cents."""
    return line_cents(F.lit(1).cast("bigint"), list_price, discount)


def line_cents(quantity: Column, list_price: Column, discount: Column) -> Column:
    """Revenue of one order line in cents, rounded once at the end.

    Up to four decimals are exact as whole numbers, up to eight as decimals. A number
    with more (a third, say) is no decimal amount in the first place: it is multiplied
    as the DOUBLE it is, and its product rounded.
    """
    price, rate = _steps(list_price), _steps(1 - discount)
    steps = F.try_multiply(F.try_multiply(quantity, price), rate)
    fast = F.call_function("div", steps + _STEPS_PER_CENT // 2, F.lit(_STEPS_PER_CENT))
    # Only negative lines, and lines beyond 90 billion, whose steps do not fit a BIGINT,
    # take the slower way.
    wide_steps = quantity.cast("decimal(18,0)") * price.cast("decimal(19,0)") * rate
    whole = F.coalesce(
        F.when(steps.between(0, _LARGEST_STEPS), fast),
        half_up_div(wide_steps, F.lit(_STEPS_PER_CENT).cast("decimal(20,0)")),
    )
    # 7 + 18 + 11 digits and two carries: the product is exact in a DECIMAL.
    amount = (
        _own_digits(list_price, "decimal(18,8)")
        * (1 - _own_digits(discount, "decimal(10,8)")).cast("decimal(11,8)")
        * quantity.try_cast("decimal(7,0)")
    )
    rounded = F.round(quantity * list_price * (1 - discount), 2)
    return F.when(_has_steps(list_price) & _has_steps(discount), whole).otherwise(
        F.coalesce(
            (F.round(amount, 2) * 100).try_cast("bigint"),
            F.rint(rounded * 100).try_cast("bigint"),
        )
    )


def wide(cents: Column) -> Column:
    """BIGINT cents as DECIMAL, so that sums of them cannot overflow."""
    return cents.cast("decimal(18,0)")


def dollars(cents: Column) -> Column:
    """Cents as the DOUBLE amount shown to users."""
    return cents.cast("double") / 100


def cents_of(amount: Column) -> Column:
    """The cents behind a DOUBLE amount that was rounded to two decimals."""
    return F.rint(amount * 100).cast("decimal(28,0)")


def mean_dollars(total_cents: Column, count: Column) -> Column:
    """Average amount rounded to cents; NULL when there is nothing to divide by."""
    return dollars(half_up_div(total_cents, count.cast("decimal(20,0)")))


def ratio(num: Column, den: Column, decimals: int = 1, factor: int = 1) -> Column:
    """``factor * num / den`` rounded to ``decimals`` places, as DOUBLE."""
    shift = 10**decimals
    whole = num.cast("decimal(28,0)") * F.lit(factor * shift)
    return half_up_div(whole, den.cast("decimal(28,0)")).cast("double") / shift


def percent(part: Column, total: Column) -> Column:
    """Share in percent with one decimal."""
    return ratio(part, total, decimals=1, factor=100)
