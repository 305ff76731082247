"""Exact money arithmetic. Sums over decimals do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.schemas import AMOUNT, PRICE

# Tax rate (before discount) and the upper bounds of the two
# smaller order sizes.
TAX_RATE = "0.1"
SMALL_BELOW = 100
MEDIUM_BELOW = 500


def price(value: Column) -> Column:
    """A price or discount as an exact decimal, rounded half up; NULL if it cannot be one."""
    return value.try_cast(PRICE)


def unstorable(value: Column) -> Column:
    """Given, but no exact decimal: NaN, infinite or too wide."""
    return value.isNotNull() & price(value).isNull()


def storable(value: Column) -> Column:
    """Absent, or an exact decimal; the opposite of :func:`unstorable`, in one mention."""
    return price(F.coalesce(value, F.lit(0.0))).isNotNull()


#: The least double that rounds to a price above zero, and the least one too wide to store.
LEAST_DOUBLE, TOO_WIDE = 0.005, 1e14


def positive_double(value: Column) -> Column:
    """``price(value) > 0`` for a double, by its bounds and in one mention.

    The cast of a double to a decimal goes through its text, which costs a filter
    over all rows more than all its other conditions. NULL and NaN give NULL.
    """
    return F.width_bucket(value, F.lit(LEAST_DOUBLE), F.lit(TOO_WIDE), F.lit(1)) == 1


def storable_double(value: Column) -> Column:
    """:func:`storable` for a double, by its bounds; NaN is above all of them."""
    return F.abs(F.coalesce(value, F.lit(0.0))) < TOO_WIDE


def or_zero(value: Column) -> Column:
    """Zero for an absent value only; one that cannot be stored stays unknown."""
    return F.when(value.isNull(), F.lit(0).cast(PRICE)).otherwise(price(value))


def gross(unit_price: Column, quantity: Column) -> Column:
    return price(unit_price) * quantity


def tax(unit_price: Column, quantity: Column) -> Column:
    rate = F.lit(TAX_RATE).cast(T.DecimalType(1, 1))
    return (gross(unit_price, quantity) * rate).try_cast(AMOUNT)


def total(unit_price: Column, quantity: Column, discount: Column) -> Column:
    """Gross plus tax less the discount, which is an amount."""
    due = gross(unit_price, quantity) - or_zero(discount) + tax(unit_price, quantity)
    return due.try_cast(AMOUNT)


def total_after_rate(unit_price: Column, quantity: Column, discount: Column) -> Column:
    """Gross times one less the discount, which is a fraction; NULL stays NULL."""
    return F.try_multiply(
        gross(unit_price, quantity), F.lit(1).cast(PRICE) - price(discount)
    )


def margin(unit_price: Column, cost_price: Column) -> Column:
    """Share of the price left after the cost; NULL for a price of zero."""
    left = (price(unit_price) - price(cost_price)).cast("double")
    return F.try_divide(left, price(unit_price).cast("double"))


def order_size(total_amount: Column) -> Column:
    """Small, Medium or Large; an unknown amount counts as Large."""
    return (
        F.when(total_amount < SMALL_BELOW, "Small")
        .when(total_amount < MEDIUM_BELOW, "Medium")
        .otherwise("Large")
    )


def mean_of(value: Column) -> Column:
    """Average as exact sum over count, so that it does not depend on row order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Show decimals as doubles, for reports only."""
    shown = {
        field.name: F.col(f"`{field.name}`").cast("double")
        for field in df.schema.fields
        if isinstance(field.dataType, T.DecimalType)
    }
    return df.withColumns(shown) if shown else df
