"""Order and payment amounts, and product attributes on events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE = "decimal(12,2)"
QUANTITY = "decimal(10,0)"
DISCOUNT = "decimal(4,2)"


def amount(price: Column, quantity: Column) -> Column:
    """Price times quantity in cents, halves rounded up. Decimal, never binary."""
    return F.round(price.cast(PRICE) * quantity.cast(QUANTITY), 2)


def discounted(subtotal: Column, discount: Column) -> Column:
    """What is left of the subtotal, in cents, halves rounded up."""
    return F.round(subtotal * (F.lit(1) - discount.cast(DISCOUNT)), 2)


def price_orders(
    orders: DataFrame,
    price: str = "unit_price",
    quantity: str = "quantity",
    discount: str = "discount",
) -> DataFrame:
    """Adds ``subtotal`` and ``total_amount``."""
    with_subtotal = orders.withColumn("subtotal", amount(F.col(price), F.col(quantity)))
    return with_subtotal.withColumn(
        "total_amount", discounted(F.col("subtotal"), F.col(discount))
    )


def price_payments(payments: DataFrame, price: str, units: str) -> DataFrame:
    """Adds ``amount``."""
    return payments.withColumn("amount", amount(F.col(price), F.col(units)))


def failure_reason(status: Column, reason: Column) -> Column:
    """The reason on failed payments, NULL on all others."""
    return F.when(status == "failed", reason)


def attach_products(events: DataFrame, products: DataFrame, on: str = "product_id") -> DataFrame:
    """Every event with the attributes of its product, NULL where the product is unknown.

    Whether the catalogue is broadcast is left to Spark's own size check; a larger one is
    shuffled, and adaptive execution splits the partition of a hot product.
    """
    return events.join(products, on, "left")


def events_per_attribute(
    events: DataFrame, products: DataFrame, attribute: str, on: str = "product_id"
) -> DataFrame:
    """Event count per product attribute.

    Events are counted per product first, so a hot product is one row by the time it is
    shuffled for the join.
    """
    per_product = events.groupBy(on).agg(F.count(F.lit(1)).alias("events"))
    attached = attach_products(per_product, products.select(on, attribute), on)
    return attached.groupBy(attribute).agg(F.sum("events").alias("events"))
