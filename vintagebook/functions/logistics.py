"""Per-row order metrics (delays, lead times, price shares, same-place flags)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delivery_metrics(purchased="order_purchase_timestamp", approved="order_approved_at",
                     carrier="order_delivered_carrier_date",
                     delivered="order_delivered_customer_date",
                     estimated="order_estimated_delivery_date") -> list[Column]:
    """Day differences between order milestones (DATE granularity)."""
    p, a, cr, d, e = (_c(x) for x in (purchased, approved, carrier, delivered, estimated))
    transport = F.datediff(d, cr)
    return [
        F.datediff(d, e).alias("dias_atraso"),
        F.when(d > e, 1).otherwise(0).alias("fl_atraso"),
        F.datediff(d, p).alias("leadtime_total"),
        F.datediff(cr, p).alias("dias_ate_envio"),
        transport.alias("dias_transporte"),
        F.datediff(a, p).alias("dias_aprovacao"),
        (F.datediff(d, p) / F.nullif(transport, F.lit(0))).alias("eficiencia_logistica"),
    ]


def price_metrics(price="price", freight="freight_value") -> list[Column]:
    """Total price (exact, same type as the inputs) and the freight share of it.

    The share is a DOUBLE quotient: it is a ratio feature, and a DECIMAL(38, 20)
    quotient would only make every later aggregate slower."""
    pr, fr = _c(price), _c(freight)
    total = pr + fr
    return [
        total.alias("total_price"),
        (fr.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))).alias("freight_percentage"),
    ]


def same_group_flag(a: str | Column, b: str | Column) -> Column:
    """1 when both sides are equal (NULL never equals), else 0."""
    return F.when(_c(a) == _c(b), 1).otherwise(0)


def zip_distance_proxy(a: str | Column, b: str | Column) -> Column:
    """|zip_a - zip_b| on zip prefixes stored as text; non-numeric -> NULL."""
    return F.abs(_c(a).try_cast("double") - _c(b).try_cast("double"))
