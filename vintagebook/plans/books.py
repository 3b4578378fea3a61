"""Gold books (orders, reviews) for one reference safra or a backfill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.book import DEFAULT_WINDOWS, book_backfill, book_for_safra
from ..operators.joins import ORDER_VALUES, order_fact_join, review_fact_join

REVIEW_VALUES: tuple[str, ...] = ("review_score",)


def book_orders(orders: DataFrame, items: DataFrame, sellers: DataFrame, customers: DataFrame,
                safra: int, regions=None, status: str | None = "DELIVERED",
                values: Sequence[str] = ORDER_VALUES,
                months: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    """(seller_id, safra, seller_region, 350 aggregates, 56 ratios) for ``safra``."""
    kw = {} if regions is None else {"regions": regions}
    from ..functions.dates import shift_safra_value
    fact = order_fact_join(orders, items, sellers, customers, status=status,
                           safra_range=(shift_safra_value(safra, -max(months)), safra), **kw)
    return book_for_safra(fact, "seller_id", "safra", safra, values, "_orders",
                          group_extra=("seller_region",), months=months)


def book_reviews(reviews: DataFrame, items: DataFrame, safra: int,
                 months: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    """(seller_id, safra, 25 aggregates of review_score, 4 ratios)."""
    from ..functions.dates import shift_safra_value
    fact = review_fact_join(reviews, items, (shift_safra_value(safra, -max(months)), safra))
    return book_for_safra(fact, "seller_id", "safra", safra, REVIEW_VALUES, "_reviews",
                          months=months)


def book_orders_backfill(orders: DataFrame, items: DataFrame, sellers: DataFrame,
                         customers: DataFrame, safras: Sequence[int], regions=None,
                         status: str | None = "DELIVERED",
                         values: Sequence[str] = ORDER_VALUES) -> DataFrame:
    from ..functions.dates import shift_safra_value
    kw = {} if regions is None else {"regions": regions}
    fact = order_fact_join(
        orders, items, sellers, customers, status=status,
        safra_range=(shift_safra_value(min(safras), -max(DEFAULT_WINDOWS)), max(safras)), **kw)
    return book_backfill(fact, "seller_id", "safra", safras, values, "_orders",
                         group_extra=("seller_region",))


def book_reviews_backfill(reviews: DataFrame, items: DataFrame, safras: Sequence[int],
                          months: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    from ..functions.dates import shift_safra_value
    fact = review_fact_join(reviews, items,
                            (shift_safra_value(min(safras), -max(months)), max(safras)))
    return book_backfill(fact, "seller_id", "safra", safras, REVIEW_VALUES, "_reviews",
                         months=months)
