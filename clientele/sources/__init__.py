"""Readers for the four input tables and the adapters used by the tests."""

from clientele.sources.tables import (
    SALES_ITEM_COLUMNS,
    SALES_ORDER_COLUMNS,
    STORE_CUSTOMER_COLUMNS,
    STOREFRONT_ORDER_COLUMNS,
    read_jdbc_table,
    read_table,
    save_bucketed,
)

__all__ = [
    "SALES_ITEM_COLUMNS",
    "SALES_ORDER_COLUMNS",
    "STORE_CUSTOMER_COLUMNS",
    "STOREFRONT_ORDER_COLUMNS",
    "read_jdbc_table",
    "read_table",
    "save_bucketed",
]
