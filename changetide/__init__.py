"""Change-data-capture analytics on Spark: change streams in, queryable tables out."""

from .spec import ORDER_PRODUCTS, ORDERS, PRODUCTS, SHOP_TABLES, TableSpec

__all__ = ["ORDERS", "ORDER_PRODUCTS", "PRODUCTS", "SHOP_TABLES", "TableSpec"]
