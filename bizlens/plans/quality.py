"""The schema's declared constraints checked over the business views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_valid_email
from ..operators import quality as Q
from . import views as V
from .hierarchy import category_tree

# Allowed order states.
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled", "refunded")
# VARCHAR lengths.
LENGTHS = {"categories": {"name": 100},
           "customers": {"first_name": 50, "last_name": 50, "email": 255, "city": 100, "country": 100},
           "products": {"name": 200, "sku": 50}, "orders": {"status": 20}}


def constraint_report(t) -> DataFrame:
    """Every declared rule over the business views, as (rule, table, checked, violations)."""
    tree, cust, prod, orders = category_tree(t), V.customers(t), V.products(t), V.orders(t)
    items, inv, rev = V.order_items(t), V.inventory(t), V.reviews(t)
    c = F.col
    return Q.check_tables([
        Q.Declared("categories", tree, {**Q.not_null_rules(["id", "name"]), **Q.length_rules(LENGTHS["categories"])},
                      [["id"], ["name"]], [("parent_id", "categories", "id")]),
        Q.Declared("customers", cust, {
            **Q.not_null_rules(["customer_id", "first_name", "last_name", "email", "country"]),
            **Q.length_rules(LENGTHS["customers"]), "email_format": is_valid_email(c("email"))},
            [["customer_id"], ["email"]]),
        Q.Declared("products", prod, {
            **Q.not_null_rules(["product_id", "category", "name", "price", "sku", "is_active"]),
            **Q.length_rules(LENGTHS["products"]), "price > 0": c("price") > 0,
            "size is null or > 0": c("size").isNull() | (c("size") > 0)},
            [["product_id"], ["sku"]]),
        Q.Declared("orders", orders, {
            **Q.not_null_rules(["order_id", "customer_id", "status", "total_amount", "order_date"]),
            **Q.length_rules(LENGTHS["orders"]), "status in enum": c("status").isin(*ORDER_STATUSES),
            "total_amount >= 0": c("total_amount") >= 0},
            [["order_id"]], [("customer_id", "customers", "customer_id")]),
        Q.Declared("order_items", items, {
            **Q.not_null_rules(["order_id", "product_id", "quantity", "gross", "discount", "line_total"]),
            "quantity > 0": c("quantity") > 0, "gross > 0": c("gross") > 0,
            "discount between 0 and 1": c("discount").between(0, 1),
            "line_total generated": c("line_total") == V.line_total(c("gross"), c("discount")),
            "line_total generated from percent": c("line_total") == V.line_total_percent(F.lit(1), c("gross"), c("discount") * 100)},
            [["order_id", "line_no"]], [("order_id", "orders", "order_id"), ("product_id", "products", "product_id")]),
        Q.Declared("inventory", inv, {
            **Q.not_null_rules(["product_id", "quantity", "reorder_level", "reorder_quantity"]),
            "quantity >= 0": c("quantity") >= 0, "reorder_level >= 0": c("reorder_level") >= 0,
            "reorder_quantity > 0": c("reorder_quantity") > 0},
            [["product_id"]], [("product_id", "products", "product_id")]),
        Q.Declared("reviews", rev, {
            **Q.not_null_rules(["product_id", "customer_id", "rating"]), "rating between 1 and 5": c("rating").between(1, 5)},
            [["product_id", "customer_id"]], [("product_id", "products", "product_id"), ("customer_id", "customers", "customer_id")]),
    ])
