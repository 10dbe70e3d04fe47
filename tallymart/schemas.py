"""Schemas of the entities, as DDL text for ``spark.read.schema``."""

# Column names, types and defaults of the shop's tables and feeds.
CUSTOMERS_RAW = (
    "customer_id int, name string, email string, country string, signup_date string, segment string"
)
PRODUCTS_RAW = "product_id int, product_name string, category string, price string, active int"
ORDERS_RAW = "order_id int, customer_id int, order_date string, status string"
ORDER_ITEMS_RAW = "order_item_id int, order_id int, product_id int, quantity string, unit_price string"

RAW_SHOP = {
    "customers": CUSTOMERS_RAW,
    "products": PRODUCTS_RAW,
    "orders": ORDERS_RAW,
    "order_items": ORDER_ITEMS_RAW,
}

# Columns that a cleaned table hands on to the store.
LOAD_COLUMNS = {
    "customers": ["customer_id", "name", "email", "country", "signup_date", "segment"],
    "products": ["product_id", "product_name", "category", "price", "active"],
    "orders": ["order_id", "customer_id", "order_date", "status"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"],
}

ORDERS_V3 = (
    "order_id int, user_id int, product_id string, category string, product_name string, base_price double, "
    "price string, amount double, quantity int, region string, priority string, status string, order_date string"
)

ORDER_STATUSES = ("completed", "cancelled", "returned", "pending")
DEFAULT_COUNTRY = "Unknown"
DEFAULT_CATEGORY = "Uncategorized"
