"""Schemas of the raw tables, for sources that carry none."""

ORDERS = "order_id bigint, user_id bigint, eval_set string, order_number bigint, days_since_prior_order double"
ORDER_PRODUCTS = "order_id bigint, product_id bigint, add_to_cart_order bigint, reordered int"
ORDER_LINES = ORDERS + ", product_id bigint, add_to_cart_order bigint, reordered int"
PRODUCTS = "product_id bigint, product_name string, aisle string, department string"
REQUESTS = "body string"
