"""Schemas that fixtures and tests share."""

LOG_SCHEMA = "customer_id int, item_id int, day int, event_type int, quantity int, event_seq bigint"
ITEM_SCHEMA = ("item_id int, category_id int, category_name string, brand_id int, price double, "
               "is_replenishable boolean")
