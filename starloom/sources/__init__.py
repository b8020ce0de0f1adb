"""Sources and sinks: test tables, raw landing, event files, stream readers."""

from starloom.sources.driver_tables import (
    RAW_BUILDERS,
    order_events,
    raw_customer_updates,
    raw_customers,
    raw_order_items,
    raw_orders,
    raw_products,
    read,
)

__all__ = [
    "RAW_BUILDERS", "order_events", "raw_customer_updates", "raw_customers", "raw_order_items",
    "raw_orders", "raw_products", "read",
]
