"""Contracts: bronze rows, change envelopes, event topics and tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BRONZE = _struct(
    event_source=_S,
    event_time=_TS,
    schema_id=_I,
    payload_size=_I,
    json_payload=_S,
    partition=_I,
    offset=_L,
)

# What a message broker hands over for one record.
TOPIC_RECORD = _struct(
    topic=_S, partition=_I, offset=_L, timestamp=_TS, key=T.BinaryType(), value=T.BinaryType()
)

# A record that did not decode, as it came, and why.
QUARANTINE = _struct(
    partition=_I, offset=_L, timestamp=_TS, value=T.BinaryType(), decode_status=_S, topic=_S
)

# Topic names, their fields and types, and defaults of absent fields.
TOPICS: dict[str, T.StructType] = {
    "orders.v1": _struct(order_id=_S, user_id=_S, product_id=_S, amount=T.DecimalType(10, 2), currency=_S, ts=_TS),
    "payments.v1": _struct(payment_id=_S, order_id=_S, method=_S, status=_S, ts=_TS),
    "shipments.v1": _struct(shipment_id=_S, order_id=_S, carrier=_S, eta_days=_I, ts=_TS),
    "inventory-changes.v1": _struct(
        change_id=_S,
        warehouse_id=_S,
        product_id=_S,
        change_type=_S,
        quantity_delta=_I,
        previous_qty=_I,
        new_qty=_I,
        reason=_S,
        order_id=_S,
        supplier_id=_S,
        cost_per_unit=_D,
        ts=_TS,
    ),
    "customer-interactions.v1": _struct(
        interaction_id=_S,
        user_id=_S,
        session_id=_S,
        interaction_type=_S,
        product_id=_S,
        search_query=_S,
        page_url=_S,
        duration_ms=_L,
        user_agent=_S,
        ip_address=_S,
        country=_S,
        ts=_TS,
    ),
}

TOPIC_DEFAULTS: dict[str, dict[str, object]] = {
    "orders.v1": {"currency": "USD"},
    "shipments.v1": {"eta_days": 3},
}

# Allowed values of enumerated fields.
ENUMS: dict[tuple[str, str], tuple[str, ...]] = {
    ("payments.v1", "method"): ("CARD", "APPLE_PAY", "PAYPAL"),
    ("payments.v1", "status"): ("PENDING", "SETTLED", "FAILED", "UNKNOWN"),
    ("inventory-changes.v1", "change_type"): ("RESTOCK", "SALE", "DAMAGE", "RETURN", "TRANSFER", "ADJUSTMENT"),
    ("customer-interactions.v1", "interaction_type"): (
        "PAGE_VIEW",
        "SEARCH",
        "CART_ADD",
        "CART_REMOVE",
        "WISHLIST_ADD",
        "REVIEW",
        "SUPPORT_CHAT",
    ),
}

# Captured tables and their columns, key first.
CDC_TABLES: dict[str, T.StructType] = {
    "users": _struct(user_id=_S, email=_S, country=_S, created_at=_TS),
    "products": _struct(product_id=_S, title=_S, category=_S, price_usd=_D, updated_at=_TS),
    "inventory": _struct(product_id=_S, qty=_L, updated_at=_TS),
    "warehouses": _struct(warehouse_id=_S, name=_S, country=_S, region=_S),
    "suppliers": _struct(supplier_id=_S, name=_S, country=_S, rating=_D),
    "customer_segments": _struct(user_id=_S, segment=_S, lifetime_value=_D),
    "warehouse_inventory": _struct(
        warehouse_id=_S, product_id=_S, qty=_L, reserved_qty=_L, updated_at=_TS
    ),
    "product_suppliers": _struct(product_id=_S, supplier_id=_S, cost_usd=_D, lead_time_days=_I),
}
