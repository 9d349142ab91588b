"""Declared table schemas of the shop data model (DDL form).

``!`` marks NOT NULL.  Money is DECIMAL(12,2) at rest and DECIMAL(18,2) in
reported sums; counts are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(18, 2)

DDL = {
    "users": "user_id BIGINT!, full_name STRING!, email STRING!, password_hash STRING!, phone STRING, "
             "is_active BOOLEAN!, is_admin BOOLEAN!, created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "categories": "category_id BIGINT!, category_name STRING!, description STRING, "
                  "created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "products": "product_id BIGINT!, category_id BIGINT!, sku STRING!, product_name STRING!, description STRING, "
                "price DECIMAL(12,2)!, stock_qty INT!, reorder_level INT!, is_active BOOLEAN!, "
                "created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "carts": "cart_id BIGINT!, user_id BIGINT!, created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "cart_items": "cart_item_id BIGINT!, cart_id BIGINT!, product_id BIGINT!, quantity INT!, "
                  "created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "orders": "order_id BIGINT!, user_id BIGINT!, order_status STRING!, total_amount DECIMAL(12,2)!, "
              "placed_at TIMESTAMP_NTZ!, cancelled_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, "
              "created_at TIMESTAMP_NTZ!, updated_at TIMESTAMP_NTZ!",
    "order_items": "order_item_id BIGINT!, order_id BIGINT!, product_id BIGINT!, quantity INT!, "
                   "unit_price DECIMAL(12,2)!, line_total DECIMAL(12,2), created_at TIMESTAMP_NTZ!",
    "inventory_audit": "audit_id BIGINT!, product_id BIGINT!, old_stock INT!, new_stock INT!, change_qty INT!, "
                       "reason STRING!, related_order_id BIGINT, changed_at TIMESTAMP_NTZ!",
    "order_audit": "audit_id BIGINT!, order_id BIGINT!, old_status STRING, new_status STRING!, note STRING, "
                   "changed_at TIMESTAMP_NTZ!",
    "user_sessions": "session_id BIGINT!, user_id BIGINT!, token_hash STRING!, expires_at TIMESTAMP_NTZ!, "
                     "revoked_at TIMESTAMP_NTZ, last_used_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ!",
    # command logs that replace procedure calls; seq is a total order
    "cart_commands": "seq BIGINT!, user_id BIGINT!, kind STRING!, product_id BIGINT, quantity INT",
    "order_commands": "seq BIGINT!, order_id BIGINT!, user_id BIGINT!",
    "order_command_lines": "order_id BIGINT!, product_id BIGINT!, quantity INT!",
    "cancel_commands": "seq BIGINT!, order_id BIGINT!, user_id BIGINT!",
    "adjustments": "seq BIGINT!, product_id BIGINT!, delta INT, reason STRING",
    "order_status_log": "seq BIGINT!, order_id BIGINT!, order_status STRING!, at TIMESTAMP_NTZ!",
    "session_events": "seq BIGINT!, session_id BIGINT!, user_id BIGINT!, kind STRING!, at TIMESTAMP_NTZ!",
    "wishlist_toggles": "seq BIGINT!, user_id BIGINT!, product_id BIGINT",
}

_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(), "DECIMAL(12,2)": MONEY, "DOUBLE": T.DoubleType(),
}


def schema(name: str) -> T.StructType:
    fields = []
    for part in DDL[name].split(", "):
        col, typ = part.split(" ", 1)
        required = typ.endswith("!")
        fields.append(T.StructField(col, _TYPES[typ.rstrip("!")], not required))
    return T.StructType(fields)


def not_null_columns(name: str) -> list[str]:
    return [f.name for f in schema(name).fields if not f.nullable]


# VARCHAR(n) limits of the declared schema.
VARCHAR_LIMITS = {
    "users": {"full_name": 120, "email": 255, "phone": 20},
    "categories": {"category_name": 120},
    "products": {"sku": 60, "product_name": 160},
    "orders": {"order_status": 20},
    "order_audit": {"old_status": 20, "new_status": 20},
    "user_sessions": {"token_hash": 128},
}

# Order status domain.
ORDER_STATUSES = ("PLACED", "CANCELLED", "COMPLETED")
