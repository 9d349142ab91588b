from .jobs import (cart_of, cart_updates, inventory_state, order_audit_updates, session_updates, start_cart_stream,
                   start_inventory_stream)

__all__ = ["cart_of", "cart_updates", "inventory_state", "order_audit_updates", "session_updates", "start_cart_stream",
           "start_inventory_stream"]
