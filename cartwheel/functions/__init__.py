from .scalars import (classify_expr, line_total, movement_reason, rating_expr, stars_expr, stock_badge,
                      strip_ws, token_hash)

__all__ = ["classify_expr", "line_total", "movement_reason", "rating_expr", "stars_expr", "stock_badge",
           "strip_ws", "token_hash"]
