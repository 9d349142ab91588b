from .tables import load_table, read_raw, store_tables, stored_table, write_table
from .views import ShopViews

__all__ = ["load_table", "write_table", "read_raw", "store_tables", "stored_table", "ShopViews"]
