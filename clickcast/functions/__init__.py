from clickcast.functions.clicks import add_time_parts, drop_columns, prepare_clicks, show_rows
from clickcast.functions.split import hash_split, in_first_tenths, random_split

__all__ = ["add_time_parts", "drop_columns", "hash_split", "in_first_tenths", "prepare_clicks", "random_split", "show_rows"]
