from .casts import cast_columns, lenient_cast, lenient_float, lenient_int
from .text import code_map_lookup, lower_names, month_int_to_name, month_name_to_int, strip_ws

__all__ = ["cast_columns", "lenient_cast", "lenient_float", "lenient_int", "code_map_lookup", "lower_names",
           "month_int_to_name", "month_name_to_int", "strip_ws"]
