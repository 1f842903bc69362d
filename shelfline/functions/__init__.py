from shelfline.functions.exprs import (
    as_date, count_when, date_key, day_to_key, decode, flag_yn, key_to_date, money, month_of, percent, position_in,
    quantity, ratio, sum_when,
)
from shelfline.functions.shared import over_shared

__all__ = [
    "as_date", "count_when", "date_key", "day_to_key", "decode", "flag_yn", "key_to_date", "money", "month_of",
    "over_shared", "percent", "position_in", "quantity", "ratio", "sum_when",
]
