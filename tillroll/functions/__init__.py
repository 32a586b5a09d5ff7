from tillroll.functions.coerce import blank_missing, to_moment, to_number
from tillroll.functions.measures import (
    a_number,
    clip,
    deviation_or_zero,
    evaluated_once,
    exact_money,
    money_sum,
    ratio_or_zero,
    unpivot_record,
)

__all__ = [
    "a_number",
    "blank_missing",
    "clip",
    "deviation_or_zero",
    "evaluated_once",
    "exact_money",
    "money_sum",
    "ratio_or_zero",
    "to_moment",
    "to_number",
    "unpivot_record",
]
