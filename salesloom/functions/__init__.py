from salesloom.functions.dates import date_key, day_of, month_name, to_day
from salesloom.functions.money import line_amounts, money_exact, money_sum, round2
from salesloom.functions.nulls import clip, is_missing, n_unique, sum_or_zero
from salesloom.functions.text import currency, customer_id, short_number, thousands, year_month

__all__ = [
    "clip",
    "currency",
    "customer_id",
    "date_key",
    "day_of",
    "is_missing",
    "line_amounts",
    "money_exact",
    "money_sum",
    "month_name",
    "n_unique",
    "round2",
    "short_number",
    "sum_or_zero",
    "thousands",
    "to_day",
    "year_month",
]
