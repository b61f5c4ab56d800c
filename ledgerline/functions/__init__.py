from ledgerline.functions.calendar import (
    as_timestamp,
    day_name,
    day_of_week,
    hour_of,
    iso_date,
    iso_text,
    midnight,
    order_date,
)
from ledgerline.functions.money import (
    RANK_PLACES,
    growth,
    money_mean,
    money_sum,
    money_text,
)

__all__ = [
    "RANK_PLACES",
    "as_timestamp",
    "day_name",
    "day_of_week",
    "growth",
    "hour_of",
    "iso_date",
    "iso_text",
    "midnight",
    "money_mean",
    "money_sum",
    "money_text",
    "order_date",
]
