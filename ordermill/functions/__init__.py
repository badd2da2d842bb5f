from ordermill.functions.columns import (
    calendar_date,
    ends_with_ci,
    first_option,
    full_name,
    malformed_money,
    money,
    out_of_range_money,
    parse_ts,
    product,
    status_is,
    touch,
    widen,
    with_suffix,
)

__all__ = [
    "calendar_date", "ends_with_ci", "first_option", "full_name", "malformed_money",
    "money", "out_of_range_money", "parse_ts", "product", "status_is", "touch", "widen", "with_suffix",
]
