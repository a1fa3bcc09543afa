from creditloom.functions.scalars import (  # noqa: F401
    cap_above,
    fill_flag,
    flag,
    floor_below,
    is_fresh,
    is_infinite,
    nan_to_null,
    normal_token,
    null_when,
    parse_money,
    parse_utc,
    row_count,
    row_mean,
    safe_ratio,
    strip_upper,
    sum_or_zero,
    to_number,
)
