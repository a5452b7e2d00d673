from tidemark.functions.columns import (  # noqa: F401
    WEEKDAY_NAMES,
    calendar_day_diff,
    canonical_json,
    closure_age_days,
    direction_signal,
    empty_string_array,
    first_element,
    json_array_len,
    json_key_present,
    month_start,
    sorted_list,
    try_bool,
    try_long,
    try_timestamp,
    weekday_name,
    weekday_num,
)
