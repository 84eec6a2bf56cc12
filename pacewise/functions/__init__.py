"""Column expressions shared by the operators."""

from pacewise.functions.columns import (  # noqa: F401
    any_true,
    count_when,
    inclusive_days,
    is_valid_user_id,
    pace_label,
    ratio,
    seconds,
    user_bucket,
    utc_day,
    utc_hour,
)
