"""Column builders: pure expressions, no plans, no Python UDFs."""

from .dates import (
    between_times,
    epoch_micros_to_ts,
    new_customer_flag,
    parse_date_time,
    resolve_range,
    schedule_to_ts,
    year_month,
)
from .numbers import (
    age_bucket,
    bucket,
    cap_duration,
    cmp_predicate,
    duration_minutes,
    round_half_even,
    rfm_score,
)
from .text import (
    blank_coalesce,
    classify_contains,
    classify_suffix,
    contact_id_clean,
    exclude_product_code,
    param_value,
    parse_json_column,
    parse_measure,
    url_segment_map,
    value_map,
)

__all__ = [
    "age_bucket", "between_times", "blank_coalesce", "bucket", "cap_duration",
    "classify_contains", "classify_suffix", "cmp_predicate", "contact_id_clean",
    "duration_minutes", "epoch_micros_to_ts", "exclude_product_code",
    "new_customer_flag", "param_value", "parse_date_time", "parse_json_column",
    "parse_measure", "resolve_range", "rfm_score", "round_half_even",
    "schedule_to_ts", "url_segment_map", "value_map", "year_month",
]
