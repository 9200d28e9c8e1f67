from tabprep.functions.clean import (  # noqa: F401
    clean_age,
    clean_category,
    clean_numeric,
    epoch_to_ts,
    fill_default,
    has_error,
    normalize_label,
    parse_event_time,
    trim_to_null,
)
