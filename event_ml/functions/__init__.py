from event_ml.functions.columns import (  # noqa: F401
    array_string,
    count_at_least,
    flag_count,
    hash_u32,
    is_invalid,
    nan_to_null,
    safe_ratio,
    vector_string,
)
from event_ml.functions.prefix import ordered_prefix  # noqa: F401
