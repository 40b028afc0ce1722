"""Column-expression helpers: JSON trees as ``map<string,variant>`` (F10-F14) and dates."""

from wharf.functions.dates import (  # noqa: F401
    date_time_to_ts,
    date_to_ts,
    epoch_ms_of,
    prev_day,
    proc_time,
    ts_to_date,
    ts_to_date_for_partition,
    ts_to_date_time,
)
from wharf.functions.jsonx import (  # noqa: F401
    JSON_OBJECT,
    as_object,
    as_object_array,
    drop_keys,
    drop_null_values,
    get_long,
    get_string,
    is_object,
    parse_object,
    present,
    put,
    to_json_text,
    to_variant_object,
)
