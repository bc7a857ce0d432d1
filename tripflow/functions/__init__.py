"""Column functions: every function takes and returns Columns and stays JVM-side."""

from .codes import encode_base_id, map_values, safe_cast, vendor_name
from .geo import haversine
from .jsons import decode_json, encode_json, project_with_default
from .keys import row_fingerprint, surrogate_key
from .numbers import safe_add, safe_divide, safe_subtract, width_bucket
from .text import empty_to_null, slugify, slugify_text
from .times import (add_interval, boundary_diff, epoch_ms_to_ts, hours_between, minutes_between,
                    month_text, parse_ts, ts_to_epoch_ms)
from .urls import url_host, url_parameter, url_path

__all__ = [
    "add_interval", "boundary_diff", "decode_json", "empty_to_null", "encode_base_id",
    "encode_json", "epoch_ms_to_ts", "haversine", "hours_between", "map_values",
    "minutes_between", "month_text", "parse_ts", "project_with_default", "row_fingerprint",
    "safe_add", "safe_cast", "safe_divide", "safe_subtract", "slugify", "slugify_text",
    "surrogate_key", "ts_to_epoch_ms", "url_host", "url_parameter", "url_path", "vendor_name",
    "width_bucket",
]
