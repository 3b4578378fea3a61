"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from .dates import (DATE_FORMATS, month_index, parse_date_multi, parse_timestamp_multi,
                    safra_of, safra_shift, safra_to_date)
from .hashing import row_hash
from .logistics import delivery_metrics, price_metrics, same_group_flag, zip_distance_proxy
from .mapping import BRAZIL_STATE_REGIONS, case_map, state_to_region
from .text import normalize_text, safe_cast

__all__ = [
    "DATE_FORMATS", "parse_timestamp_multi", "parse_date_multi", "safra_of", "safra_to_date",
    "month_index", "safra_shift", "row_hash", "delivery_metrics", "price_metrics",
    "same_group_flag", "zip_distance_proxy", "BRAZIL_STATE_REGIONS", "case_map",
    "state_to_region", "normalize_text", "safe_cast",
]
