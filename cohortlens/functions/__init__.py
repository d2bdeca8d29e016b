"""Column -> Column helpers (B01-B03, B15, B17, B18 predicate)."""

from .scoring import (banded, flags_sum, pattern_map, recency_points, safe_ratio, saturating_ratio,
                      tier_label)
from .text import alias_map, clean_text, exclude_values_predicate, normalize_key

__all__ = [
    "alias_map", "banded", "clean_text", "exclude_values_predicate", "flags_sum", "normalize_key",
    "pattern_map", "recency_points", "safe_ratio", "saturating_ratio", "tier_label",
]
