from .text import (canonical_text, contains_any_ci, fixed_width_key, flatten_multi,
                   is_digits, join_area_and_type, join_name_and_type,
                   last_path_component, raw_address, similarity, strip_words)

__all__ = [
    "canonical_text", "contains_any_ci", "fixed_width_key", "flatten_multi",
    "is_digits", "join_area_and_type", "join_name_and_type",
    "last_path_component", "raw_address", "similarity", "strip_words",
]
