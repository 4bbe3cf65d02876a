"""DataFrame -> DataFrame operators."""

from .dedupe import broadcast_if_bounded, distinct_rows, drop_ambiguous, first_wins
from .intervals import (attach_facts, expand_years, expand_years_open, hull_last_end,
                        latest_revision, next_known_fill, state_hull, yearly_latest)
from .keys import (entity_key, exclude_substrings, expand_codes, fill_when_null_and_in,
                   filter_by_codes, normalized_difference, override_values, upper_columns)
from .matching import (MatchPass, abbreviation_dictionary, attach_checked, dictionary_lookup,
                       match_stats, uniqueness_violations, waterfall_match)
from .quality import describe, group_counts, group_sums, null_profile, spearman
from .regions import normalize_regions, resolve_names
from .reshape import cities_standard, joint_geodata, to_long, to_wide, union_all
from .scan import average_ranks, exact_quantiles, value_ranks

__all__ = [
    "broadcast_if_bounded", "distinct_rows", "drop_ambiguous", "first_wins",
    "attach_facts", "expand_years", "expand_years_open", "hull_last_end", "latest_revision",
    "next_known_fill", "state_hull", "yearly_latest",
    "entity_key", "exclude_substrings", "expand_codes", "fill_when_null_and_in",
    "filter_by_codes", "normalized_difference", "override_values", "upper_columns",
    "MatchPass", "abbreviation_dictionary", "attach_checked", "dictionary_lookup",
    "match_stats", "uniqueness_violations", "waterfall_match",
    "describe", "group_counts", "group_sums", "null_profile", "spearman",
    "normalize_regions", "resolve_names",
    "cities_standard", "joint_geodata", "to_long", "to_wide", "union_all",
    "average_ranks", "exact_quantiles", "value_ranks",
]
