"""Reusable DataFrame building blocks."""

from outlay.functions.columns import first_match, guarded_pct, guarded_ratio, numeric_or_null
from outlay.functions.counting import centred_day_counts, cut_counts, expand_counts, repeat_rows
from outlay.functions.dedup import keep_first
from outlay.functions.keys import dense_key
from outlay.functions.lookup import KeyRuns, key_runs, key_side, small_side, with_key
from outlay.functions.ordered import previous_values

__all__ = [
    "KeyRuns", "centred_day_counts", "cut_counts", "dense_key", "expand_counts", "first_match", "guarded_pct", "guarded_ratio",
    "keep_first", "key_runs", "key_side", "numeric_or_null", "previous_values", "repeat_rows",
    "small_side", "with_key",
]
