"""Operator arguments. Every threshold is a parameter; nothing reads a global."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # The default thresholds that results must agree with.
    duplicate_window_days: int = 30
    duplicate_tolerance_pct: int = 10
    sub_threshold_amount: int = 100
    sub_threshold_window_days: int = 7
    sub_threshold_min_count: int = 3
    round_number_pct: float = 20.0
    spike_cost_pct: float = 20.0
    spike_conversion_pct: float = 5.0
    vendor_high_pct: float = 10.0
    vendor_medium_pct: float = 5.0
    vendor_low_pct: float = 2.0
    over_budget_pct: float = 10.0
    under_budget_pct: float = -10.0


DEFAULTS = Thresholds()
