"""Thresholds of the leakage rules. Defaults are the documented business values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleParams:
    """Cut-offs used by the order formulas and the scenario rules."""

    overhead_rate: str = "0.15"
    high_discount: str = "0.50"
    late_days: int = 14
    small_refund: str = "30"
    small_refund_count: int = 3
    fee_ratio_error: str = "2.5"
    fee_ratio_high: str = "2.0"
    fee_ratio_low: str = "0.5"
    # Low < 0.40 <= Medium < 0.65 <= High < 0.80 <= Critical
    tier_medium: str = "0.40"
    tier_high: str = "0.65"
    tier_critical: str = "0.80"
    if_weight: str = "0.65"
    lof_weight: str = "0.35"
    # customer segments by lifetime value
    segment_mid: str = "1000"
    segment_high: str = "5000"
    not_received_pattern: str = r"(?i)\b(not received|never received|did not arrive|never arrived)\b"


DEFAULT_PARAMS = RuleParams()
