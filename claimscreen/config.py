"""Thresholds and weights of the screening run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScreenConfig:
    """The ten public settings, then the constants the rules use, as parameters."""

    outlier_zscore_threshold: float = 3.0
    outlier_iqr_multiplier: float = 1.5
    duplicate_similarity_threshold: float = 0.9
    duplicate_time_window_days: int = 30
    max_provider_patient_distance_miles: float = 500.0
    max_daily_procedures_per_provider: int = 50
    max_claims_per_patient_per_day: int = 5
    weight_rule_violation: float = 0.3
    weight_statistical_anomaly: float = 0.25
    weight_duplicate: float = 0.45

    weekend_ratio: float = 0.30
    round_ratio: float = 0.20
    clustering_min_claims: int = 100
    same_day_locations: int = 3
    provider_ratio_high: float = 2.0
    provider_ratio_low: float = 0.5
    spike_history_rows: int = 4
    spike_factor: float = 3.0
    first_digit_threshold: float = 0.15
    procedure_weight: float = 0.6
    charge_weight: float = 0.4
    # percentile_approx accuracy: 1,000,000 gives the exact discrete quantile up to about that many rows.
    quantile_accuracy: int = 1_000_000
    # Charges known to be >= 0: the procedure becomes a join key of the near-duplicate search.
    nonnegative_charges: bool = False
    # Only with this do two negative charges compare by magnitude.
    absolute_charge_similarity: bool = False
