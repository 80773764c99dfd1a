"""Settings of the cleaning and de-duplication operators."""

from __future__ import annotations

from dataclasses import dataclass

from tidegauge.schema import DEPLOYMENT_TYPES


@dataclass(frozen=True)
class CleaningRules:
    """What ``clean_enrich`` fills, clips, repairs and derives."""

    numeric_fill: float = 0.0
    lower_strings: bool = True
    clip_durations: bool = True
    clip_metrics: bool = True
    end_after_start: bool = True
    allowed_deployments: tuple[str, ...] = DEPLOYMENT_TYPES
    with_duration: bool = True
    with_spill_pressure: bool = True
    with_queue_flag: bool = True


@dataclass(frozen=True)
class DedupRules:
    """Which columns make a duplicate, and for how long a key is remembered."""

    enabled: bool = True
    keys: tuple[str, ...] = ("query_id", "arrival_timestamp")
    ttl_seconds: int = 3600

    def __post_init__(self) -> None:
        if self.ttl_seconds <= 0:
            raise ValueError("ttl_seconds must be > 0")
        if not self.keys:
            raise ValueError("keys must not be empty")
