"""Thresholds and window lengths of the rules; the defaults are those of minute-level production data."""

from __future__ import annotations

from dataclasses import dataclass

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


@dataclass(frozen=True)
class Rules:
    """Lengths are in milliseconds."""

    fact_ms: int = MINUTE
    rollup_ms: int = 5 * MINUTE
    rsrp_min: float = -110.0
    sinr_min: float = -3.0
    latency_max: float = 500.0
    attach_success_min: float = 0.95
    drop_rate_max: float = 0.05
    cell_consecutive: int = 3
    cell_window_ms: int = 3 * MINUTE
    user_consecutive: int = 3
    user_window_ms: int = 10 * MINUTE
    burst_ms: int = MINUTE
    burst_failures: int = 10
    handover_buckets: int = 5
    handover_attempts: int = 20
    handover_rate: float = 0.30
    coverage_ms: int = 5 * MINUTE
    coverage_count: int = 50
    cfg_ttl_ms: int = DAY
    pm_ttl_ms: int = 10 * MINUTE
    version: str = "v1.0"


#: Sparse event tables (a user every few minutes) need longer windows.
SPARSE = Rules(fact_ms=HOUR, rollup_ms=6 * HOUR, cell_consecutive=2, cell_window_ms=12 * HOUR, user_window_ms=10 * DAY, burst_ms=DAY, burst_failures=5, handover_attempts=5, coverage_ms=DAY, coverage_count=5, cfg_ttl_ms=5 * DAY, pm_ttl_ms=DAY)
