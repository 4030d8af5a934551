"""Filtered top-k queries over result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT, MOST = 100, 1000


def limit_of(limit: object) -> int:
    """The asked number of rows, at most MOST; DEFAULT_LIMIT where it isn't a positive number."""
    try:
        n = int(str(limit))
    except ValueError:
        return DEFAULT_LIMIT
    return DEFAULT_LIMIT if n < 1 else min(n, MOST)


def _search(df: DataFrame, time_col: str, start_ts: int | None, end_col: str, end_ts: int | None, equal: dict[str, str | None], ties: list[str], limit: object) -> DataFrame:
    for name, value in equal.items():
        if value is not None and value != "":
            df = df.where(F.col(name) == value)
    if start_ts is not None:
        df = df.where(F.col(time_col) >= start_ts)
    if end_ts is not None:
        df = df.where(F.col(end_col) <= end_ts)
    if "dt" in df.columns and start_ts is not None:  # partitions by day of the start: prune what lies before
        df = df.where(F.col("dt") >= F.date_format(F.timestamp_millis(F.lit(start_ts)), "yyyy-MM-dd"))
    return df.orderBy(F.desc(time_col), *ties).limit(limit_of(limit))


def query_kpis(df: DataFrame, start_ts: int | None = None, end_ts: int | None = None, limit: object = None, site_id: str | None = None, cell_id: str | None = None, grid_id: str | None = None, join_quality: str | None = None) -> DataFrame:
    """KPI rows that start at or after start_ts, end by end_ts and have the given values; newest first."""
    equal = {"site_id": site_id, "cell_id": cell_id, "grid_id": grid_id, "join_quality": join_quality}
    return _search(df, "window_start_ts", start_ts, "window_end_ts", end_ts, equal, ["cell_id"], limit)


def query_anomalies(df: DataFrame, time_col: str = "detection_ts", start_ts: int | None = None, end_ts: int | None = None, limit: object = None, **equal: str | None) -> DataFrame:
    """Anomalies of a time range with the given values of entity_type, entity_id, imsi, site_id, cell_id, grid_id, severity or anomaly_type; newest first."""
    unknown = set(equal) - {"entity_type", "entity_id", "imsi", "site_id", "cell_id", "grid_id", "severity", "anomaly_type"}
    if unknown:
        raise ValueError(f"no such filter: {sorted(unknown)}")
    return _search(df, time_col, start_ts, time_col, end_ts, equal, ["anomaly_id"], limit)
