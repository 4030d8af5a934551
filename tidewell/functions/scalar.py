"""Scalar functions of the telemetry queries as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the alphabet of geohashes.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
EARTH_KM, KM_PER_LAT_DEGREE, KM_PER_LON_DEGREE = 6371.0, 111.32, 85.0


def bucket_start(ts: str | Column, length: int) -> Column:
    """Start of the bucket of `length` ms that holds an epoch-ms timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts - F.pmod(ts, F.lit(length))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 where bottom isn't positive or anything is null."""
    return F.coalesce(F.when(bottom > 0, top.cast("double") / bottom), F.lit(0.0))


def first_non_blank(*columns: Column) -> Column:
    """The first of the strings that isn't null or blank, else the empty string."""
    return F.coalesce(*(F.when(F.trim(c) != "", c) for c in columns), F.lit(""))


def geohash(lat: Column, lon: Column, precision: int = 6) -> Column:
    """Geohash of 1 to 12 characters; an error for coordinates out of range, null for nulls."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be 1 to 12")
    bits = 5 * precision
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    scaled = lambda x, low, width, n: F.least(F.floor((x - low) / width * float(1 << n)), F.lit((1 << n) - 1)).cast("long")
    x, y = scaled(lon, -180.0, 360.0, n_lon), scaled(lat, -90.0, 180.0, n_lat)
    out = []
    for k in range(precision):
        value = F.lit(0).cast("long")
        for j in range(5):
            i = 5 * k + j
            bit = F.shiftright(x, n_lon - 1 - i // 2) if i % 2 == 0 else F.shiftright(y, n_lat - 1 - i // 2)
            value = value * 2 + bit.bitwiseAND(1)
        out.append(F.substring(F.lit(BASE32), (value + 1).cast("int"), F.lit(1)))
    inside = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(lat.isNull() | lon.isNull(), F.lit(None)).when(inside, F.concat(*out)).otherwise(F.raise_error(F.lit("coordinates out of range")).cast("string"))


def virtual_bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 of a key by the first 32 bits of its MD5, which other engines compute alike."""
    if n <= 0:
        raise ValueError("n must be positive")
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def shifted_bucket(bucket: Column, shift: Column, n: int) -> Column:
    """(bucket xor shift) within n buckets; n must be a power of two."""
    if n <= 0 or n & (n - 1):
        raise ValueError("n must be a power of two")
    return bucket.bitwiseXOR(shift).bitwiseAND(n - 1)


def anomaly_id(scope: Column, *parts: Column, context: Column) -> Column:
    """scope:sha256 of scope, parts and the context's sha256, joined by the unit separator; the detection time is no part."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(scope, F.lit(":"), F.sha2(F.concat_ws("\x1f", scope, *text, F.sha2(context, 256)), 256))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow((lat2 - lat1) * KM_PER_LAT_DEGREE, 2) + F.pow((lon2 - lon1) * KM_PER_LON_DEGREE, 2))


def run_id(text: Column) -> Column:
    """A run id that is safe in paths; unknown-run for null or blank."""
    return F.when(F.trim(text) != "", F.regexp_replace(F.trim(text), "[^A-Za-z0-9._-]", "_")).otherwise("unknown-run")


def sink_scope(name: Column) -> Column:
    return F.when(name.endswith("connector-write"), "write").when(name.endswith("connector-commit"), "commit").when(name.endswith("sink-front"), "front").otherwise("other")


def window_label(kind: Column) -> Column:
    return F.when(kind == "MIN_1", "1m").when(kind == "MIN_5", "5m").when(kind == "MIN_15", "15m").when(kind == "HOUR_1", "1h").otherwise("")


def source_name(stage: Column) -> Column:
    """The source that a stage reads; empty for stages that are no source."""
    return F.when(stage.isin("source-chr", "source-pm", "source-cfg"), F.substring(stage, 8, 3)).otherwise("")


def latency_base(kind: Column, event_ts: Column, window_end_ts: Column, effective_ts: Column, source_ts_avg: Column) -> Column:
    """The time from which a record's latency counts: of the event, the counters' window end or the configuration; for results the mean source time, null if there is none."""
    return F.when(kind == "CHR", event_ts).when(kind == "PM", window_end_ts).when(kind == "CFG", effective_ts).otherwise(F.when(source_ts_avg > 0, source_ts_avg))


def sampled(key: Column, every: int) -> Column:
    """Whether a record is one of the one in `every` whose latency is measured; a hash of the key picks them."""
    return virtual_bucket(key.cast("string"), every) == 0


def weak_signal(rsrp: Column, threshold: float) -> Column:
    return rsrp.isNotNull() & (rsrp < threshold)


def confidence(samples: Column) -> Column:
    return F.when(samples < 30, "low").when(samples < 100, "medium").otherwise("high")


#: Statuses from best to worst.
STATUSES = ("healthy", "unknown", "warning", "critical")


def status_rank(status: Column) -> Column:
    """1 to 4; statuses not listed count as unknown."""
    at = F.array_position(F.array(*map(F.lit, STATUSES)), status)
    return F.when(at > 0, at).otherwise(2).cast("int")


def status_of(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, STATUSES)), rank)


def cohort(key: Column, share: float) -> Column:
    """Whether the key belongs to a fixed cohort of about that share; a blank key never does, a share of 1 takes all others."""
    blank = F.coalesce(F.trim(key), F.lit("")) == ""
    if share <= 0:
        return F.lit(False)
    return ~blank & (F.lit(True) if share >= 1 else virtual_bucket(key, 10_000) < round(share * 10_000))
