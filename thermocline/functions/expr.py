"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
METRES_PER_DEGREE = 111_320.0
JULIAN_1950_EPOCH = -631_152_000.0  # 1950-01-01T00:00:00Z in epoch seconds
WGS84_A, WGS84_F = 6_378_137.0, 1.0 / 298.257223563


def ddmm_to_degrees(value: Column, hemisphere: Column | None = None) -> Column:
    """Degrees-and-minutes number (DDMM.MMM) to decimal degrees; S and W are negative."""
    whole = F.floor(F.abs(value) / 100)
    degrees = whole + (F.abs(value) - whole * 100) / 60.0
    signed = F.when(value < 0, -degrees).otherwise(degrees)
    if hemisphere is None:
        return signed
    return F.when(F.upper(hemisphere).isin("S", "W"), -signed).otherwise(signed)


def observation_id(glider_id: Column, iso_time: Column) -> Column:
    """First 8 bytes of SHA-256 of `id|time`, without the sign bit."""
    digest = F.substring(F.sha2(F.concat_ws("|", glider_id, iso_time), 256), 1, 16)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def iso_micros(t_s: Column) -> Column:
    """Epoch seconds to ISO text with microseconds, UTC."""
    return F.date_format(F.timestamp_micros((t_s * 1_000_000).cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def quotient(a: Column, b: Column) -> Column:
    """a / b; NULL where b is 0: one odd row must not stop a whole job."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def planar_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column, mean_lat: Column) -> Column:
    dy = (lat2 - lat1) * METRES_PER_DEGREE
    dx = (lon2 - lon1) * METRES_PER_DEGREE * F.cos(F.radians(mean_lat))
    return F.sqrt(dy * dy + dx * dx)


def geodesic_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS-84 ellipsoid (Andoyer-Lambert, error below 1e-5 of the distance
    away from antipodal points)."""
    f = WGS84_F
    b1 = F.atan((1 - f) * F.tan(F.radians(lat1)))
    b2 = F.atan((1 - f) * F.tan(F.radians(lat2)))
    half_lat = F.sin((b2 - b1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = F.least(F.lit(1.0), half_lat * half_lat + F.cos(b1) * F.cos(b2) * half_lon * half_lon)
    sigma = 2 * F.asin(F.sqrt(h))
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    s2, c2 = F.sin(sigma / 2), F.cos(sigma / 2)
    x = (sigma - F.sin(sigma)) * F.pow(F.sin(p) * F.cos(q), 2) / (c2 * c2)
    y = (sigma + F.sin(sigma)) * F.pow(F.cos(p) * F.sin(q), 2) / (s2 * s2)
    return F.when(sigma == 0, F.lit(0.0)).otherwise(WGS84_A * (sigma - f / 2 * (x + y)))


def epoch_to_julian(t_s: Column) -> Column:
    return (t_s - JULIAN_1950_EPOCH) / 86_400.0


def julian_to_epoch(days: Column) -> Column:
    return days * 86_400.0 + JULIAN_1950_EPOCH


def epoch_to_compact(t_s: Column) -> Column:
    """Epoch seconds to YYYYMMDDHHMISS text."""
    return F.date_format(F.timestamp_seconds(t_s), "yyyyMMddHHmmss")


def compact_to_epoch(text: Column) -> Column:
    """YYYYMMDDHHMISS text to epoch seconds, NULL where it is no date."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def epoch_to_iso(t_s: Column) -> Column:
    return F.date_format(F.timestamp_seconds(t_s), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def valid_iso(text: Column) -> Column:
    """The text itself if it parses as an ISO timestamp, else NULL."""
    return F.when(F.try_to_timestamp(text).isNotNull(), text)


def solar_hour(t_s: Column, mean_lon: Column) -> Column:
    """UTC hour shifted by the deployment's mean longitude (75 where it has none)."""
    hour = (t_s % 86_400) / 3600.0 + F.coalesce(mean_lon, F.lit(75.0)) / 15.0
    return F.pmod(hour, F.lit(24.0))


def is_day(hour: Column) -> Column:
    return (hour > 6) & (hour < 18)


def lerp(t: Column, t0: Column, v0: Column, t1: Column, v1: Column) -> Column:
    """Linear interpolation; an exact hit on either end returns that end's value."""
    return F.when(t == t0, v0).when(t == t1, v1).otherwise(v0 + (v1 - v0) * quotient(t - t0, t1 - t0))
