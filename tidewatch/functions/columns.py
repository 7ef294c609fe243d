"""Column expressions used by several operators. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidewatch.config import BandCutoffs

MICROS_PER_HOUR = 3_600_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Whole microseconds from ``start`` to ``end`` (bigint).

    Zone-less timestamps are read in the session's zone, which should be UTC.
    """
    return micros_of(end) - micros_of(start)


def micros_of(ts: Column | str) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def hours_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_HOUR))


def add_micros(ts: Column | str, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros.cast("bigint"), _col(ts))


def ceil_div(value: Column, divisor: int) -> Column:
    """Ceiling of an integer division, exact for negative values as well."""
    d = F.lit(divisor).cast("bigint")
    return _int_div(value + F.pmod(-value, d), d)


def _int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def floor_div(value: Column, divisor: int) -> Column:
    """Floor of an integer division, exact for negative values as well."""
    d = F.lit(divisor).cast("bigint")
    return _int_div(value - F.pmod(value, d), d)


def null_if_nan(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Winsorise to [lo, hi]. Null stays null and NaN becomes null instead of ``hi``."""
    v = null_if_nan(c)
    return F.when(v < lo, F.lit(float(lo))).when(v > hi, F.lit(float(hi))).otherwise(v)


def canonical_enum(c: Column | str, allowed: Sequence[str], other: str | None) -> Column:
    """Upper-cased and trimmed value if it is one of ``allowed``, else ``other``."""
    v = F.upper(F.trim(_col(c)))
    return F.when(v.isin(*allowed), v).otherwise(F.lit(other))


def tie_hash(keys: Sequence[str], seed: int | str | None = None) -> Column:
    """md5 of the key values: a total order for ties that no key range is favoured by.

    Being uniform, its leading digits also cut a group of equal scores into even parts.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def hash_prefix(md5_hex: Column, digits: int) -> Column:
    """The leading hex digits of a digest as a bigint (at most 15 digits)."""
    return F.conv(F.substring(md5_hex, 1, digits), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket of a key from its md5: the same in every engine, and it cannot overflow."""
    return F.pmod(hash_prefix(F.md5(_col(key).cast("string")), 8), F.lit(buckets).cast("bigint"))


def murmur3_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket from Spark's own hash. The bigint cast keeps ``abs`` of the smallest int valid."""
    return F.pmod(F.abs(F.hash(_col(key)).cast("bigint")), F.lit(buckets).cast("bigint"))


def risk_band_of(score: Column | str, cutoffs: BandCutoffs = BandCutoffs()) -> Column:
    s = _col(score)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s >= cutoffs.high, F.lit("HIGH"))
        .when(s >= cutoffs.medium, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def derived_from_last(hr: str, sbp: str, dbp: str) -> dict[str, Column]:
    """Pulse pressure, mean arterial pressure and shock index from the last values."""
    h, s, d = F.col(hr), F.col(sbp), F.col(dbp)
    return {
        "pulse_pressure_last": s - d,
        "map_last": (d * 2.0 + s) / 3.0,
        "shock_index_last": F.try_divide(h, s),
    }
