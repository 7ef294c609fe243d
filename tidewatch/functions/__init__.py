from tidewatch.functions.columns import (
    add_micros,
    canonical_enum,
    ceil_div,
    clip,
    derived_from_last,
    floor_div,
    hash_bucket,
    hash_prefix,
    hours_between,
    micros_between,
    murmur3_bucket,
    null_if_nan,
    risk_band_of,
    tie_hash,
)

__all__ = [
    "add_micros",
    "canonical_enum",
    "ceil_div",
    "clip",
    "derived_from_last",
    "floor_div",
    "hash_bucket",
    "hash_prefix",
    "hours_between",
    "micros_between",
    "murmur3_bucket",
    "null_if_nan",
    "risk_band_of",
    "tie_hash",
]
