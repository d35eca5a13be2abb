"""Column expressions used by the operators: built-in Spark functions only.

Scalar expressions run inside whole-stage code generation; the vector functions are
higher-order functions, which Spark interprets element by element.
"""

from urbanlens.functions.scalar import (
    HOUR_BINS,
    PEAK_BINS,
    make_timestamp,
    day_of_week,
    duration_minutes,
    epoch_to_text,
    guarded_ratio,
    hour_bin,
    item_text,
    malformed_numeric,
    nullify_sentinels,
    parse_int,
    period,
    round_half_even,
    day_start,
    weekend_flag,
)
from urbanlens.functions.hashing import hash_fraction_below, md5_key
from urbanlens.functions.vectors import cosine, dot, l2_norm, l2_normalize

__all__ = [
    "HOUR_BINS",
    "PEAK_BINS",
    "make_timestamp",
    "cosine",
    "day_of_week",
    "dot",
    "duration_minutes",
    "epoch_to_text",
    "guarded_ratio",
    "hash_fraction_below",
    "hour_bin",
    "item_text",
    "l2_norm",
    "l2_normalize",
    "malformed_numeric",
    "md5_key",
    "nullify_sentinels",
    "parse_int",
    "period",
    "round_half_even",
    "day_start",
    "weekend_flag",
]
