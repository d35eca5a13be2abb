"""Parsing, calendar, binning and ratio expressions."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values (must equal the surveyed jobs' business rules):
# hour bins are half-open [start, end) ranges of the pickup hour, checked in this
# order; any other hour (including NULL) falls into the default bin.
HOUR_BINS: tuple[tuple[str, int, int], ...] = (
    ("Morning_Rush", 7, 10),
    ("Off_Peak_Day", 10, 16),
    ("Evening_Rush", 16, 20),
)
DEFAULT_HOUR_BIN = "Late_Night_Off_Peak"
# Bins counted as the peak period; everything else is "Off_Peak".
PEAK_BINS: tuple[str, ...] = ("Morning_Rush", "Evening_Rush")
# Spark's dayofweek numbers for Sunday and Saturday.
WEEKEND_DAYS: tuple[int, ...] = (1, 7)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(text: ColumnOrName, thousands_sep: str = ",") -> Column:
    """Text with thousands separators -> int; unparseable text -> NULL (ANSI-safe)."""
    return F.regexp_replace(_col(text), thousands_sep, "").try_cast("int")


def nullify_sentinels(
    value: ColumnOrName, negatives: bool = True, codes: Sequence[int] = (999,)
) -> Column:
    """NULL out error codes: negative values and explicit codes. Zeros are kept."""
    v = _col(value)
    cond = F.lit(False)
    if negatives:
        cond = cond | (v < 0)
    if codes:
        cond = cond | v.isin(list(codes))
    return F.when(cond, F.lit(None)).otherwise(v)


def malformed_numeric(text: ColumnOrName, pattern: str = r"^-?\d+$") -> Column:
    """True when the text is not a plain (optionally negative) integer.

    NULL text gives NULL, so a ``filter`` on this predicate skips NULLs.
    """
    return ~_col(text).rlike(pattern)


def make_timestamp(
    year: ColumnOrName, month: ColumnOrName, day: ColumnOrName, hour: ColumnOrName, minute: ColumnOrName
) -> Column:
    """Timestamp of integer parts; impossible dates and NULL parts -> NULL."""
    return F.try_make_timestamp(_col(year), _col(month), _col(day), _col(hour), _col(minute), F.lit(0))


def day_of_week(ts: ColumnOrName) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(ts))


def weekend_flag(dow: ColumnOrName) -> Column:
    return F.when(_col(dow).isin(*WEEKEND_DAYS), 1).otherwise(0)


def hour_bin(
    hour: ColumnOrName,
    bins: Sequence[tuple[str, int, int]] = HOUR_BINS,
    default: str = DEFAULT_HOUR_BIN,
) -> Column:
    """Label an hour with the first ``[start, end)`` bin containing it."""
    h = _col(hour)
    expr = None
    for label, start, end in bins:
        cond = (h >= start) & (h < end)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def period(bin_label: ColumnOrName, peak: Sequence[str] = PEAK_BINS) -> Column:
    """``Peak`` for peak bins, otherwise (also NULL) ``Off_Peak``."""
    return F.when(_col(bin_label).isin(*peak), "Peak").otherwise("Off_Peak")


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole-second difference ``end - start`` in minutes (double)."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / 60.0


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0``; otherwise (also NULL den) ``default``."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d).otherwise(F.lit(default))


def item_text(title: ColumnOrName, genres: ColumnOrName, sep: str = "|") -> Column:
    """``title: genre genre ...`` — the text that is turned into an item vector."""
    return F.concat(_col(title), F.lit(": "), F.translate(_col(genres), sep, " "))


def round_half_even(value: ColumnOrName, digits: int = 2) -> Column:
    """Round the exact binary value of a double to ``digits``, exact ties to even.

    Spark's ``round`` rounds the decimal text half-up, and ``rint(x * 10^d)`` goes
    wrong when the product itself is rounded onto a tie (43/40 is a little below
    1.075 but 107.5 after scaling). On such a tie the rounding error of the product,
    from a two-part split of the value, says on which side the exact value lies.
    Holds while ``x * 10^d`` is below 2^52 in size.
    """
    x = _col(value)
    scale = 10.0**digits
    scaled = x * scale
    below = F.floor(scaled).cast("double")
    # x = high + low with 26-bit parts, so both products are exact
    wide = x * 134217729.0
    high = wide - (wide - x)
    error = (high * scale - scaled) + (x - high) * scale
    tie = scaled - below == 0.5
    whole = F.when(tie & (error > 0), below + 1.0).when(tie & (error < 0), below).otherwise(F.rint(scaled))
    return whole / scale


def epoch_to_text(epoch: ColumnOrName) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` (session time zone, UTC)."""
    return F.date_format(F.timestamp_seconds(_col(epoch)), "yyyy-MM-dd HH:mm:ss")


def day_start(day: _dt.date, after: int = 0) -> Column:
    """Epoch second at which the UTC day ``after`` days later begins."""
    return F.unix_date(F.date_add(F.lit(day), after)).cast("bigint") * 86400
