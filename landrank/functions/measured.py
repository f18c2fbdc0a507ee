"""Measured numbers: a value, or the reason why it is unknown.  Unknown is never zero.

A measured number is a struct of value (double) and unknown_reason (string), of which exactly one is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The reasons, and the windows (UTC, epoch ms, from-to half open) and texts that stand for "no date".
REASONS = ("null", "empty-string", "non-numeric", "zero-sentinel", "negative", "date-sentinel", "implausible-date")
DATE_WINDOWS = (("1899-12-31", "1900-01-02"), ("1752-12-31", "1753-01-02"))
DATE_TEXTS = ("1/1/1900 12:00:00 AM", "1900-01-01", "1900-01-01T00:00:00Z", "1900-01-01T00:00:00.000Z")
PLAUSIBLE = ("1700-01-01", "2100-01-01")


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def known(value: Column) -> Column:
    return F.struct(value.cast("double").alias("value"), F.lit(None).cast("string").alias("unknown_reason"))


def unknown(reason: str | Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(F.lit(None).cast("double").alias("value"), reason.cast("string").alias("unknown_reason"))


def _measured(value: Column, reason: Column) -> Column:
    return F.struct(F.when(reason.isNull(), value).alias("value"), reason.alias("unknown_reason"))


def _number(raw: Column) -> tuple[Column, Column]:
    """raw as a double, and whether it is blank.  What is a double already, or a whole number, takes no detour by its text: the type is
    known when the query is planned, so only one of the branches is left."""
    plain = F.typeof(raw).isin("double", "bigint", "int", "smallint", "tinyint")
    text = F.trim(raw.cast("string"))
    return F.when(plain, raw.try_cast("double")).otherwise(text.try_cast("double")), F.when(plain, False).otherwise(text == "")


def positive_quantity(raw: Column) -> Column:
    """null, blank, not a number, zero and negative are unknown, in this order; what is left is known."""
    number, blank = _number(raw)
    reason = (F.when(raw.isNull(), "null").when(blank, "empty-string").when(number.isNull() | ~_finite(number), "non-numeric")
              .when(number == 0, "zero-sentinel").when(number < 0, "negative"))
    return _measured(number, reason)


def epoch(day: str) -> Column:
    return F.unix_millis(F.to_timestamp(F.lit(day)))


def is_date_sentinel(ms: Column) -> Column:
    out = F.lit(False)
    for start, end in DATE_WINDOWS:
        out = out | ((ms >= epoch(start)) & (ms < epoch(end)))
    return out


def sentinel_date(raw: Column) -> Column:
    """Epoch milliseconds of a number or a date text; what stands for "no date" is unknown."""
    text = F.trim(raw.cast("string"))
    ms = F.coalesce(text.try_cast("double"), F.unix_millis(F.try_to_timestamp(text)).cast("double"))
    reason = (F.when(raw.isNull(), "null").when(text == "", "empty-string").when(text.isin(*DATE_TEXTS), "date-sentinel")
              .when(ms.isNull() | ~_finite(ms), "non-numeric").when(is_date_sentinel(ms), "date-sentinel").when(ms == 0, "zero-sentinel"))
    return _measured(ms, reason)


def plausible_date(raw: Column) -> Column:
    """sentinel_date(), with known dates before 1700 or after 2100 unknown."""
    m = sentinel_date(raw)
    bad = (m["value"] < epoch(PLAUSIBLE[0])) | (m["value"] > epoch(PLAUSIBLE[1]))
    return _measured(m["value"], F.coalesce(m["unknown_reason"], F.when(bad, "implausible-date")))


def safe_divide(a: Column, b: Column) -> Column:
    """The first unknown operand's reason, the numerator's first; a zero denominator is a zero sentinel."""
    q = F.try_divide(a["value"], b["value"])
    reason = F.coalesce(a["unknown_reason"], b["unknown_reason"], F.when(b["value"] == 0, "zero-sentinel"),
                        F.when(~_finite(q), "non-numeric"))
    return _measured(q, reason)


def flatten(m: Column, name: str) -> list[Column]:
    return [m["value"].alias(name), m["unknown_reason"].alias(f"{name}_unknown_reason")]


def or_else(x: Column, other: Column) -> Column:
    """other where x is null or empty."""
    return F.coalesce(F.nullif(x, F.lit("")), other)


def clamp(x: Column, low: float, high: float) -> Column:
    """Keeps null and NaN, which least() and greatest() do not."""
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


def invert(percentile: Column) -> Column:
    return clamp(100 - percentile, 0, 100)


def js_round(x: Column, digits: int = 0) -> Column:
    """Rounds half up, as floor(x * 10^d + 1/2) / 10^d in doubles."""
    scale = float(10 ** digits)
    return F.floor(x * scale + 0.5) / scale


def zero_share(raw: Column) -> Column:
    """Aggregate: percentage of rows whose number is zero or missing."""
    return 100 * F.avg((~(positive_quantity(raw)["value"] > 0) | positive_quantity(raw)["value"].isNull()).cast("double"))
