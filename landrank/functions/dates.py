"""Dates; the present is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_MS, DAY_MS, HOUR_MS = 365.2425 * 86_400_000, 86_400_000, 3_600_000


def tenure_years(sold_ms: Column, now_ms: Column) -> Column:
    """Whole years since a sale; in the future 0, unknown null."""
    return F.when(sold_ms.isNotNull(), F.greatest(F.lit(0), F.floor((now_ms - sold_ms) / YEAR_MS).cast("int")))


def vintage_years(assessment_year: Column, now: Column) -> Column:
    return F.year(now) - assessment_year


def iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms.cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms.cast("long")), "yyyy-MM-dd")


def age_days(evidence: Column, now: Column) -> Column:
    """Days since a dated text; one that is no date is infinitely old."""
    return F.coalesce(F.datediff(now, F.try_to_timestamp(evidence)).cast("double"), F.lit(float("inf")))


def freshness(last: Column, now: Column, bar_hours: float = 48) -> Column:
    """never, unknown, ok or stale."""
    hours = (F.unix_millis(now) - F.unix_millis(last)) / HOUR_MS
    return F.when(last.isNull(), "never").when(hours.isNull() | (hours < 0), "unknown").when(hours <= bar_hours, "ok").otherwise("stale")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def epoch_unit(ms: Column, now_ms: Column) -> Column:
    """Aggregate: "ms", or what is wrong with the greatest known epoch: as seconds look, or as dates to come."""
    most = F.max(ms)
    return F.when(most.isNull(), "none-known").when(most < 100_000_000_000, "seconds").when(most > now_ms + 366 * DAY_MS, "future").otherwise("ms")
