"""Guide times: stamps of programme feeds, epoch seconds, ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_stamp(value: Column) -> Column:
    """Epoch seconds of YYYYMMDDhhmm[ss] [+hhmm|Z]; a bad zone counts as UTC, a bad stamp is null."""
    parts = F.split(F.trim(value), r"\s+")
    digits = F.element_at(parts, 1)
    fine = digits.rlike("^[0-9]{12,}$")
    stamp = F.when(F.length(digits) >= 14, F.substring(digits, 1, 14)).otherwise(F.concat(F.substring(digits, 1, 12), F.lit("00")))
    usual = fine & ((F.length(digits) == 12) | (F.length(digits) >= 14))
    local = F.unix_timestamp(F.try_to_timestamp(F.when(usual, F.concat(stamp, F.lit(" +0000"))), F.lit("yyyyMMddHHmmss xx")))
    zone = F.when(F.size(parts) > 1, F.get(parts, F.lit(1)))
    signed = zone.rlike(r"^[+-][0-9]{4}$")
    offset = (F.substring(zone, 2, 2).try_cast("int") * 3600 + F.substring(zone, 4, 2).try_cast("int") * 60) * F.when(zone.startswith("-"), -1).otherwise(1)
    return local - F.when(signed, offset).otherwise(0)


def stamp(epoch: Column) -> Column:
    """YYYYMMDDhhmmss +0000 of epoch seconds (the session's zone must be UTC)."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyyMMddHHmmss '+0000'")


def iso(epoch: Column) -> Column:
    """ISO text of epoch seconds, empty for null."""
    return F.coalesce(F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def parse_iso(value: Column) -> Column:
    """Epoch seconds of ISO text; null for anything else."""
    return F.unix_timestamp(F.try_to_timestamp(value))


def bucket(epoch: Column, minutes: int = 5) -> Column:
    return F.floor(epoch / (minutes * 60)).cast("long")
