"""Time helpers that do not depend on the session time zone.

Wall-clock values are TIMESTAMP_NTZ, instants are TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import compute_once

GRID_ZONE = "Australia/Sydney"
_OFFSET = r"(Z|z|[+-]\d{2}(:?\d{2})?)$"
_CLOCK = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?"
_EPOCH = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def wall_micros(ts: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 on the wall clock to a TIMESTAMP_NTZ."""
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86400
    seconds = seconds + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("bigint")


def wall_from_micros(micros: Column) -> Column:
    """The inverse of ``wall_micros``."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, origin)


def to_wall(ts: Column, zone: str = GRID_ZONE) -> Column:
    """The wall clock that a zone shows at an instant."""
    utc = wall_from_micros(F.unix_micros(ts))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def read_instants(
    df: DataFrame, text: str, zone: str = GRID_ZONE, ts: str = "ts", problem: str = "problem"
) -> DataFrame:
    """Read a text column as instants; say where it has none.

    Texts are epoch milliseconds, ISO with an offset, or ISO on the zone's
    clock. ``problem`` is NULL, ``gap`` (the zone's clock skips the time),
    ``overlap`` (the clock shows it twice) or ``unreadable``. Spark itself would
    shift a gap forward and pick one side of an overlap.
    """
    raw = F.col(text)
    kept = df.columns
    step = compute_once(
        df,
        {
            "_epoch": F.when(raw.rlike(_EPOCH), F.trim(raw).try_cast("decimal(25,3)")),
            "_aware": F.when(raw.rlike(_CLOCK + _OFFSET), raw.try_cast("timestamp")),
            "_wall": F.when(raw.rlike(_CLOCK + "$"), raw.try_cast("timestamp_ntz")),
        },
    )
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("_wall"))
    step = compute_once(step, {"_utc": utc})

    def shown(hours: int) -> Column:
        moved = F.timestamp_add("HOUR", F.lit(hours), F.col("_utc"))
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), moved)

    instant = F.coalesce(
        F.timestamp_micros((F.col("_epoch") * 1000).cast("bigint")),
        F.col("_aware"),
        F.timestamp_micros(wall_micros(F.col("_utc"))),
    )
    wall = F.col("_wall")
    why = (
        F.when(F.col("_epoch").isNull() & F.col("_aware").isNull() & wall.isNull(), "unreadable")
        .when(shown(0) != wall, "gap")
        .when((shown(1) == wall) | (shown(-1) == wall), "overlap")
    )
    return compute_once(step, {ts: instant, problem: why}, kept)


def iso_text(ts: Column, zone: str = GRID_ZONE) -> Column:
    """ISO text of an instant on the zone's clock, with its offset."""
    wall = to_wall(ts, zone)
    minutes = F.floor((wall_micros(wall) - F.unix_micros(ts)) / 60000000)
    size = F.abs(minutes)
    offset = F.format_string(
        "%s%02d:%02d",
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(size / 60),
        size % 60,
    )
    return F.concat(wall_text(wall), offset)


def wall_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss[.ffffff]`` of a TIMESTAMP_NTZ."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1000000).cast("bigint"))
