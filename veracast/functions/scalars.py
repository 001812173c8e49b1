"""Column helpers shared by all models. All stay inside the JVM; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The first and last whole second of the years 0001 to 9999.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799

# Up to this many units of the last place, and farther than this from a tie, no binary
# noise and no rounding to twelve places moves a value across the tie.
_PLAIN_UNITS, _TIE_WIDTH = 1e9, 1e-5

# Fixed value: width of a forecast slot, 3 hours in seconds.
SLOT_SECONDS = 10800


def round_half_up(x: Column, digits: int) -> Column:
    """Round to ``digits`` places, halves away from zero, after dropping binary noise.

    An average such as 0.1 + 0.2 carries noise far below the sixth decimal; going through a decimal
    makes the tie fall the same way whatever order the terms were added in. Twelve places drop the
    noise and keep values that lie just below a tie below it. Values a decimal(38,12) cannot hold
    (NaN, infinities, beyond 1e26) are rounded as doubles.

    A value far from a tie needs no decimal, which costs many times as much: its nearest whole number
    of units is the same, and dividing that by a power of ten gives the double nearest to the decimal.
    """
    value = x.cast("double")
    exact = F.round(value.try_cast("decimal(38,12)"), digits).cast("double")
    units = value * F.lit(10.0**digits)
    clear = (F.abs(units) < _PLAIN_UNITS) & (F.abs(units - F.floor(units) - 0.5) > _TIE_WIDTH)
    plain = F.floor(units + 0.5).cast("double") / F.lit(10.0**digits)
    return F.when(clear, plain).otherwise(F.coalesce(exact, F.round(value, digits)))


def epoch_instant(x: Column) -> Column:
    """Epoch seconds to an instant; null when unreadable or outside years 0001-9999."""
    seconds = x.try_cast("bigint")
    return F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds))


def parse_instant(text: Column) -> Column:
    """ISO text to an instant, null when malformed.

    Spark also reads bare years and bare times of day (as today's date); both are refused here by
    asking for a full date in front.
    """
    dated = (F.length(text) >= 8) & (F.substring(text, 5, 1) == "-")
    return F.when(dated, text.try_cast("timestamp"))


def iso_utc(instant: Column) -> Column:
    """``2024-01-31T06:00:00+00:00``; needs a UTC session."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")


def record_key(city: Column, instant: Column) -> Column:
    """The id a record gets at the source: city, underscore, ISO time; null if a part is missing."""
    return F.concat(city, F.lit("_"), iso_utc(instant))


def key_suffix(key: Column) -> Column:
    """Text between the first and second underscore; null when there is none."""
    head = F.substring_index(key, "_", 2)
    return F.when(F.instr(key, "_") > 0, F.substring_index(head, "_", -1))


def hour_of(instant: Column) -> Column:
    return F.hour(instant).cast("bigint")


def whole_hours(start: Column, end: Column) -> Column:
    """Complete hours from ``start`` to ``end``, cut toward zero."""
    return F.timestamp_diff("HOUR", start, end).cast("bigint")


def slot_start(instant: Column) -> Column:
    """Start of the 3-hour slot holding the instant."""
    seconds = F.unix_seconds(instant)
    return F.timestamp_seconds(seconds - seconds % F.lit(SLOT_SECONDS))
