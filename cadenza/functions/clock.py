"""D3, F11 and the calendar parts shared by dimensions, fact and reports."""

from pyspark.sql import Column, functions as F

_DAY_MICROS = 86_400_000_000


def day_part(hour: Column) -> Column:
    """Morning 5-11, Afternoon 12-16, Evening 17-20, Night otherwise."""
    return (
        F.when(hour.between(5, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 20), "Evening")
        .otherwise("Night")
    )


def second_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def iso_weekday(ts: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(ts) + 1).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fractions. Days and the rest are divided apart, which gives the same last bit
    as an interval's epoch; NULL when either end is missing."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    rest = micros % _DAY_MICROS
    return (micros - rest) / F.lit(_DAY_MICROS) * F.lit(86400.0) + rest / F.lit(1_000_000)
