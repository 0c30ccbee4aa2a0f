"""Conversions between instants and their number and text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last second of the years 1 to 9999.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def from_epoch_seconds(seconds: Column) -> Column:
    """The instant, or NULL outside the years 1 to 9999. No detour over local time, which
    would be ambiguous in the hour a clock is set back."""
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds)
    )


def from_iso_text(text: Column) -> Column:
    """The instant, or NULL for text that is none."""
    return F.try_to_timestamp(text)


def to_iso_text(instant: Column) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero."""
    whole = F.date_trunc("second", instant)
    return F.when(
        instant == whole, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def to_plain_values(df):
    """Decimals as doubles, dates and timestamps as ISO text: the form reports are handed on in."""
    columns = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "decimal":
            columns[field.name] = F.col(field.name).cast("double")
        elif kind == "date":
            columns[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            stamp = F.col(field.name)
            whole = F.date_trunc("second", stamp) == stamp
            columns[field.name] = F.when(
                whole, F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
            ).otherwise(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return df.withColumns(columns) if columns else df
