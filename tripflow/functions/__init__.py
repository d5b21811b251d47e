"""Column expressions used by the operators.

Each function returns a :class:`pyspark.sql.Column` built only from Spark's
own SQL functions, so it stays inside whole-stage code generation and runs the
same in batch and streaming plans.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tripflow import schemas



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

_EPOCH_UNITS = {"s": "SECOND", "ms": "MILLISECOND", "us": "MICROSECOND"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text and JSON ----------------------------------------------------------

def binary_to_text(c: Column | str) -> Column:
    """Message bytes to UTF-8 text (F2)."""
    return _c(c).cast("string")


def parse_json(c: Column | str, schema: StructType | str) -> Column:
    """JSON text to a typed struct (F1).

    Malformed text gives a struct of nulls; a field of the wrong type is null.
    """
    return F.from_json(_c(c), schema, {"mode": "PERMISSIVE"})


def record_to_json(*cols: Column | str, keep_nulls: bool = False) -> Column:
    """Columns to one JSON object text (F3). Null fields are left out unless
    ``keep_nulls``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts)


def json_has_key(c: Column | str, key: str) -> Column:
    """True when the JSON object text has ``key``, even with a null value."""
    keys = F.json_object_keys(_c(c))
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def default_if_absent(json_text: Column | str, key: str, value: Column,
                      default: object) -> Column:
    """``value`` when the object has ``key`` (explicit null stays null),
    ``default`` when the key is absent (F12)."""
    return F.when(json_has_key(json_text, key), value).otherwise(F.lit(default))


# -- truthiness and nulls -----------------------------------------------------

def truthy(c: Column | str) -> Column:
    """Feed flag to boolean: true/false words, any non-zero number is true;
    null, absent and other text count as false (F11)."""
    col = _c(c)
    return F.coalesce(col.try_cast("boolean"), col.try_cast("double") != 0, F.lit(False))


def null_if_token(c: Column | str, tokens: Iterable[str] = schemas.NULL_TOKENS) -> Column:
    """Text cell to null when it is one of the missing-value tokens.

    ``isin`` over literals is planned as a hash-set lookup built once.
    """
    col = _c(c)
    return F.when(~col.isin(list(tokens)), col)


def any_null(cols: Iterable[str]) -> Column:
    """True when any of ``cols`` is null."""
    conds = [F.col(c).isNull() for c in cols]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


# -- time ---------------------------------------------------------------------

def epoch_to_timestamp(c: Column | str, unit: str = "s") -> Column:
    """Epoch count to a zone-less timestamp, UTC wall clock.

    ``unit`` is ``s``, ``ms`` or ``us``. The result does not depend on the
    session time zone.
    """
    return F.timestamp_add(_EPOCH_UNITS[unit], _c(c), _epoch_ntz())


def timestamp_to_epoch(c: Column | str, unit: str = "s") -> Column:
    """Zone-less timestamp to an epoch count (whole ``unit``s, floor)."""
    return F.timestamp_diff(_EPOCH_UNITS[unit], _epoch_ntz(), _c(c))


def epoch_to_text(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds to formatted text in the session zone."""
    return F.from_unixtime(_c(c), fmt)


def to_day(c: Column | str) -> Column:
    """Timestamp to its date."""
    return F.to_date(_c(c))


def month_start(c: Column | str) -> Column:
    """First day of the timestamp's month, as a date (F8)."""
    return F.to_date(F.date_trunc("month", _c(c)))


# Text layout of older trip files (month/day/year), tried after
# the ISO forms ``yyyy-MM-dd[ HH:mm[:ss[.ffffff]]]`` and ``...T...``.
US_TIME_FORMAT = "M/d/yyyy H:mm[:ss]"


def parse_time(c: Column | str) -> Column:
    """Lenient text to zone-less timestamp; unreadable text is null.

    ISO date-times with or without fraction parse by cast; month/day/year
    text is tried next, if there is a slash in it: each text that fails there
    costs an exception. The input is referenced three times at most, so
    optimizer rewrites that copy the expression stay small.
    """
    col = F.trim(_c(c))
    return F.coalesce(
        col.try_cast("timestamp_ntz"),
        F.when(F.contains(col, F.lit("/")), F.try_to_timestamp(col, F.lit(US_TIME_FORMAT)).cast("timestamp_ntz")),
    )


def now(as_of: object | None = None) -> Column:
    """Current time as a zone-less timestamp, or a fixed ``as_of``."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of).cast("timestamp_ntz")


# -- numbers --------------------------------------------------------------------

def to_decimal(c: Column | str, precision: int = 9, scale: int = 6) -> Column:
    """Number or text to ``decimal(p,s)``, half-up; out of range gives null."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def to_month_date(c: Column | str) -> Column:
    """A month given as date, timestamp or text to a date."""
    return _c(c).try_cast("date")


def narrow(c: Column | str, to: DataType | str = "int") -> Column:
    """Wide integer to a narrower one; out of range gives null."""
    return _c(c).try_cast(to)


# -- names ------------------------------------------------------------------------

# Name pattern of monthly trip archives,
# ``<yyyyMM>-<system>-tripdata[.csv].zip``; ``system`` is a parameter.
def archive_pattern(system: str = "[a-z]+") -> str:
    return r"^\d{6}-" + system + r"-tripdata(?:\.csv)?\.zip$"


TRIP_ARCHIVE_PATTERN = archive_pattern()


def base_name(path: Column | str) -> Column:
    """Last path segment of a file path or URI."""
    return F.substring_index(_c(path), "/", -1)


def name_matches(path: Column | str, pattern: str = TRIP_ARCHIVE_PATTERN) -> Column:
    """File base name matches ``pattern`` (F16)."""
    return base_name(path).rlike(pattern)


def snapshot_time(path: Column | str) -> Column:
    """``yyyyMMddHHmmss`` stamp of a snapshot to a timestamp: taken from the
    file name, else the last stamp in its folders (``snapshot=.../part-...``)."""
    in_name = F.regexp_extract(base_name(path), r"(\d{14})", 1)
    in_path = F.regexp_extract(_c(path), r".*(\d{14})", 1)
    stamp = F.coalesce(F.nullif(in_name, F.lit("")), F.nullif(in_path, F.lit("")))
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
