"""Text -> typed value converters (read side) and typed value -> text (sink side).

Every converter is a Column expression, so a schema-driven projection is one
code-generated ``Project`` over the scan.  Bad text fails the query (as a
strict reader should) independently of ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
# Whole numbers only: no blanks, no fraction, optional sign.
_INTEGRAL_TEXT = r"^[+-]?[0-9]+$"
# Dates and date-times in full: a cast alone ignores what follows a date and
# drops a zone that a zone-free target cannot hold.
_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_TIME = r"[ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,9})?)?"
_ZONE = r"(Z|[ ]?UTC|[ ]?GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)"
_DATE_TEXT = rf"^{_DATE}({_TIME})?$"
_NTZ_TEXT = rf"^{_DATE}({_TIME})?$"
_TIMESTAMP_TEXT = rf"^{_DATE}({_TIME}{_ZONE}?)?$"

READ_TYPES = _INTEGRAL + _FLOATING + (
    T.BooleanType, T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType,
)


class UnsupportedTypeError(TypeError):
    pass


def check_read_schema(schema: T.StructType) -> None:
    """Refuse a read schema with types a log value cannot hold (arrays, maps,
    nested structs, binary, intervals ...) before any plan is built."""
    for f in schema.fields:
        if not isinstance(f.dataType, READ_TYPES):
            raise UnsupportedTypeError(
                f"a log value cannot be read as {f.dataType.simpleString()} (column {f.name})"
            )


def null_message(name: str) -> str:
    return f"column {name} must hold a value but the log has none"


def _fail(name: str, dtype: T.DataType, v: Column) -> Column:
    return F.raise_error(
        F.concat(
            F.lit(f"cannot convert value of field {name} to {dtype.simpleString()}: '"),
            v,
            F.lit("'"),
        )
    )


def _checked(v: Column, converted: Column, name: str, dtype: T.DataType) -> Column:
    """``converted`` where it is not null; null text stays null; any other
    text that did not convert fails the query.  ``converted`` is referenced
    once, so the parse runs once per value."""
    return F.coalesce(converted, F.when(v.isNotNull(), _fail(name, dtype, v).cast(dtype)))


def convert(v: Column, dtype: T.DataType, name: str = "value", nullable: bool = True) -> Column:
    """Strict text -> ``dtype`` conversion of a STRING column."""
    if isinstance(dtype, _INTEGRAL):
        out = _checked(v, F.when(v.rlike(_INTEGRAL_TEXT), v.try_cast(dtype)), name, dtype)
    elif isinstance(dtype, _FLOATING):
        out = _checked(v, v.try_cast(dtype), name, dtype)
    elif isinstance(dtype, T.BooleanType):
        low = F.lower(v)
        out = _checked(v, F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False)), name, dtype)
    elif isinstance(dtype, T.DecimalType):
        out = _checked(v, F.regexp_replace(v, ",", "").try_cast(dtype), name, dtype)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        # date, date-time with blank or ISO 'T', optional fraction and, for
        # TIMESTAMP only, an optional zone; anything else fails
        form = {T.DateType: _DATE_TEXT, T.TimestampNTZType: _NTZ_TEXT, T.TimestampType: _TIMESTAMP_TEXT}[type(dtype)]
        out = _checked(v, F.when(v.rlike(form), v.try_cast(dtype)), name, dtype)
    elif isinstance(dtype, T.StringType):
        out = v
    else:
        raise UnsupportedTypeError(f"a log value cannot be read as {dtype.simpleString()} (column {name})")
    if not nullable:
        out = F.coalesce(out, F.when(v.isNull(), F.raise_error(F.lit(null_message(name))).cast(dtype)))
    return out


def checked_not_null(v: Column, dtype: T.DataType, name: str, reason: str) -> list[Column]:
    """The non-nullable conversion with its refusal as a column instead of a
    failure: (value, reason); the strict form runs where there is a value."""
    return [
        F.when(v.isNotNull(), convert(v, dtype, name, nullable=False)).alias(name),
        F.when(v.isNull(), F.lit(null_message(name))).alias(reason),
    ]


# ---------------------------------------------------------------------------
# Sink side: typed value -> log text.

class UnsupportedSinkTypeError(TypeError):
    pass


def check_sink_schema(schema: T.StructType) -> None:
    """Binary, array and map columns cannot become log text."""
    for f in schema.fields:
        _check_sink_type(f.name, f.dataType)


def _check_sink_type(name: str, dt: T.DataType) -> None:
    if isinstance(dt, (T.BinaryType, T.ArrayType, T.MapType)):
        raise UnsupportedSinkTypeError(
            f"column {name}: a value of type {dt.simpleString()} has no log text"
        )
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            _check_sink_type(f"{name}.{f.name}", f.dataType)


def to_log_text(c: Column, dtype: T.DataType) -> Column:
    """Text of one value as the sink stores it: decimals as double text,
    timestamps and dates as epoch milliseconds, nested structs as JSON text."""
    if isinstance(dtype, T.DecimalType):
        return c.cast("double").cast("string")
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c).cast("string")
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), c).cast(
            "string"
        )
    if isinstance(dtype, T.DateType):
        return F.unix_millis(c.cast("timestamp")).cast("string")
    if isinstance(dtype, T.StructType):
        return F.to_json(c)
    if isinstance(dtype, (T.BinaryType, T.ArrayType, T.MapType)):
        raise UnsupportedSinkTypeError(f"a value of type {dtype.simpleString()} has no log text")
    return c.cast("string")
