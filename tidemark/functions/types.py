"""Source column types, and typed reads of row images.

Row images are VARIANT values. Reading a field straight into its target type keeps decimals exact,
which a detour through JSON text or string maps does not.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name -> Spark type, for the types without length or sign rules.
_PLAIN = {
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "real": T.DoubleType(),
    "double": T.DoubleType(),
    "double precision": T.DoubleType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "year": T.IntegerType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "tinytext": T.StringType(),
    "text": T.StringType(),
    "mediumtext": T.StringType(),
    "longtext": T.StringType(),
    "json": T.StringType(),
    "enum": T.StringType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "tinyblob": T.BinaryType(),
    "blob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
    "set": T.ArrayType(T.StringType()),
    "geometry": T.StringType(),
    "point": T.StringType(),
    "linestring": T.StringType(),
    "polygon": T.StringType(),
    "multipoint": T.StringType(),
    "multilinestring": T.StringType(),
    "multipolygon": T.StringType(),
    "geometrycollection": T.StringType(),
    "geomcollection": T.StringType(),
}

# Integer type -> (signed, unsigned).
_INTEGERS = {
    "tinyint": (T.ByteType(), T.ShortType()),
    "smallint": (T.ShortType(), T.IntegerType()),
    "mediumint": (T.IntegerType(), T.IntegerType()),
    "int": (T.IntegerType(), T.LongType()),
    "integer": (T.IntegerType(), T.LongType()),
    "bigint": (T.LongType(), T.DecimalType(20, 0)),
}

_TYPE = re.compile(r"\s*([a-z][a-z ]*?)\s*(?:\(([^)]*)\))?\s*((?:unsigned|signed|zerofill|\s)*)\s*", re.IGNORECASE)
_SIGN_WORDS = re.compile(r"\b(unsigned|signed|zerofill)\b", re.IGNORECASE)


def split_type(text: str) -> tuple[str, list[int], bool]:
    """``decimal(8,3) unsigned`` to its name, numeric arguments and unsigned flag."""
    flags = {w.lower() for w in _SIGN_WORDS.findall(text)}
    match = _TYPE.fullmatch(_SIGN_WORDS.sub(" ", text).strip())
    if not match:
        raise ValueError(f"cannot read column type: {text!r}")
    args = [int(a) for a in (match.group(2) or "").split(",") if a.strip().isdigit()]
    return match.group(1).lower(), args, bool(flags & {"unsigned", "zerofill"})


def spark_type(
    text: str,
    length: int | None = None,
    scale: int | None = None,
    tinyint1_not_bool: bool = False,
    unsigned_bigint_as_bigint: bool = True,
) -> T.DataType:
    """S-17, S-18: the Spark type of a source column type.

    ``length`` and ``scale`` are used when the text has no arguments of its own, as in schema change
    events. Decimals above 38 digits do not fit and become STRING.
    """
    name, args, unsigned = split_type(text)
    if not args and length is not None and length >= 0:
        args = [length] + ([scale] if scale is not None else [])
    if name == "serial":
        name, unsigned = "bigint", True
    if name == "tinyint" and args[:1] == [1] and not unsigned and not tinyint1_not_bool:
        return T.BooleanType()
    if name in _INTEGERS:
        if name == "bigint" and unsigned and unsigned_bigint_as_bigint:
            return T.LongType()
        return _INTEGERS[name][unsigned]
    if name in ("decimal", "numeric", "dec", "fixed"):
        precision, digits = (args + [0])[:2] if args else (10, 0)
        return T.DecimalType(precision, digits) if precision <= 38 else T.StringType()
    if name == "bit":
        return T.BooleanType() if (args or [1])[0] == 1 else T.BinaryType()
    if name == "char":
        return T.CharType((args or [1])[0])
    if name == "varchar":
        return T.VarcharType((args or [255])[0])
    if name in _PLAIN:
        return _PLAIN[name]
    raise ValueError(f"unknown column type: {text!r}")


def storage_type(dtype: T.DataType) -> T.DataType:
    """The type kept in files: character lengths live in field metadata only."""
    return T.StringType() if isinstance(dtype, (T.CharType, T.VarcharType)) else dtype


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def raw_value(image: Column | str, *names: str) -> Column:
    """A field of a row image as text, trying the given spellings in turn."""
    return _get(image, names, "string", strict=False)


def _get(image: Column | str, names: tuple[str, ...], ddl: str, strict: bool) -> Column:
    column = F.col(image) if isinstance(image, str) else image
    read = F.variant_get if strict else F.try_variant_get
    values = [read(column, _path(n), ddl) for n in names]
    return values[0] if len(values) == 1 else F.coalesce(*values)


def is_encoded(dtype: T.DataType, source_type: str = "") -> bool:
    """Does the log write this type in a form of its own, so that it is read as text first?"""
    if isinstance(storage_type(dtype), T.StringType):
        return bool(source_type) and split_type(source_type)[0] == "time"
    return isinstance(dtype, (T.DateType, T.TimestampNTZType, T.BinaryType, T.BooleanType, T.ArrayType))


def decode_text(text: Column, dtype: T.DataType, source_type: str = "", strict: bool = True) -> Column:
    """Undo the log's encoding: days for DATE, milli- or microseconds for DATETIME, base64 for binary, 0 and 1
    for BOOLEAN, comma lists for SET, microseconds for TIME. The text is used more than once."""
    cast = (lambda t: text.cast(t)) if strict else (lambda t: text.try_cast(t))
    number = text.try_cast("bigint")
    is_number = text.rlike(r"\A-?\d+\z")
    if isinstance(dtype, T.DateType):
        days = F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int"))
        return F.when(is_number, days).otherwise(cast("date"))
    if isinstance(dtype, T.TimestampNTZType):
        _, args, _ = split_type(source_type) if source_type else ("", [], False)
        per_second = 1_000_000 if args and args[0] > 3 else 1_000
        seconds = (number / F.lit(per_second).cast("decimal(7,0)")).cast("decimal(18,6)")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
        return F.when(is_number, epoch).otherwise(cast("timestamp_ntz"))
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(text)
    if isinstance(dtype, T.BooleanType):
        return F.when(is_number, number != 0).otherwise(cast("boolean"))
    if isinstance(dtype, T.ArrayType):
        return F.when(text == "", F.array().cast(dtype)).otherwise(F.split(text, ","))
    _, args, _ = split_type(source_type) if source_type else ("", [], False)
    return F.when(is_number, _clock(number, args[0] if args else 0)).otherwise(text)


def _clock(micros: Column, digits: int = 0) -> Column:
    """``[-]HH:mm:ss`` of a span in microseconds, with as many digits of its fraction as the type has."""

    def two_digits(c: Column) -> Column:
        return F.lpad(c.cast("string"), F.greatest(F.lit(2), F.length(c.cast("string"))), "0")

    second = (F.abs(micros) - F.abs(micros) % 1_000_000) / 1_000_000
    hour, rest = F.floor(second / 3600), (second % 3600).cast("int")
    clock = F.concat_ws(":", two_digits(hour), F.lpad(F.floor(rest / 60).cast("string"), 2, "0"), F.lpad((rest % 60).cast("string"), 2, "0"))
    parts = [F.when(micros < 0, "-").otherwise(""), clock]
    if digits:
        fraction = F.lpad((F.abs(micros) % 1_000_000).cast("string"), 6, "0")
        parts += [F.lit("."), F.substring(fraction, 1, digits)]
    return F.concat(*parts)


def stored_value(
    image: Column | str, names: tuple[str, ...], dtype: T.DataType, source_type: str = "", strict: bool = True
) -> Column:
    """First half of :func:`typed_value`: the text of an encoded field, or the value itself."""
    ddl = "string" if is_encoded(dtype, source_type) else storage_type(dtype).simpleString()
    return _get(image, names, ddl, strict)


def typed_value(
    image: Column | str,
    names: str | tuple[str, ...],
    dtype: T.DataType,
    source_type: str = "",
    strict: bool = True,
) -> Column:
    """S-16: one field of a row image in its target type.

    ``strict`` fails on text that does not convert; otherwise such a value is NULL.
    """
    names = (names,) if isinstance(names, str) else tuple(names)
    value = stored_value(image, names, dtype, source_type, strict)
    return decode_text(value, dtype, source_type, strict) if is_encoded(dtype, source_type) else value


def present(image: Column | str) -> Column:
    """Is there a row image? A JSON null image is a VARIANT null, which is not SQL NULL."""
    column = F.col(image) if isinstance(image, str) else image
    return column.isNotNull() & ~F.is_variant_null(column)


# --- widening -----------------------------------------------------------------------------------

_LADDERS = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType),
)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Can every value of ``old`` be kept in ``new``?"""
    return widest(old, new) == new


# Digits that an integer type needs as a decimal.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
# What a floating point type holds without loss.
_EXACT = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType)}


def widest(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """C-10: the least type that keeps every value of both; None where there is none.

    Within families: integers, floating point, decimals, character types by length. Across them: integers to decimals,
    integers up to 32 bits to DOUBLE and up to 16 bits to FLOAT, dates to times. What would lose digits, such as BIGINT to
    DOUBLE, has no common type.
    """
    if old == new:
        return old
    for ladder in _LADDERS:
        if isinstance(old, ladder) and isinstance(new, ladder):
            return max(old, new, key=lambda t: ladder.index(type(t)))
    text = (T.CharType, T.VarcharType, T.StringType)
    if isinstance(old, text) and isinstance(new, text):
        return max(old, new, key=_text_rank)
    for a, b in ((old, new), (new, old)):
        if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
            return b
        if type(b) in _EXACT and isinstance(a, _EXACT[type(b)]):
            return b
        if isinstance(a, T.IntegerType) and isinstance(b, T.FloatType):
            return T.DoubleType()
    sizes = [_decimal(t) for t in (old, new)]
    if all(sizes):
        scale = max(s for _, s in sizes)
        precision = max(p - s for p, s in sizes) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def _decimal(dtype: T.DataType) -> tuple[int, int] | None:
    """Precision and scale as a decimal, for exact numbers."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision, dtype.scale
    return (_DIGITS[type(dtype)], 0) if type(dtype) in _DIGITS else None


def same_family(old: T.DataType, new: T.DataType) -> bool:
    """Is a file of the old type read under the new one by the file reader itself?"""
    exact = isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale
    ladder = any(isinstance(old, x) and isinstance(new, x) for x in _LADDERS)
    return exact or ladder or isinstance(storage_type(old), T.StringType) or old == new


def same_text(old: T.DataType, new: T.DataType) -> bool:
    """Is every value of the old type written alike under the new one? Keys are placed by their text."""
    whole = [isinstance(t, tuple(_DIGITS)) or (isinstance(t, T.DecimalType) and t.scale == 0) for t in (old, new)]
    return all(whole) or (isinstance(storage_type(old), T.StringType) and isinstance(storage_type(new), T.StringType))


def _text_rank(dtype: T.DataType) -> tuple[int, int]:
    length = getattr(dtype, "length", None)
    if length is None:
        return (1 << 62, 0)
    return (length, isinstance(dtype, T.VarcharType))
