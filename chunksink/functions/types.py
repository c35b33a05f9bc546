"""Logical column types: checked conversion, CSV text and byte size, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.functions import text
from chunksink.functions.bson import bson_bytes


class Type:
    """A column type. ``convert`` gives the stored value or raises at run time; nulls pass through it."""

    spark: T.DataType
    numeric = False

    def accepts(self, kind: T.DataType) -> bool:
        return True

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return value.cast(self.spark)

    def csv(self, value: Column) -> Column:
        return value.cast("string")

    def size(self, value: Column) -> Column:
        """Bytes of the plain value, nulls 0."""
        raise NotImplementedError


def _check(value: Column, ok: Column, message: str) -> Column:
    return F.when(ok | value.isNull(), value).otherwise(F.raise_error(F.concat(F.lit(message), F.lit(": "), F.coalesce(value.cast("string"), F.lit("null")))))


def _fixed(value: Column, width: int) -> Column:
    return F.when(value.isNull(), 0).otherwise(width).cast("long")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


@dataclass(frozen=True)
class String(Type):
    spark = T.StringType()

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, T.StringType)

    def size(self, value: Column) -> Column:
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Binary(Type):
    """Bytes, of exactly ``length`` if given."""

    length: int | None = None
    spark = T.BinaryType()

    def __post_init__(self) -> None:
        if self.length is not None and self.length <= 0:
            raise ValueError("length must be positive")

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, (T.BinaryType, T.StringType))

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        value = value.cast("binary")
        if self.length is None:
            return value
        wrong = F.raise_error(F.concat(F.lit(f"{name}: expected {self.length} bytes, got "), F.octet_length(value).cast("string")))
        return F.when((F.octet_length(value) == self.length) | value.isNull(), value).otherwise(wrong)

    def size(self, value: Column) -> Column:
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


_BITS = {"byte": 8, "tinyint": 8, "short": 16, "smallint": 16, "integer": 32, "int": 32, "long": 64, "bigint": 64}


@dataclass(frozen=True)
class _Integer(Type):
    low: int
    high: int
    spark: T.DataType
    width: int
    numeric = True

    def accepts(self, kind: T.DataType) -> bool:
        return _is_number(kind)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        if not self._fractions(kind):
            return _check(value, self.fits(value, kind), f"{name}: out of range [{self.low}, {self.high}]").cast(self.spark)
        value = _check(value, value == F.floor(value), f"{name}: not an integer")
        return _check(value.cast("decimal(38,0)"), self._within(value, kind), f"{name}: out of range [{self.low}, {self.high}]").cast(self.spark)

    @staticmethod
    def _fractions(kind: T.DataType) -> bool:
        return isinstance(kind, (T.FloatType, T.DoubleType)) or (isinstance(kind, T.DecimalType) and kind.scale > 0)

    def _within(self, value: Column, kind: T.DataType) -> Column:
        if (bits := _BITS.get(kind.typeName())) is not None:  # stays in integers, and needs no check where every value fits
            least, most = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
            ok = ([value >= self.low] if least < self.low else []) + ([value <= self.high] if most > self.high else [])
            return ok[0] & ok[-1] if ok else F.lit(True)
        wide = value.cast("decimal(38,0)")
        bound = lambda x: F.lit(str(x)).cast("decimal(38,0)")
        return (wide >= bound(self.low)) & (wide <= bound(self.high))

    def fits(self, value: Column, kind: T.DataType) -> Column:
        """Whether a value of type ``kind`` is a whole number in the range."""
        within = self._within(value, kind)
        return (value == F.floor(value)) & within if self._fractions(kind) else within

    def size(self, value: Column) -> Column:
        return _fixed(value, self.width)


def Int8() -> Type:
    return _Integer(-(1 << 7), (1 << 7) - 1, T.ByteType(), 4)


def Int16() -> Type:
    return _Integer(-(1 << 15), (1 << 15) - 1, T.ShortType(), 4)


def Int32() -> Type:
    return _Integer(-(1 << 31), (1 << 31) - 1, T.IntegerType(), 4)


def Int64() -> Type:
    return _Integer(-(1 << 63), (1 << 63) - 1, T.LongType(), 8)


def Uint8() -> Type:
    return _Integer(0, (1 << 8) - 1, T.ShortType(), 4)


def Uint16() -> Type:
    return _Integer(0, (1 << 16) - 1, T.IntegerType(), 4)


def Uint32() -> Type:
    return _Integer(0, (1 << 32) - 1, T.LongType(), 4)


def Uint64() -> Type:
    return _Integer(0, (1 << 64) - 1, T.DecimalType(20, 0), 8)


@dataclass(frozen=True)
class _Floating(Type):
    spark: T.DataType
    width: int
    numeric = True

    def accepts(self, kind: T.DataType) -> bool:
        return _is_number(kind)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        value = value.cast(self.spark)
        return _check(value, ~F.isnan(value), f"{name}: not a number")

    def size(self, value: Column) -> Column:
        return _fixed(value, self.width)


def Float() -> Type:
    return _Floating(T.FloatType(), 4)


def Double() -> Type:
    return _Floating(T.DoubleType(), 8)


@dataclass(frozen=True)
class Boolean(Type):
    spark = T.BooleanType()

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, T.BooleanType)

    def size(self, value: Column) -> Column:
        return _fixed(value, 1)


@dataclass(frozen=True)
class Timestamp(Type):
    """An instant, kept to the millisecond."""

    spark = T.TimestampType()

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, (T.TimestampType, T.TimestampNTZType))

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return F.date_trunc("millisecond", value.cast("timestamp"))

    def csv(self, value: Column) -> Column:
        return text.iso_text(value)

    def size(self, value: Column) -> Column:
        return _fixed(value, 8)


#: Sign, integer digits, fraction digits and power of ten of a number's text.
_NUMBER = r"^\s*([+-]?)(?=\.?\d)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?\s*$"


@dataclass(frozen=True)
class Decimal(Type):
    """``precision`` digits, ``scale`` of them after the point; further fraction digits are cut, not rounded."""

    precision: int
    scale: int = 0
    numeric = True

    def __post_init__(self) -> None:
        if not 0 < self.precision <= 38:
            raise ValueError("precision must be between 1 and 38")
        if not 0 <= self.scale < self.precision:
            raise ValueError("scale must be at least 0 and less than the precision")

    @property
    def spark(self) -> T.DataType:  # type: ignore[override]
        return T.DecimalType(self.precision, self.scale)

    def accepts(self, kind: T.DataType) -> bool:
        return _is_number(kind) or isinstance(kind, T.StringType)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        if isinstance(kind, (T.FloatType, T.DoubleType, T.StringType)):
            return self._from_text(value.cast("string"), name)
        if not isinstance(kind, T.DecimalType):
            value = value.cast("decimal(20,0)")
        cut = F.signum(value).cast("decimal(1,0)") * F.floor(F.abs(value), F.lit(self.scale))
        digits = self.precision - self.scale
        fits = F.abs(value) < F.lit("1" + "0" * digits).cast(f"decimal({digits + 1},0)") if digits < 38 else F.lit(True)
        return _check(cut, fits, f"{name}: more than {digits} integer digits").cast(self.spark)

    def _from_text(self, value: Column, name: str) -> Column:
        """The digits of a number's text, cut to the scale before any cast, so that no precision is lost on the way."""
        most = self.precision - self.scale
        read = F.struct(*(F.regexp_extract(value, _NUMBER, k).alias(c) for k, c in enumerate(("sign", "whole", "rest", "power"), 1)))

        def plain(x: Column) -> Column:
            digits, power = F.concat(x["whole"], x["rest"]), F.coalesce(F.nullif(x["power"], F.lit("")).cast("int"), F.lit(0))
            point = F.length(x["whole"]) + power
            at = F.greatest(point, F.lit(0))
            lead = F.repeat(F.lit("0"), F.least(-F.least(point, F.lit(0)), F.lit(self.scale)))
            fraction = F.substr(F.concat(lead, F.substr(digits, at + 1)), F.lit(1), F.lit(self.scale))
            whole = F.ltrim(F.rpad(F.substr(digits, F.lit(1), at), at, F.lit("0")), F.lit("0"))
            return F.struct(F.concat(x["sign"], F.lit("0"), whole, F.lit("."), fraction, F.lit("0")).alias("text"), F.length(whole).alias("size"))

        def checked(x: Column) -> Column:
            return _check(x["text"], x["size"] <= most, f"{name}: more than {most} integer digits")

        made = F.transform(F.transform(F.array(read), plain), checked)[0]
        return F.when(value.rlike(_NUMBER), made).otherwise(value).cast(self.spark)  # what is no number fails in the cast

    def csv(self, value: Column) -> Column:
        return text.number_text(value, "decimal")

    def size(self, value: Column) -> Column:
        bits = (10**self.precision - 1).bit_length() + 1
        return _fixed(value, 4 if self.precision <= 9 else 8 if self.precision <= 18 else -(-bits // 8))


@dataclass(frozen=True)
class JSON(Type):
    """Any document, stored as JSON text; texts are taken to be JSON already."""

    spark = T.StringType()

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return value if isinstance(kind, T.StringType) else text.json_text(value)

    def size(self, value: Column) -> Column:
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


@dataclass(frozen=True)
class BSON(Type):
    """Any document, stored as BSON bytes."""

    spark = T.BinaryType()

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return bson_bytes(value if isinstance(kind, T.StringType) else text.json_text(value))

    def size(self, value: Column) -> Column:
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


@dataclass(frozen=True)
class List(Type):
    """A list of ``item``; null elements only if ``nullable``."""

    item: Type
    nullable: bool = False

    @property
    def spark(self) -> T.DataType:  # type: ignore[override]
        return T.ArrayType(self.item.spark, True)

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, T.ArrayType) and self.item.accepts(kind.elementType)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        def one(x: Column) -> Column:
            out = self.item.convert(x, kind.elementType, f"{name}.element")
            return out if self.nullable else not_null(out, x, f"{name}.element")

        return F.transform(value, one)

    def size(self, value: Column) -> Column:
        return F.coalesce(F.aggregate(F.transform(value, self.item.size), F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long"))


@dataclass(frozen=True)
class Struct(Type):
    """A group of named fields, each (type, nullable)."""

    fields: tuple[tuple[str, Type, bool], ...]

    @property
    def spark(self) -> T.DataType:  # type: ignore[override]
        return T.StructType([T.StructField(n, t.spark, True) for n, t, _ in self.fields])

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, T.StructType) and all(n in kind.names and t.accepts(kind[n].dataType) for n, t, _ in self.fields)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        made = []
        for n, t, nullable in self.fields:
            x = t.convert(value[n], kind[n].dataType, f"{name}.{n}")
            made.append((x if nullable else not_null(x, value[n], f"{name}.{n}")).alias(n))
        return F.when(value.isNotNull(), F.struct(*made))

    def size(self, value: Column) -> Column:
        out = F.lit(0).cast("long")
        for n, t, _ in self.fields:
            out = out + t.size(value[n])
        return out


@dataclass(frozen=True)
class Numeric(Type):
    """CSV only: any number, as its shortest text."""

    numeric = True
    spark = T.StringType()

    def accepts(self, kind: T.DataType) -> bool:
        return _is_number(kind)

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return text.number_text(value, kind.simpleString())


@dataclass(frozen=True)
class DateTime(Type):
    """CSV only: an instant as ISO text in UTC, or by a strftime format."""

    format: str | None = None
    spark = T.StringType()

    def accepts(self, kind: T.DataType) -> bool:
        return isinstance(kind, (T.TimestampType, T.TimestampNTZType))

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return text.strftime_text(value, self.format) if self.format else text.iso_text(value)


@dataclass(frozen=True)
class Custom(Type):
    """A type of the user's own: ``render`` maps a column to the stored one."""

    spark: T.DataType
    render: Callable[[Column], Column]
    numeric: bool = False
    width: Callable[[Column], Column] | None = None

    def convert(self, value: Column, kind: T.DataType, name: str) -> Column:
        return self.render(value).cast(self.spark)

    def size(self, value: Column) -> Column:
        return self.width(value) if self.width else F.coalesce(F.octet_length(value.cast("string")), F.lit(0)).cast("long")


def not_null(value: Column, raw: Column, name: str) -> Column:
    return F.when(raw.isNotNull(), value).otherwise(F.raise_error(F.lit(f"{name} must not be null")))
