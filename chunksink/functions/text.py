"""Column expressions that turn values into text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(value: Column, kind: str) -> Column:
    """A number's shortest text: integers as digits, decimals without trailing zeros, doubles positional from 1e-6 up to 1e21.

    ``kind`` is the simple type name of the column.
    """
    if kind.startswith("decimal"):
        return F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    if kind not in ("float", "double"):
        return value.cast("string")
    raw = value.cast("string")
    plain = F.regexp_replace(raw, r"\.0$", "")
    simple = ~raw.contains("E") & (F.length(raw) < 17)
    if kind == "float":
        return F.when(value == 0, F.lit("0")).when(simple, plain).otherwise(_placed(raw))
    return F.when(value == 0, F.lit("0")).when(simple, plain).otherwise(_bind(value, lambda v: _placed(_shortest(v))))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, inside one expression."""
    return F.transform(F.array(value), body)[0]


def _shortest(value: Column) -> Column:
    """The fewest digits, 15 to 17, that give the same double; the platform's own text may have more."""
    best = value.cast("string")
    for digits in (17, 16, 15):
        tried = F.format_string(f"%.{digits - 1}e", value)
        best = F.when(tried.cast("double") == value, tried).otherwise(best)
    return F.when(F.length(value.cast("string")) >= 17, best).otherwise(value.cast("string"))


def _placed(raw: Column) -> Column:
    """Text in scientific form with the point where it belongs; other text as it is, without a final ``.0``."""
    parts = F.struct(
        F.when(raw.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.regexp_replace(F.regexp_replace(F.regexp_extract(raw, r"^-?([\d.]+)[eE]", 1), r"\.", ""), r"(\d)0+$", "$1").alias("digits"),
        F.regexp_extract(raw, r"[eE]\+?(-?\d+)$", 1).try_cast("int").alias("power"),
        F.regexp_replace(raw, r"\.0$", "").alias("plain"),
    )

    def text(p: Column) -> Column:
        digits, power = p["digits"], p["power"]
        size = F.length(digits)
        large = F.when(size <= power + 1, F.rpad(digits, power + 1, "0")).otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, size)))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        tail = F.when(size > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), size))).otherwise(F.lit(""))
        exponent = F.concat(F.substring(digits, F.lit(1), F.lit(1)), tail, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.abs(power).cast("string"))
        return F.when(power.isNull(), p["plain"]).otherwise(F.concat(p["sign"], F.when((power >= 0) & (power <= 20), large).when((power < 0) & (power >= -6), small).otherwise(exponent)))

    return _bind(parts, text)


def utc(value: Column) -> Column:
    """A timestamp whose fields, read in the session's zone, are those of UTC."""
    stamp = value.cast("timestamp")
    return F.when(F.current_timezone() == "UTC", stamp).otherwise(F.to_utc_timestamp(stamp, F.current_timezone()))


def iso_text(value: Column) -> Column:
    return F.date_format(utc(value), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# Strftime directives and the pattern letters that print the same.
DIRECTIVES = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "L": "SSS", "f": "SSSSSS",
    "j": "DDD", "p": "a", "B": "MMMM", "b": "MMM", "A": "EEEE", "a": "EEE", "F": "yyyy-MM-dd", "T": "HH:mm:ss", "R": "HH:mm", "D": "MM/dd/yy", "e": "d",
    "Z": "'UTC'", "z": "'+0000'", "%": "'%'", "n": "'\n'", "t": "'\t'",
}


def pattern_of(strftime: str) -> str:
    """The datetime pattern of a strftime format; unknown directives raise ``ValueError``."""
    out = []
    for m in re.finditer(r"%(.?)|([^%]+)", strftime, re.S):
        if m[2] is not None:
            out.append("'" + m[2].replace("'", "''") + "'")
        elif m[1] in DIRECTIVES:
            out.append(DIRECTIVES[m[1]])
        else:
            raise ValueError(f"strftime directive %{m[1]} is not supported")
    return "".join(out).replace("''''", "\0").replace("''", "").replace("\0", "''''")


def strftime_text(value: Column, strftime: str) -> Column:
    return F.date_format(utc(value), pattern_of(strftime))


def json_text(value: Column) -> Column:
    """A document's JSON text; nulls are kept."""
    return F.to_json(value, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"})


def snake_case(name: str) -> str:
    """``blockNumber`` becomes ``block_number``."""
    name = re.sub(r"[\s\-.]+", "_", name.strip())
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
