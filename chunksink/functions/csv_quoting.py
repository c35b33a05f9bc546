"""CSV dialects and quoting as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Quote(Enum):
    ALL = "all"
    MINIMAL = "minimal"
    NONNUMERIC = "nonnumeric"
    NONE = "none"


@dataclass(frozen=True)
class Dialect:
    """How fields and rows are set apart.

    ``escape`` defaults to the quote character (doubling). With
    ``strict_terminator`` only the whole terminator makes a field need quotes;
    otherwise any carriage return or line feed does.
    """

    delimiter: str = ","
    quote: str = '"'
    quoting: Quote = Quote.MINIMAL
    terminator: str = "\r\n"
    escape: str | None = None
    strict_terminator: bool = False

    def __post_init__(self) -> None:
        if not self.delimiter or not self.quote or not self.terminator:
            raise ValueError("delimiter, quote and terminator must not be empty")

    @property
    def escape_with(self) -> str:
        return self.escape or self.quote


EXCEL = Dialect()
EXCEL_TAB = Dialect(delimiter="\t")


def _escaped(text: Column, what: list[str], dialect: Dialect) -> Column:
    """``text`` with the escape character before each of ``what``."""
    alternatives = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in w) for w in sorted(set(what), key=len, reverse=True))
    lead = dialect.escape_with.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, f"({alternatives})", f"{lead}$1")


def _quoted(text: Column, dialect: Dialect) -> Column:
    q = F.lit(dialect.quote)
    return F.concat(q, _escaped(text, [dialect.quote, dialect.escape_with], dialect), q)


def _bare(text: Column, dialect: Dialect) -> Column:
    return _escaped(text, [dialect.delimiter, dialect.quote, dialect.escape_with, dialect.terminator], dialect)


def quote_field(text: Column, numeric: bool, dialect: Dialect) -> Column:
    """One field; a null counts as an empty text."""
    text = F.coalesce(text, F.lit(""))
    if dialect.quoting is Quote.ALL:
        return _quoted(text, dialect)
    if dialect.quoting is Quote.NONE:
        return _bare(text, dialect)
    if dialect.quoting is Quote.NONNUMERIC:
        return _bare(text, dialect) if numeric else _quoted(text, dialect)
    marks = [dialect.delimiter, dialect.quote, dialect.terminator] + ([] if dialect.strict_terminator else ["\r", "\n"])
    needs = text.contains(marks[0])
    for m in marks[1:]:
        needs = needs | text.contains(m)
    return F.when(needs, _quoted(text, dialect)).otherwise(text)


def line(fields: list[tuple[Column, bool]], dialect: Dialect) -> Column:
    """One row's text without its terminator; ``fields`` are (text, is numeric)."""
    return F.concat_ws(dialect.delimiter, *(quote_field(t, n, dialect) for t, n in fields))
