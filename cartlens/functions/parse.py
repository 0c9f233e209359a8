"""Typed conversion of string columns (CSV ingest), as Column expressions.

Strict parsers raise on a bad value (``raise_error``), like the reference's
typed read; coercing parsers turn bad values into null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlens.schema import FALSE_TOKENS, NA_TOKENS, TRUE_TOKENS


_DATE, _TIME = r"\d{4}-\d{2}-\d{2}", r"[ T]\d{2}:\d{2}:\d{2}(\.\d{1,9})?"


@dataclass(frozen=True)
class TimestampForm:
    """One way to write a timestamp: what a value must match, and the pattern to read it with (None: ISO)."""
    regex: str
    pattern: str | None = None


ISO_DATE, ISO_TIME = TimestampForm(f"^{_DATE}$"), TimestampForm(f"^{_DATE}{_TIME}$")


def timestamp_form(value: str) -> TimestampForm | None:
    """The form of a sample value: ISO with ``-``, or day, month and year with ``/`` (month first unless the
    first number is over 12); a date alone, or with a time after a space or ``T``, with or without
    seconds and a fraction. None for anything else."""
    m = re.fullmatch(r"(?:(\d{4}-\d{2}-\d{2})|(\d{2})/\d{2}/\d{4})(?:([ T])\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?", value)
    if m is None:
        return None
    iso, first, gap, seconds, fraction = m.groups()
    regex = _DATE if iso else r"\d{2}/\d{2}/\d{4}"
    if gap:
        regex += gap + r"\d{2}:\d{2}" + r":\d{2}" * bool(seconds) + r"\.\d{1,9}" * bool(fraction)
    if iso:
        return TimestampForm(f"^{regex}$")
    clock = (gap if gap == " " else "'T'") + "HH:mm" + ":ss" * bool(seconds) + ".[SSSSSSSSS][SSSSSS][SSS]" * bool(fraction) if gap else ""
    return TimestampForm(f"^{regex}$", ("dd/MM/yyyy" if int(first) > 12 else "MM/dd/yyyy") + clock)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c, tokens: list[str] = NA_TOKENS) -> Column:
    """Map every NA token to null; other strings (including ``NA``) stay."""
    c = _col(c)
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def parse_boolean(c, name: str = "value") -> Column:
    """True/False token sets; any other non-null string raises."""
    c = _col(c)
    return (F.when(c.isNull(), F.lit(None).cast("boolean"))
            .when(c.isin(TRUE_TOKENS), F.lit(True))
            .when(c.isin(FALSE_TOKENS), F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit(f"invalid boolean in {name}: "), c))
                       .cast("boolean")))


def _is_number(c: Column) -> Column:
    """Decimal or exponent notation, an infinity or NaN; no Java type suffix, no hexadecimals."""
    return F.rlike(F.trim(c), F.lit(r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?|[nN]a[nN])$"))


def parse_integer(c, name: str = "value") -> Column:
    """Nullable integer: ``1.0`` -> 1; ``1.5`` or text raises. Whole digits never go through a double."""
    c = _col(c)
    whole = F.regexp_replace(F.trim(c), r"\.0*$", "").try_cast("long")
    d = F.when(_is_number(c), c.try_cast("double"))
    ok = d.isNotNull() & (d == F.floor(d)) & (F.abs(d) < 2.0 ** 53)
    return (F.when(c.isNull(), F.lit(None).cast("long"))
            .when(whole.isNotNull() & _is_number(c), whole)
            .when(ok, d.cast("long"))
            .otherwise(F.raise_error(F.concat(F.lit(f"invalid integer in {name}: "), c))
                       .cast("long")))


def parse_double(c, name: str = "value") -> Column:
    """Nullable float; text raises."""
    c = _col(c)
    d = F.when(_is_number(c), c.try_cast("double"))
    return (F.when(c.isNull() | d.isNotNull(), d)
            .otherwise(F.raise_error(F.concat(F.lit(f"invalid number in {name}: "), c))
                       .cast("double")))


def parse_ts_strict(c, fmt: str | TimestampForm | None = None, name: str = "value") -> Column:
    """Timestamp (no time zone); an unparsable non-null value raises."""
    c = _col(c)
    t = parse_ts_coerce(c, fmt)
    return (F.when(c.isNull() | t.isNotNull(), t)
            .otherwise(F.raise_error(F.concat(F.lit(f"invalid timestamp in {name}: "), c))
                       .cast("timestamp_ntz")))


def parse_ts_coerce(c, fmt: str | TimestampForm | None = None) -> Column:
    """Timestamp (no time zone); values that are not in an accepted format become null.

    Without ``fmt`` these are ISO dates and ISO dates with a time (``T`` or a space between, a
    fraction allowed), not bare years or offsets; a :class:`TimestampForm` accepts that form
    alone (the one-format rule); anything else is a Spark datetime pattern.
    Nothing passes through the session's time zone."""
    c = _col(c)
    if fmt is None:
        fmt = TimestampForm(f"^{_DATE}({_TIME})?$")
    if isinstance(fmt, TimestampForm):
        if fmt.pattern is None:
            return F.when(F.rlike(c, F.lit(fmt.regex)), c.try_cast("timestamp_ntz"))
        return F.when(F.rlike(c, F.lit(fmt.regex)), parse_ts_coerce(c, fmt.pattern))
    # Parsed without a zone; the guard keeps the strict parser from raising on other formats.
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))
