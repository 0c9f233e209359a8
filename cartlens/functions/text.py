"""Text cleaning as Column expressions (JVM-side, codegen'd; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlens.schema import (REPEATED_PUNCT, REVIEW_KEEP_CLASS, SEX_FEMALE_TOKENS,
                             SEX_MALE_TOKENS, TAG_PATTERN, URL_PATTERN, WS, WS_CHARS, WS_CLASS)

# Java regexes: (?d) makes "." stop only at "\n", as in Python.


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Strip Unicode whitespace at both ends (``F.trim`` only strips spaces).

    ``btrim`` with the explicit character set is a native scan of both ends,
    several times cheaper than an anchored regular expression.
    """
    return F.btrim(_col(c), F.lit(WS_CHARS))


def clean_str(c, case: str | None = None) -> Column:
    """Strip; blank becomes null; then optional ``lower``/``upper``."""
    if case not in (None, "lower", "upper"):
        raise ValueError(f"case must be None, 'lower' or 'upper', not {case!r}")
    out = F.nullif(strip(c), F.lit(""))
    if case == "lower":
        out = F.lower(out)
    elif case == "upper":
        out = F.upper(out)
    return out


def parse_list_string(c, has_brackets: bool = True, sep: str = ",") -> Column:
    """String-formatted list -> array<string>.

    Null or blank gives an empty array; one leading ``[`` and one trailing
    ``]`` are dropped; elements are split literally and kept untrimmed, so
    ``"[]"`` gives ``[""]`` and a trailing separator gives a trailing ``""``.
    """
    s = clean_str(c)
    body = s
    if has_brackets:
        body = F.regexp_replace(F.regexp_replace(s, r"^\[", ""), r"\]$", "")
    parts = F.split(body, r"\Q" + sep + r"\E", -1)
    return F.when(s.isNull(), F.array().cast("array<string>")).otherwise(parts)


def is_invalid_json(c) -> Column:
    """True for a non-null string that is not one complete JSON document.

    Spark's parser stops after the first value and ignores what follows
    (``'"k": 1}'`` parses as ``"k"``). Wrapping the text in ``[...]`` makes
    trailing content a syntax error, and the array must hold one element
    (which also rejects the empty string and ``'1, 2'``).
    """
    c = _col(c)
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    n = F.array_size(F.try_variant_get(wrapped, "$", "array<variant>"))
    return c.isNotNull() & ~F.coalesce(n == 1, F.lit(False))


def canonical_sex(c) -> Column:
    """Free-text sex -> ``M`` / ``F`` / null."""
    u = clean_str(c, "upper")
    return (F.when(u.isin(SEX_MALE_TOKENS), F.lit("M"))
            .when(u.isin(SEX_FEMALE_TOKENS), F.lit("F"))
            .otherwise(F.lit(None).cast("string")))


def normalize_whitespace(c) -> Column:
    """Strip and collapse whitespace runs to one space; null stays null."""
    return strip(F.regexp_replace(_col(c), f"{WS}+", " "))


def normalize_label(c) -> Column:
    """Strip + lower; blank stays ``''`` (unlike :func:`clean_str`)."""
    return F.lower(strip(c))


def clean_review_text(c) -> Column:
    """Review text for the sentiment model, step by step:

    null -> '' ; lower ; drop URLs ; drop tags (same line, lazy) ; other
    characters -> space ; collapse whitespace + strip ; collapse repeated
    ``! ? . ,`` to one.
    """
    t = F.lower(F.coalesce(_col(c), F.lit("")))
    t = F.regexp_replace(t, "(?d)" + URL_PATTERN.replace(r"\S", f"[^{WS_CLASS}]"), "")
    t = F.regexp_replace(t, "(?d)" + TAG_PATTERN, "")
    # "Other characters -> space, then whitespace runs -> one space, strip"
    # in one pass: every run of characters outside the kept set (whitespace
    # included) becomes one space. Same output, one ASCII-class scan.
    t = F.btrim(F.regexp_replace(t, f"[^{REVIEW_KEEP_CLASS}]+", " "), F.lit(" "))
    return F.regexp_replace(t, "([" + REPEATED_PUNCT + r"])\1+", "$1")


def text_length(c) -> Column:
    """Length in characters (code points)."""
    return F.char_length(_col(c))
