"""String functions (all return Columns, built from Spark built-ins where these suffice)."""

from __future__ import annotations

import sys
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_char(c) -> Column:
    """First character; null stays null."""
    return F.substring(_c(c), 1, 1)


def char_length(c) -> Column:
    return F.length(_c(c))


def between_marks(c, start: str = ",", end: str = ".") -> Column:
    """Text after the first ``start`` mark up to the next ``end`` mark, trimmed.

    A value without the ``start`` mark gives null.
    """
    s = _c(c)
    after = F.substring_index(F.substr(s, F.instr(s, F.lit(start)) + len(start)), start, 1)
    return F.when(F.instr(s, F.lit(start)) > 0, F.trim(F.substring_index(after, end, 1)))


def before_mark(c, mark: str = ", ") -> Column:
    """Text before the first ``mark`` (whole value when the mark is absent)."""
    return F.substring_index(_c(c), mark, 1)


def whitelist(c, allowed: Iterable[str], other: str = "Rare") -> Column:
    """Value when in ``allowed``, otherwise ``other`` (null gives ``other``)."""
    s = _c(c)
    return F.when(s.isin(list(allowed)), s).otherwise(F.lit(other))


def suffix(c, n: int = 3) -> Column:
    """Last ``n`` characters (the whole value when shorter)."""
    return F.right(_c(c), F.lit(int(n)))


def concat_null(*cols) -> Column:
    """Concatenation; any null input gives null."""
    return F.concat(*[_c(c) for c in cols])


def count_word(c, word: str) -> Column:
    """Non-overlapping occurrences of ``word`` in the lower-cased text.

    Plain string replacement (no regular expression), scanning left to right like
    ``str.count``.
    """
    t = F.lower(_c(c))
    w = word.lower()
    if not w:
        raise ValueError("word must not be empty")
    return ((F.length(t) - F.length(F.replace(t, F.lit(w), F.lit("")))) / F.lit(len(w))).cast("long")


# fixed value: the link pattern -- the quoted value that follows ``href=``
LINK_PATTERN = 'href=[^"]*"([^"]*)"'


def links(c, must_contain: str | None = "http:") -> Column:
    """All quoted values after ``href=`` in the lower-cased page, optionally only those that
    contain ``must_contain``; an array column."""
    found = F.regexp_extract_all(F.lower(_c(c)), F.lit(LINK_PATTERN), 1)
    if must_contain:
        found = F.filter(found, lambda x: F.instr(x, must_contain) > 0)
    return found


def base26(c, none_word: bool = False) -> Column:
    """Letters to a number: sum of (code - 64) * 26^k, the last letter having k = 0.

    'A' -> 1, 'Z' -> 26, 'AB' -> 28. Null gives null, or the code of the word 'None' when
    ``none_word`` is set. Exact in decimal(38, 0), i.e. up to 27 letters; ``base26_text`` has no bound.
    """
    s = _c(c)
    if none_word:
        s = F.coalesce(s, F.lit("None"))
    dec = "decimal(38,0)"
    digits = F.transform(F.split(s, ""), lambda ch: (F.ascii(ch) - 64).cast(dec))
    return F.when(s.isNull(), F.lit(None).cast(dec)).when(F.length(s) == 0, F.lit(0).cast(dec)).otherwise(
        F.aggregate(digits, F.lit(0).cast(dec), lambda acc, x: (acc * 26 + x).cast(dec)))


#: Letters taken together before they meet the long number.
LETTERS_AT_ONCE = 12


def _base26_number(s: str) -> str:
    number = 0
    for at in range(0, len(s), LETTERS_AT_ONCE):
        part, some = s[at:at + LETTERS_AT_ONCE], 0
        for ch in part:
            some = some * 26 + ord(ch) - 64
        number = number * 26 ** len(part) + some
    return str(number)


def base26_text(c, none_word: bool = False) -> Column:
    """The number of ``base26`` as decimal text, exact for texts of any length: whole numbers of Python,
    a batch of texts at once. Null gives null, or the word 'None'."""
    @F.pandas_udf("string")
    def number(texts: pd.Series) -> pd.Series:
        sys.set_int_max_str_digits(0)
        return texts.map(_base26_number, na_action="ignore")

    s = _c(c)
    if none_word:
        s = F.coalesce(s, F.lit("None"))
    return number(s)


def join_names(c, sep: str = " ") -> Column:
    return F.array_join(_c(c), sep)


def strip_na(c, default=None) -> Column:
    """Trimmed text; '' or 'NA' become ``default`` (null when not given)."""
    t = F.trim(_c(c))
    v = F.when((t == "") | (t == "NA"), None).otherwise(t)
    return v if default is None else F.coalesce(v, F.lit(default))


def split_pair(c) -> tuple[Column, Column]:
    """Two numbers from a whitespace separated text line; bad parts give null."""
    parts = F.split(F.trim(_c(c)), r"\s+")
    return (F.try_element_at(parts, F.lit(1)).try_cast("double"),
            F.try_element_at(parts, F.lit(2)).try_cast("double"))


def char_at(c, pos: int) -> Column:
    """One character at 1-based ``pos``."""
    return F.substring(_c(c), pos, 1)
