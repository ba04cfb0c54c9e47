"""Text, number and date column functions.

They carry the comparison rules of the systems being reconciled: text compares
without case and trailing blanks, blank text stands for a missing value, and a
zero volume or page is no volume or page.  Everything is a built-in expression,
so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS_AND_FILLERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ- "


def fold(c: Column) -> Column:
    """Comparison key: no case, no trailing blanks."""
    return F.lower(F.rtrim(c))


def is_blank(c: Column) -> Column:
    """True for '' and blanks only; NULL stays unknown."""
    return F.rtrim(c) == ""


def is_filled(c: Column) -> Column:
    """Non-blank test; NULL stays unknown, so a filter drops it."""
    return F.rtrim(c) != ""


def blank_to_null(c: Column) -> Column:
    return F.when(is_filled(c), c)


def word_to_null(c: Column, word: str) -> Column:
    """NULL where the text is `word` in any case, as in a stored 'null'."""
    return F.when(fold(c) == F.lit(word.lower()), F.lit(None)).otherwise(c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def concat_nulls_empty(*cols: Column) -> Column:
    """Concatenation in which NULL counts as ''."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def positive_key(c: Column, kind: str = "int") -> Column:
    """Whole number from text; junk, blank, overflow and zero become NULL."""
    return F.nullif(F.trim(c).try_cast(kind), F.lit(0).cast(kind))


def digits_text(c: Column, max_chars: int | None = None) -> Column:
    """The text without letters, hyphens and blanks.

    `max_chars=30` gives the cut the legacy slices had.
    """
    digits = F.translate(c, LETTERS_AND_FILLERS, "")
    return digits if max_chars is None else digits.substr(1, max_chars)


def digits_number(c: Column) -> Column:
    return positive_key(digits_text(c), "bigint")


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def millis_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def on_day(c: Column, day: str) -> Column:
    """Same calendar day, as a half-open range so that it reaches the scan."""
    start = F.lit(day).cast("date")
    return (c >= start) & (c < F.date_add(start, 1))


def shifted(c: Column, minutes: int) -> Column:
    """Wall-clock shift of a timestamp by whole minutes."""
    return c + F.make_dt_interval(mins=F.lit(minutes))


def path_extension(c: Column) -> Column:
    """Extension with its dot, '' if the file name has none."""
    return F.regexp_extract(c, r"[^./][^/]*(\.[^./]*)$", 1)


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def contains_word(c: Column, words: tuple[str, ...], whole_words: bool = False) -> Column:
    """Any of `words` in the text, in any case.

    The default also hits longer words ("ALL" in "parallel"), as the migrated
    filters did; `whole_words` asks for word boundaries.
    """
    hit = F.lit(False)
    for word in words:
        hit = hit | (c.rlike(rf"(?i)\b{word}\b") if whole_words else c.ilike(f"%{word}%"))
    return hit


def stable_id(*parts: Column) -> Column:
    """Id from the business key: equal on every retry, unlike uuid()."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
