"""Turn messy listing text into numbers, flags and lengths.

All casts go through ``try_cast`` so the result is the same with ANSI mode on or
off: text that is no number gives null, never an error.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_price(col: Column | str) -> Column:
    """Price text to double: ``$1,234.56`` and ``€1.234,56`` both give 1234.56.

    A dot before the first comma marks the European style (dots group, the comma
    is the decimal mark); otherwise commas group. ``€85,00`` is therefore 8500.
    """
    text = F.regexp_replace(as_column(col), r"[$€£\s]", "")
    dot, comma = F.instr(text, "."), F.instr(text, ",")
    no_dots = F.replace(text, F.lit("."), F.lit(""))
    european = F.replace(no_dots, F.lit(","), F.lit("."))
    grouped = F.replace(text, F.lit(","), F.lit(""))
    return F.when((dot > 0) & (dot < comma), european).otherwise(grouped).try_cast("double")


def price_fallback(col: Column | str) -> Column:
    """Keep digits and dots only; used when no cleaned price exists yet."""
    return F.regexp_replace(as_column(col), r"[^0-9.]", "").try_cast("double")


def percent(col: Column | str) -> Column:
    """``97%`` to 0.97; null input gives 0, malformed text gives null."""
    c = as_column(col)
    share = F.replace(c, F.lit("%"), F.lit("")).try_cast("double") / F.lit(100.0)
    return F.when(c.isNull(), F.lit(0.0)).otherwise(share)


def flag_tf(col: Column | str) -> Column:
    """``t`` is 1, everything else (``f``, other text, null) is 0."""
    return F.when(as_column(col) == "t", 1).otherwise(0)


def days_since(col: Column | str, as_of: Column | str | None = None, fmt: str = "yyyy-MM-dd") -> Column:
    """Whole days from the date in ``col`` to ``as_of`` (today by default); no date gives 0."""
    end = F.current_date() if as_of is None else (F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
    start = F.try_to_date(as_column(col).cast("string"), fmt)
    return F.coalesce(F.datediff(end, start), F.lit(0))


def to_int(col: Column | str) -> Column:
    """Number text to int by truncation: ``2.0`` gives 2."""
    return as_column(col).try_cast("double").try_cast("int")


def to_double(col: Column | str) -> Column:
    return as_column(col).try_cast("double")


def first_number(col: Column | str) -> Column:
    """First number inside free text: ``1.5 shared baths`` gives 1.5, ``Half-bath`` null."""
    return F.regexp_extract(as_column(col), r"(\d+\.?\d*)", 1).try_cast("double")


def list_text(col: Column | str) -> Column:
    """Strip list punctuation from a list stored as text."""
    return F.translate(as_column(col), '[]{}"', "")


def _token_count(text: Column, separator: str, null_size: int) -> Column:
    return F.when(text.isNull(), F.lit(null_size)).otherwise(F.size(F.split(text, separator)))


def list_size(col: Column | str, null_size: int = -1) -> Column:
    """Number of comma-separated parts; an empty list counts one part, null ``null_size``."""
    return _token_count(list_text(col), ",", null_size)


def keyword_flag(col: Column | str, pattern: str, word_boundary: bool = False) -> Column:
    """1 when the lower-cased list text matches ``pattern`` anywhere, else 0.

    By default a match inside a longer word counts (``ac`` matches ``backyard``);
    ``word_boundary`` asks for whole words. A pattern that is only plain words
    joined by ``|`` is searched as text, which is much cheaper than a regex.
    """
    text = F.lower(list_text(col))
    if word_boundary:
        hit = text.rlike(rf"\b(?:{pattern})\b")
    elif re.fullmatch(r"[\w /|-]+", pattern, re.ASCII):
        hit = reduce(lambda a, b: a | b, [text.contains(word) for word in pattern.split("|")])
    else:
        hit = text.rlike(pattern)
    return F.when(hit, 1).otherwise(0)


def text_length(col: Column | str) -> Column:
    return F.length(as_column(col))


def word_count(col: Column | str, null_size: int = -1) -> Column:
    """Parts between single spaces; a run of spaces adds empty parts."""
    return _token_count(as_column(col), " ", null_size)
