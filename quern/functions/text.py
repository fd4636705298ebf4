"""Text column expressions, all JVM-side and free of per-element lambdas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.split() treats as white space.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
HAN = r"\p{IsHan}"


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(col: Column | str) -> Column:
    """White-space separated words; an empty text has none."""
    return F.array_remove(F.split(text_or_empty(col), WHITESPACE), "")


def first_words(col: Column | str, n: int = 500) -> Column:
    """The first ``n`` words joined by single spaces.

    The split stops after ``n + 1`` cuts (one may be an empty leading piece), so
    the tail of a long text is not cut into words that are thrown away.
    """
    pieces = F.split(text_or_empty(col), WHITESPACE, n + 2)
    return F.array_join(F.slice(F.array_remove(pieces, ""), 1, n), " ")


def tokens(col: Column | str, han: str = "run") -> Column:
    """Lower-cased runs of letters and digits.

    ``han`` says what to do with unsegmented Chinese text: keep the ``run``,
    cut it into ``unigram`` characters, or into overlapping ``bigram`` pairs.
    """
    lowered = F.lower(text_or_empty(col))
    if han == "unigram":
        lowered = F.regexp_replace(lowered, f"({HAN})", " $1 ")
    elif han == "bigram":
        pairs = F.regexp_extract_all(lowered, F.lit(f"(?=({HAN}{HAN}))"), F.lit(1))
        singles = F.regexp_extract_all(lowered, F.lit(f"(?<!{HAN}){HAN}(?!{HAN})"), F.lit(0))
        others = F.array_remove(F.split(F.regexp_replace(lowered, HAN, " "), NOT_WORD), "")
        return F.concat(others, pairs, singles)
    elif han != "run":
        raise ValueError(f"unknown han mode {han!r}")
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def join_fields(*cols: Column | str) -> Column:
    """Fields joined by single spaces, a null counting as empty text."""
    return F.concat_ws(" ", *[text_or_empty(c) for c in cols])


def keyword(col: Column | str, limit: int = 256) -> Column:
    """The exact-match subfield: null when the text is longer than ``limit``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) <= limit, c)


def preview(col: Column | str, n: int = 100, suffix: str = "...") -> Column:
    return F.concat(F.substring(text_or_empty(col), 1, n), F.lit(suffix))


def or_na(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("N/A"))
