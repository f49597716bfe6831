"""Text columns: strip, words, characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, first as a pattern
# (Unicode white space plus the four ASCII separator controls), then one by one.
_SPACE = r"\s\x1c-\x1f"
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACES))


def word_count(text: Column) -> Column:
    words = F.regexp_count(text, F.lit(rf"(?U)[^{_SPACE}]+"))
    return F.coalesce(words, F.lit(0)).cast("int")


def char_count(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0)).cast("int")


def language_list(languages: Column) -> Column:
    """``eng+deu`` as an array of language codes."""
    return F.split(languages, r"\+")


def first_language(languages: Column) -> Column:
    return F.element_at(language_list(languages), 1)
