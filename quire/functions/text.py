"""Small Column helpers with Python-like text semantics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(s: Column) -> Column:
    """Split at every newline, trailing empties kept."""
    return F.split(s, "\n", -1)


def unlines(a: Column) -> Column:
    return F.array_join(a, "\n")


#: What \\s is with (?U). A pattern that ends in \\z is tried at every character of a text; trimming looks at the ends.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(s: Column) -> Column:
    """Trim all Unicode white space on both sides."""
    return F.trim(s, F.lit(WHITE))


def rstrip(s: Column) -> Column:
    return F.rtrim(s, F.lit(WHITE))


def lstrip(s: Column) -> Column:
    return F.ltrim(s, F.lit(WHITE))


def blank(s: Column) -> Column:
    return ~F.coalesce(s, F.lit("")).rlike(r"(?U)\S")


def has(s: Column, *patterns: str) -> Column:
    """Whether any pattern is found."""
    return reduce(lambda a, b: a | b, (s.rlike(p) for p in patterns))


def count(s: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(s) - F.length(F.replace(s, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once, however often f uses it. Python UDFs may be in x but not in f."""
    return F.element_at(F.transform(F.array(x), f), 1)
