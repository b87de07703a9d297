"""White space and small text helpers that all operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: Unicode white space, in a form that Java and RE2 read alike.
SPACE = r"[\x09-\x0D\x20\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: The same characters one by one.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at either end."""
    return F.btrim(as_column(c), F.lit(SPACES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def or_else(first: Column, *choices: Column) -> Column:
    """The first choice that is neither null nor empty; else empty. Later ones are computed only if needed."""
    return let(first, lambda x: F.when(x != "", x).otherwise(or_else(*choices) if choices else F.lit("")))


def filled(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(""))


def first_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match; empty without one."""
    return F.regexp_extract(as_column(c), pattern, group)
