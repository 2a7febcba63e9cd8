"""Column helpers of the operators that use DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where the
    body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


FAN = 16  # values that are folded at a time
FOLDS = 5


def running(values: Column, op: Callable[[Column, Column], Column], body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body(before)`` where ``before(i)`` is the fold from 0 by ``op`` (an
    associative one, on int) of the first ``i`` values.  Values are folded in
    groups, groups in groups of groups; a prefix is a few folds of fewer than
    ``FAN`` values, and no array grows by a value at a time."""

    def grouped(a: Column) -> Column:
        last = F.shiftright(F.greatest(F.size(a) - 1, F.lit(0)), FAN.bit_length() - 1)
        return F.transform(F.sequence(F.lit(0), last), lambda g: F.aggregate(F.slice(a, g * FAN + 1, F.lit(FAN)), F.lit(0), op))

    def nested(levels: list[Column]) -> Column:
        if len(levels) < FOLDS:
            return let(grouped(levels[-1]), lambda g: nested([*levels, g]))

        def before(i: Column) -> Column:
            folded = F.lit(0)
            for k, level in enumerate(levels):
                at = F.shiftright(i, k * (FAN.bit_length() - 1))
                n = at if k == FOLDS - 1 else at.bitwiseAND(F.lit(FAN - 1))
                folded = F.aggregate(F.slice(level, at - n + 1, n), folded, op)
            return folded

        return body(before)

    return let(values, lambda v: nested([v]))


PIECE = 256


def pieces(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` code points, for ``part``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(cut: Column, start: Column, n: Column) -> Column:
    """``n`` code points of a cut text from ``start`` (from 0), without
    counting from the beginning of the text."""
    first, last = (F.shiftright(x, PIECE.bit_length() - 1) for x in (start, start + n))
    return F.substring(F.array_join(F.slice(cut, first + 1, last - first + 1), ""), start.bitwiseAND(F.lit(PIECE - 1)) + 1, n)


def tail(array: Column, skip: int) -> Column:
    """``array`` without its first ``skip`` elements."""
    return F.slice(array, skip + 1, F.greatest(F.size(array) - skip, F.lit(0)))


def head(array: Column, drop: int) -> Column:
    """``array`` without its last ``drop`` elements."""
    return F.slice(array, 1, F.greatest(F.size(array) - drop, F.lit(0)))


def same_shape(df, derived: dict[str, Column]):
    """``df`` with derived columns in place of any of the same names."""
    kept = [c for c in df.columns if c.lower() not in {d.lower() for d in derived}]
    return df.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in derived.items()])
