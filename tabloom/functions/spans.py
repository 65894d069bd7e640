"""Column expressions on character offsets: windows over a text and answer spans in them.

All spans are half-open [start, end) and counted in characters from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = 4096
STRIDE = 2048


def let(value: Column, use) -> Column:
    """use(value) with `value` computed once.

    An expression named inside a lambda is evaluated again for every element;
    binding it as the element of a one-element array avoids that.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def window_count(length: Column, size: int = SIZE, stride: int = STRIDE, keep_tail: bool = True) -> Column:
    """Number of windows of a text of `length` characters.

    The windows cover the whole text; the last one may be shorter. Without
    `keep_tail` a window counts only when a character follows its end, so a
    text that just fills a window gives none and the rest of a text is left out.
    """
    if keep_tail:
        beyond = F.ceil((length - size) / F.lit(stride))
        return F.when(length <= 0, F.lit(0)).otherwise(F.greatest(beyond, F.lit(0)) + 1).cast("int")
    whole = F.floor((length - 1 - size) / F.lit(stride)) + 1
    return F.greatest(whole, F.lit(0)).cast("int")


def numbers_below(count: Column) -> Column:
    """[0, 1, ..., count - 1], empty when count < 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def window_texts(text: Column, count: Column, size: int = SIZE, stride: int = STRIDE) -> Column:
    """array<string> of the window texts.

    The text is cut once into blocks of `stride` characters and windows are
    glued from blocks, so the work grows with the text and not with its square,
    as it would with one `substring` from the start per window.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    span = -(-size // stride)

    def glue(parts: Column) -> Column:
        return F.transform(
            numbers_below(count),
            lambda k: F.substring(F.array_join(F.slice(parts, k + 1, F.lit(span)), ""), 1, size),
        )

    return let(blocks, glue)


def overlaps(a: Column, b: Column, s: Column, e: Column) -> Column:
    """True when [a, b) and [s, e) share a character."""
    return (a < e) & (b > s)


def clip(a: Column, b: Column, s: Column, e: Column) -> tuple[Column, Column]:
    """Start and end of [a, b) inside the window [s, e), counted from the window start."""
    return F.greatest(a, s) - s, F.least(b, e) - s


def first_window(a: Column, size: int, stride: int) -> Column:
    """Number of the first window that reaches past character `a`."""
    return F.greatest(F.floor((a - size) / F.lit(stride)) + 1, F.lit(0)).cast("int")


def last_window(b: Column, count: Column, stride: int) -> Column:
    """Number of the last window that starts before character `b`."""
    return F.least(F.floor((b - 1) / F.lit(stride)), count - 1).cast("int")
